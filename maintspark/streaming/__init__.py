"""maintspark.streaming"""
