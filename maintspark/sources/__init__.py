"""maintspark.sources"""
