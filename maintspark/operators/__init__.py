"""maintspark.operators"""
