"""maintspark.functions"""
