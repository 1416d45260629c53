"""maintspark.plans"""
