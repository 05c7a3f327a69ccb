"""bramble.plans"""
