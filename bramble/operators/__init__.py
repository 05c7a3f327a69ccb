"""bramble.operators"""
