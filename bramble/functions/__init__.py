"""bramble.functions"""
