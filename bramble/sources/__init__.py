"""bramble.sources"""
