"""lontar.sources"""
