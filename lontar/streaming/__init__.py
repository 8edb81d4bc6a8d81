"""lontar.streaming"""
