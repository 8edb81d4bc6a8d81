"""lontar.operators"""
