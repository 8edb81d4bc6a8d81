"""lontar.functions"""
