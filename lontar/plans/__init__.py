"""lontar.plans"""
