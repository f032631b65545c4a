"""outlyne.operators"""
