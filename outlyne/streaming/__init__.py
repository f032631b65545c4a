"""outlyne.streaming"""
