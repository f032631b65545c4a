"""outlyne.sources"""
