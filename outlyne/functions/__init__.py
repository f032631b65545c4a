"""outlyne.functions"""
