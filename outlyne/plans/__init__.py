"""outlyne.plans"""
