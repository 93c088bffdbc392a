"""quire.plans"""
