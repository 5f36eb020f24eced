"""tickframe.plans"""
