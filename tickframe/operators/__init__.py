"""tickframe.operators"""
