"""tickframe.streaming"""
