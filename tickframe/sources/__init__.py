"""tickframe.sources"""
