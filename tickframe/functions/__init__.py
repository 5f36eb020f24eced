"""tickframe.functions"""
