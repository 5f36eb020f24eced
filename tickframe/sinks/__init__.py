"""tickframe.sinks"""
