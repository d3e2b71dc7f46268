"""Subscription and licence analytics as Spark plans.

An entity table and a change log become a state history, a daily panel and a
dense daily metrics table.  Every function takes and returns lazy DataFrames.
"""
