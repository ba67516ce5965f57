"""Clickstream medallion analytics for shop events, built on PySpark DataFrames.

Operators are functions from DataFrame to DataFrame; reading, writing and clocks stay at the
edges (``sources``, ``streaming``, ``plans``).
"""
