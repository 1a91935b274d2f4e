"""Incident, cost and prevention analytics for an insured portfolio, on Spark.

Jobs take DataFrames plus a parameter object and return DataFrames.
"""
