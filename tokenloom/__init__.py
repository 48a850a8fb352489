"""Distributed preparation and evaluation of language-model tuning data on Spark.

Functions take and return DataFrames (or Columns) and stay lazy; the few that
must run a small bounded action say so in their docstring.
"""
