"""Cleaning, reconciliation and reporting of large record tables on Spark.

Every function takes DataFrames (or Columns) and column names and returns lazy
DataFrames, a Column, or a dict of named DataFrames.
"""
