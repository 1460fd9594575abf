"""meanline: regression analytics over Spark DataFrames.

Profile how a label's mean moves with each column, recode and encode columns,
split by key, fit and cross-validate linear and tree regressions, and report on
the scored rows.  Every operator takes and returns DataFrames.
"""
