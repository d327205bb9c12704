"""Spark-native analysis of operational metadata.

Every function takes and returns DataFrames (or Columns); nothing runs until
the caller writes or collects.  ``metascope.session.tune`` should be applied to
the session once, before the operators are used on large data.
"""
