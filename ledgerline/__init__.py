"""Ledgerline: log pipelines as PySpark DataFrame operators.

Every operator takes and returns DataFrames, so it composes with
``df.transform`` and is planned by Catalyst as one query.
"""
