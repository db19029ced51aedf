"""Operators for building large text training sets, each a Spark job over the corpus tables.

Nothing else in the package imports this subpackage.
"""
