"""Operators for preparing language-model training data.

Nothing outside this package imports it.  Every operator takes DataFrames and
returns one; ``queries`` registers one query per operator over whole tables.
"""
