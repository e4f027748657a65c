"""Operators for preparing training text at scale, and the queries that apply them.

Nothing outside this package imports it. Operators take DataFrames and return DataFrames;
they name the columns they read and ignore all others, so extra columns never clash.
"""
