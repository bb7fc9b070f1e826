"""Binding of the utility model to the given TPC-H-like tables, with checks."""
