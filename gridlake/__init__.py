"""Gridded Earth-science fields as Spark tables: fill, align, regrid, mask, stack.

Every public function takes and returns DataFrames. A *field* is a long table with one row per
(coordinate labels, value); a missing value is NULL.
"""
