"""Loyalty-tier analytics as Spark DataFrame transformations.

Every public function takes DataFrames and plain parameters and returns a
DataFrame; nothing in the package holds a path, a year or a property name.
"""
