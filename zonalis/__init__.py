"""Property-market analytics as Spark DataFrame operators.

functions   Column -> Column expressions
sources     readers, table schemas and sinks
operators   DataFrame -> DataFrame operators
plans       the five end-to-end jobs built from them
config      the fixed values (cities, type map, floors, limits, road rules)
"""
