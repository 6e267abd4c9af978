"""lexibid: text-corpus and bid-table analytics as PySpark DataFrame operators.

functions   column expressions (splitting, word rules, typed fields)
sources     text, delimited and table scans, the pair sink, the session
operators   DataFrame -> DataFrame building blocks, DSL and SQL forms
plans       the named queries, their table bindings and their oracle SQL
"""
