"""Rules for text, money, instants, status and attributes, as Spark SQL expressions.

A rule takes SQL expressions and returns one, for `selectExpr` or `F.expr`. A mapping puts hundreds of
them together; as text that costs the driver one call per column instead of one per operation.
No Python runs per row.
"""
