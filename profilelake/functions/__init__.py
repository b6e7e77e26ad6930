"""Expression functions: Spark SQL expression text in, expression text out.

Use the result with ``F.expr`` or ``selectExpr``. Text keeps a profile's several hundred
expressions to one call each from Python to the JVM, and reads the same inside the
lambdas of array functions.
"""
