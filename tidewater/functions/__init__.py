"""Column -> Column expressions (the ``C`` family of the survey).

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen; none is a Python UDF.
"""
