"""tapecraft: trade-tape analytics as plain Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark's own
expressions, windows, joins and Structured Streaming, so the same definitions
serve batch jobs, micro-batches and late-data recomputation.
"""

__version__ = "0.1.0"
