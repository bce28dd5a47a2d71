"""skyledger: flight-activity analytics as PySpark jobs.

Every operator takes and returns DataFrames built from Spark's own expressions;
`plans` composes them into the end-to-end jobs.
"""
