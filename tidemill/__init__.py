"""Real-time commerce analytics as Spark DataFrame pipelines.

``functions``  column expressions
``operators``  reusable DataFrame -> DataFrame steps (dedup, joins, windows, terms, paging)
``plans``      the pipelines and published queries built from them
``sources``    topics, change log, serving tables, views over the given tables
``streaming``  keyed tables, sinks and the Structured Streaming jobs
"""
