"""marginalia: wiki and issue-tracker corpus analytics as Spark DataFrame jobs.

Sub-packages:
  functions  native Column expressions (text scalars, URLs, entity codec)
  operators  DataFrame -> DataFrame jobs (threads, summaries, markup, ...)
  sources    readers with explicit schemas, sinks, adapters from driver tables
  plans      shared plan building blocks (skew-safe ordered scans, lineage cuts)
  streaming  incremental variants of the batch jobs over Structured Streaming
"""

__version__ = "0.1.0"
