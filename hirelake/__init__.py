"""hirelake: job-posting analytics as composable Spark DataFrame operators.

Every operator is a plain function ``DataFrame -> DataFrame`` that takes its
column names and its reference date (``as_of``) as arguments and performs no
action, so Catalyst sees one lazy plan from the scan to the sink.

Layout:
  sources/    readers, driver-table adapters, sinks
  functions/  column-expression helpers and fixed dictionaries
  operators/  fact, salary, skills, titles, wide, marts, public, ...
  plans/      end-to-end pipeline wiring
  streaming/  Structured Streaming landing of raw pages
"""

__version__ = "0.1.0"
