"""busframes: vehicle-bus trace analytics as Spark DataFrame jobs.

Sub-packages:
  sources    text / binary trace scans and the signal dictionary
  functions  column expressions (bit fields, hex, time formats)
  operators  join + decode, reshaping, batching, partitioned writes
  sinks      statement / point / row / cell shaping and delivery
  plans      job specifications (source x replay x decode x filter x sink)
  streaming  the same decode pipeline over a growing directory of traces
"""

__version__ = "0.1.0"
