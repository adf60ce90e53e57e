"""tidemark: change-data-capture and lakehouse-modelling operators on Spark.

Sub-packages:
  sources    scans and sinks (landed JSON, topic records, CSV seeds, check results, catalog)
  functions  column expressions shared by every model (epoch millis, second boundaries, cleaning)
  operators  table operators (latest-per-key, CDC compaction and merges, SCD2, as-of join, checks)
  plans      the models built from those operators (staging, marts, metrics, monitoring)
  streaming  Structured Streaming jobs (append log, foreachBatch upsert)
"""

__version__ = "0.1.0"
