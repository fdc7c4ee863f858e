"""cardwatch: a Spark-native daily pipeline for suspicious card operations.

Layers:
  sources/    landing-file readers, seed loading, date discovery, fixture adapters
  functions/  column expressions (date shifts, epoch gaps, name concat, file dates)
  operators/  SCD2 diff/merge, fact appends, the report view, the four fraud rules
  plans/      bootstrap / run_day / backfill with ledger and audit; the query registry
  streaming/  optional micro-batch ingestion of landing files (availableNow)
"""

__version__ = "0.1.0"
