"""flowlake: layered money-flow analytics on Spark DataFrames.

Layers:
  sources    -- readers/writers for delimited dumps, JSON landings, snapshot
                Parquet, silver and gold tables
  functions  -- Column-level cleaning rules and lookups (built-in Spark
                functions only, no Python UDFs)
  operators  -- silver (unify, clean, dedup), gold (rollups, network edges)
                and dashboard views; every operator takes and returns lazy
                DataFrames
  plans      -- size-checked join helpers, scratch locations, bindings of the
                test tables and the query catalogue
  streaming  -- incremental pick-up of newly landed snapshot files
"""

__version__ = "0.1.0"
