from .landing import (api_schema, compact_increments, ingest_increments, read_with_increments,  # noqa: F401
                      snapshot_stream)
