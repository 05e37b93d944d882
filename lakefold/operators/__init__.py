"""DataFrame -> DataFrame operators: merge, dedup, hierarchy, multi-line, ingest."""
