"""DataFrame operators; each takes and returns DataFrames (plus small parameter tables)."""
