"""DataFrame operators: each takes and returns DataFrames keyed by file_id and an explicit order column."""
