"""Table jobs: each ``build`` maps input DataFrames to one output table, without I/O."""
