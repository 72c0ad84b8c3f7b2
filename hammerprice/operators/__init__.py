"""DataFrame steps: each takes and returns DataFrames and names its columns by parameter."""
