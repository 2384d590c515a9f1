"""DataFrame operators: `op(df, cols, *, ts, keys, …) -> DataFrame`."""
