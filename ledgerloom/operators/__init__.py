"""Report computations: DataFrames and parameters in, one DataFrame out."""
