"""Table operators: DataFrame in, DataFrame (or a few fitted scalars) out."""
