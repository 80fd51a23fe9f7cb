"""Table transforms: DataFrame in, DataFrame out."""
