"""Options trade analytics on Spark: typed tapes, Black-76 Greeks, trailing market state, ladder studies."""
