"""candlewick: a Spark-first engine for features of candle time series and their selection."""
