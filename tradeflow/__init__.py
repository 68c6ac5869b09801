"""Trade analytics on Spark: message streams, hot and cold trades, stock
universe, chart series and a price forecast."""
