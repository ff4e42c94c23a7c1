"""quoteloom: DataFrame and Structured Streaming operators for crypto spot,
perpetual and option market data."""
