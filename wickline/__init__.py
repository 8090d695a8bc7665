"""Candlestick (OHLCV) tables on Spark: ingest, refine, validate, aggregate, report."""
