"""Structured Streaming: kline messages → long table, trailing averages, wide rows."""
