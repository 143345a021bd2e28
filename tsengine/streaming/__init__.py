"""Streaming.

The reference pulls bounded day ranges and has no streaming operator (no
watermark, state or late-data handling), so nothing is built here.  Landed
payload folders are read in batch by ``tsengine.sources.read_market_chart``.
"""
