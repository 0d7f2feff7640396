"""Structured Streaming: append-mode bar reducer and keyed upsert of touched windows."""
