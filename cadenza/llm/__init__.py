"""Operators of a training-data pipeline (dedup, WARC, tokens, HTML, quality, ...)."""
