"""Operators for training-data pipelines: language ID, quality, near-dedup, secrets, packing, tokens, HTML, ANN, WARC."""
