"""Training-data operators: URL filters, WARC, joins, packing, dedup, quality, secrets, tokens, media."""
