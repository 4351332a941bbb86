"""Column functions: padded text, country codes, names, digests."""
