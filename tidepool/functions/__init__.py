"""Column functions: exact big integers, hex words, ratios, address text."""
