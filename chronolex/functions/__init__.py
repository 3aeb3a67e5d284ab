"""Column expressions: tokens, codecs, numeric series."""
