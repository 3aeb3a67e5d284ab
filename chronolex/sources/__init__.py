"""Sources: n-gram lines, listings, ledgers, vocabularies, year corpora and models."""
