"""A PySpark engine for year-stamped n-grams and diachronic embeddings."""
