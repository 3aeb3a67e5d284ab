"""Registry of the queries over the driver's tables, with their SQL."""

from chronolex.queries import embeddings, ngrams  # noqa: F401
from chronolex.queries.base import ORACLE_SQL, QUERIES
from chronolex.queries.ngrams import flagship_top_ngrams

__all__ = ["ORACLE_SQL", "QUERIES", "flagship_top_ngrams"]
