"""All queries of the library and their SQL."""

from corpus_mt.plans import file_queries, language_queries, oracles, queries

QUERIES = {**queries.QUERIES, **language_queries.QUERIES, **file_queries.QUERIES}
ORACLES = {**oracles.ORACLES, **language_queries.ORACLES, **file_queries.ORACLES}
