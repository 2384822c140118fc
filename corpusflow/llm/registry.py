"""All queries and DuckDB twins of this subpackage."""
from __future__ import annotations

from corpusflow.llm import (compression, embedding_dedup, jaccard, language, line_dedup, merkle, mixing, packing, ranked_search, sharding, toxicity,
                            url_filter, warc)

MODULES = (line_dedup, toxicity, compression, mixing, warc, embedding_dedup, language, sharding, packing, jaccard, ranked_search, merkle, url_filter)
QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in getattr(m, "ORACLE", {}).items()}
