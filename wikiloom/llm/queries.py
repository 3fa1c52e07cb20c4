"""All queries of this subpackage, with SQL texts where SQL can express them."""

from wikiloom.llm import (  # noqa: F401
    chat_queries,
    dedup_queries,
    divergence_queries,
    language_queries,
    pii_queries,
    quality_queries,
    token_queries,
    trie_queries,
    warc_queries,
)
from wikiloom.llm.registry import QUERIES, SQL  # noqa: F401
