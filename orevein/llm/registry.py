"""The queries of the training-data operators and their SQL."""

from orevein.llm import (
    collocations, embedding_dedup, exact_dedup, license_scan, lm_scoring, minhash_dedup, mixing, packing, quality, topk_search, toxicity,
    url_filter, whitening,
)

_OPERATORS = (
    toxicity, lm_scoring, license_scan, exact_dedup, mixing, url_filter, minhash_dedup, packing, quality, embedding_dedup,
    whitening, collocations, topk_search,
)

QUERIES = {name: query for module in _OPERATORS for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _OPERATORS for name, sql in module.ORACLES.items()}
