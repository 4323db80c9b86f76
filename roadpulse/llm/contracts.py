"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

from roadpulse.llm import (
    collocations,
    embeddings,
    fingerprints,
    html_extraction,
    mixing,
    ngram_join,
    packing,
    sentence_pieces,
    suffix_tree,
    token_files,
    toxicity,
    url_filters,
    whitening,
)

MODULES = (
    mixing, token_files, embeddings, url_filters, toxicity, suffix_tree, html_extraction, fingerprints, sentence_pieces, ngram_join,
    whitening, collocations, packing
)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
