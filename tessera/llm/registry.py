"""Queries of this subpackage: ``queries()`` and ``oracle_sql()`` for the entry module."""

from __future__ import annotations

from . import (  # noqa: F401 - they register their queries
    base,
    bpe_bitmap,
    crossparse_lang,
    dimension_scan,
    hmm_scores,
    kk_packing,
    line_dedup,
    random_secrets,
    simhash_trie,
    spotsigs,
    superkmer_dedup,
    term_scan,
    turn_repair,
    unigram_count,
)


def queries():
    return dict(sorted(base.QUERIES.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql():
    return dict(base.ORACLE)
