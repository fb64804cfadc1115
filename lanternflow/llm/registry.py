"""Queries and SQL of this subpackage, for ``__spark_entry__``."""

from __future__ import annotations

from lanternflow.llm import decontamination, language_id, licences, mixing, secrets, simhash_dedup, token_files, topk_search, url_filter, warc

MODULES = (mixing, language_id, url_filter, topk_search, decontamination, secrets, simhash_dedup, warc, token_files, licences)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
