"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from touchline.llm import conversations, html_text, language, lexicon, licenses, near_dups, packing, periods, quality, secrets, topk, vector_dups, warc

_MODULES = [licenses, topk, warc, vector_dups, secrets, html_text, lexicon, language, near_dups, packing, conversations, periods, quality]

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in _MODULES for name, sql in m.ORACLE_SQL.items()}
