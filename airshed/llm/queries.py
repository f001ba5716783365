"""Queries of the corpus operators and the SQL that checks them, by name."""

from __future__ import annotations

from airshed.llm import (collocations, decontaminate, neighbours, packing, periodic, quality, sharding, simhash,
                         substring, tokencounts, toxicity, urlfilter, warc)

MODULES = (collocations, decontaminate, neighbours, packing, periodic, quality, sharding, simhash, substring,
           tokencounts, toxicity, urlfilter, warc)
QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
