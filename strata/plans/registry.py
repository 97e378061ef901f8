"""All registered queries of the library with their SQL, by name."""

from __future__ import annotations

from strata.plans import domain, kept, landing, ledgers, recency, tables

MODULES = (recency, tables, ledgers, domain, landing, kept)
QUERIES = {name: q for m in MODULES for name, q in m.QUERIES.items()}
ORACLE = {name: q for m in MODULES for name, q in m.ORACLE.items()}
