"""All queries outside the llm subpackage, with their oracles."""

from __future__ import annotations

from screenloom.plans import catalog, dealt, screens  # noqa: F401 - screens adds its queries to those of catalog

FLAGSHIP = "c11_global_de"
QUERIES = {**dealt.QUERIES, **catalog.QUERIES}
ORACLES = {**dealt.ORACLES, **catalog.ORACLES}
