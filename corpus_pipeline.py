"""A corpus from raw documents: quality rules, line dedup, near-duplicates, personal data, packing."""

from __future__ import annotations

from rankweave.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
