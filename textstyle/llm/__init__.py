"""Operators that prepare training data for language models, with their queries."""

from __future__ import annotations

from textstyle.llm.tables import ORACLES, QUERIES
from textstyle.llm import queries  # noqa: F401, E402

__all__ = ["ORACLES", "QUERIES"]
