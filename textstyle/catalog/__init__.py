"""Ready-made queries over the test tables, each with an ANSI SQL twin."""

from __future__ import annotations

from textstyle.catalog.registry import ORACLES, QUERIES
from textstyle.catalog import corpus, text, terms, learning, streams  # noqa: F401, E402

__all__ = ["ORACLES", "QUERIES"]
