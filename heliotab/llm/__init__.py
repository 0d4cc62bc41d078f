"""Operators for large training corpora, registered beside the other queries."""

from . import alignment, caps, chat, decontaminate, langid, nearest, pieces, repeats, secret_scan, simhash, toxicity, turns, warc  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
