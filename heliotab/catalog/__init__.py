"""Registered queries over the driver tables, with their SQL twins."""

from . import calendar_sums, classification, cleaning, comparison, enrichment, evaluation, files, jobs, modelling, profiling, streams  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
