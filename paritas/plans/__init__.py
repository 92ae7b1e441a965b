"""Whole checks: meta, columns, hashes, and the three in a row."""

from .pair import ReconPair
from .runs import Run, pair_of

__all__ = ["ReconPair", "Run", "pair_of"]
