"""Imports every query module, so that the registry is complete."""

from . import q_checks, q_differences, q_estate, q_meta, q_nested, q_scalars, q_sources  # noqa: F401
from .registry import QUERIES, TWINS

__all__ = ["QUERIES", "TWINS"]
