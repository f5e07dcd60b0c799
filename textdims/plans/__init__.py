"""Registered queries (one per operator of the inventory) and their SQL oracles."""

from . import q_clean, q_dims, q_io, q_keyness, q_more, q_neardup  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
