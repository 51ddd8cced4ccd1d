"""Registered queries: every operator over the given tables, with its SQL check."""

from __future__ import annotations

from .registry import oracles, registered

__all__ = ["oracles", "registered"]
