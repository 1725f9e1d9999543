"""All registered queries."""

from __future__ import annotations

from . import judging, modelling, preparation, shaping  # noqa: F401
from .modelling import flagship
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]
