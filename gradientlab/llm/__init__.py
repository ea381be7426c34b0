"""Operators of a training-data pipeline, each with a query over the text tables."""

from .registry import REGISTRY, SQL

from . import queries  # noqa: F401

__all__ = ["REGISTRY", "SQL"]
