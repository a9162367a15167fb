"""The registered queries: every operator over the given tables, with its SQL where SQL can say it."""

from skilltide.registry import demand, expressions, ingest, lake, model, normalize, parse  # noqa: F401
from skilltide.registry.core import REGISTRY

__all__ = ["REGISTRY"]
