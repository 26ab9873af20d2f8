"""The registered queries: bindings to the driver tables, Spark side and SQL side."""

from catalog import layers, loads, pricing, quality
from catalog.spec import REGISTRY

__all__ = ["REGISTRY", "layers", "loads", "pricing", "quality"]
