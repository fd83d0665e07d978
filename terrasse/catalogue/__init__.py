"""Driver queries; importing the package registers them all."""

from terrasse.catalogue import checks, figures, logs, people, products, registry, rows, tables  # noqa: F401
from terrasse.catalogue.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
