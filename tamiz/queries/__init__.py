"""All registered queries; importing the package registers them."""

from tamiz.queries import figures, landing, loads, places, quality, series, texts  # noqa: F401
from tamiz.queries.base import CHECK_SQL, QUERIES

__all__ = ["CHECK_SQL", "QUERIES"]
