"""Import every query module so the registry is complete."""

from . import q_articles, q_composite, q_correlation, q_interpret, q_io, q_ml, q_more, q_series, q_tagging, queries  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
