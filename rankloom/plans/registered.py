"""All registered queries."""

from rankloom.plans import q_encode, q_functions, q_ml, q_relational, q_sources, q_vocab  # noqa: F401
from rankloom.plans.catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
