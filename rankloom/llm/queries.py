"""All registered queries of the subpackage."""

from rankloom.llm import q_chat, q_codes, q_decontaminate, q_embeddings, q_filters, q_language, q_pii, q_quality, q_search, q_simhash, q_tokens, q_urls  # noqa: F401
from rankloom.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
