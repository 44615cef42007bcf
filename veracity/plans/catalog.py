"""Imports every query module so that the registry is complete."""

from veracity.plans import q_clean, q_io, q_losses, q_models, q_pool, q_scores, q_splits, q_stream, q_tokens, q_words  # noqa: F401
from veracity.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
