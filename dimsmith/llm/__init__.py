"""Operators for preparing language-model training data at cluster scale.

Each module holds one operator with a general interface and the thin
``opN_<name>`` query that applies it to its whole intended table.  Nothing
outside this folder (and ``corpus_pipeline.py``) imports it.
"""

from __future__ import annotations

from dimsmith.llm.registry import ORACLE, QUERIES  # noqa: F401
from dimsmith.llm import (  # noqa: F401  (import for registration)
    chat_format,
    mix_sources,
    line_templates,
    near_dedup,
    decontaminate,
    language_id,
    token_store,
    quality_rules,
    repeat_spans,
    url_filters,
    best_fit_packing,
    hard_negatives,
    importance_sampling,
)

__all__ = ["QUERIES", "ORACLE"]
