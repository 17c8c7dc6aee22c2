"""All queries of this subpackage and their SQL."""

from __future__ import annotations

from logloom.llm import queries_corpus, queries_filters, queries_models, queries_structure, queries_tokens, queries_vectors  # noqa: F401
from logloom.llm.common import ORACLES, QUERIES  # noqa: F401
