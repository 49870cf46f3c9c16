"""All queries by name."""

from __future__ import annotations

from wearlens.plans.models import model_queries
from wearlens.plans.queries import batch_queries
from wearlens.plans.streams import stream_queries


def all_queries() -> dict:
    return {**batch_queries(), **model_queries(), **stream_queries()}
