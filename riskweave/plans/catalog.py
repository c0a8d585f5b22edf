"""All registered queries."""

from . import (  # noqa: F401
    cleaning_queries,
    kpi_queries,
    model_queries,
    scoring_queries,
    segment_queries,
    source_queries,
    streaming_queries,
    window_queries,
)
from .registry import ORACLES, QUERIES  # noqa: F401
