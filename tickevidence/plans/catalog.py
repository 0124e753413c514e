"""All registered queries; importing this module fills the registry."""

from __future__ import annotations

from tickevidence.plans import (  # noqa: F401
    queries_features,
    queries_files,
    queries_ingest,
    queries_joins,
    queries_ledger,
    queries_quality,
    queries_research,
    queries_samples,
    queries_streams,
    queries_time,
    queries_verified,
)
from tickevidence.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
