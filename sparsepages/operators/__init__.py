from sparsepages.operators.joins import join_unique
from sparsepages.operators.lookup import latest_record, lookup_id, lookup_ids
from sparsepages.operators.nearest import (
    bounded_walk,
    clip_next,
    end_sentinel,
    gap_runs,
    largest_id,
    missing_ids,
    neighbours,
    neighbours_of,
    next_existing,
    prev_existing,
)
from sparsepages.operators.responses import (
    classify_outcome,
    decode_records,
    existing_ids,
    fill_defaults,
    filter_existing,
    latest_response,
    project_model,
    quarantine,
)
from sparsepages.operators.routing import classify_routes
from sparsepages.operators.rules import rule_quarantine, rule_report, tag_failures
from sparsepages.operators.traffic import cap_rate, exclude_handlers, sample_rate, tag_synthetic

__all__ = [
    "bounded_walk",
    "cap_rate",
    "classify_outcome",
    "classify_routes",
    "clip_next",
    "decode_records",
    "end_sentinel",
    "exclude_handlers",
    "existing_ids",
    "fill_defaults",
    "filter_existing",
    "gap_runs",
    "join_unique",
    "largest_id",
    "latest_record",
    "latest_response",
    "lookup_id",
    "lookup_ids",
    "missing_ids",
    "neighbours",
    "neighbours_of",
    "next_existing",
    "prev_existing",
    "project_model",
    "quarantine",
    "rule_quarantine",
    "rule_report",
    "sample_rate",
    "tag_failures",
    "tag_synthetic",
]
