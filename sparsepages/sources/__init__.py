from sparsepages.sources.landings import (
    candidate_ids,
    expand_urls,
    read_responses,
    scan_responses,
    url_for,
    with_ids,
)

__all__ = [
    "candidate_ids",
    "expand_urls",
    "read_responses",
    "scan_responses",
    "url_for",
    "with_ids",
]
