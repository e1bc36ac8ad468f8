from sparsepages.plans.linking import (
    assemble_pages,
    classified_records,
    home_page,
    last_id,
    nav_links,
    page_of,
    pages,
)

__all__ = [
    "assemble_pages",
    "classified_records",
    "home_page",
    "last_id",
    "nav_links",
    "page_of",
    "pages",
]
