"""Places of public vocabulary files."""

from __future__ import annotations


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, the same on the driver and the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)
