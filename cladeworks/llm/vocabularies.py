"""Where the public vocabulary files are; operators take their path as a parameter."""

from __future__ import annotations


def path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))
