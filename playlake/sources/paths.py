"""Layer path resolution for local paths and URIs alike."""

from __future__ import annotations

from pathlib import PurePath


def layer_path(root: str | PurePath, leaf: str) -> str:
    """``root`` + ``/`` + ``leaf`` with exactly one slash between them.

    Done on strings so that a ``scheme://bucket/prefix`` root keeps its scheme.
    """
    return str(root).rstrip("/") + "/" + leaf.strip("/")
