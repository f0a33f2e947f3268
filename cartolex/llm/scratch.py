"""Lineage cuts by :mod:`cartolex.staging`, names that clash with no column, and memory that a fit gives back."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterable

import pyarrow as pa

from cartolex.staging import release, shared_folder, shuffles_freed
from cartolex.staging import stage as cut

__all__ = ["cut", "fresh", "give_back", "release", "shared_folder", "shuffles_freed"]


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """``names``, each with as many leading underscores as it takes to differ from all that are ``taken``, in any case."""
    used = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def give_back() -> None:
    """Return what a finished fit held on the driver to the system: freed memory that allocators keep otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
