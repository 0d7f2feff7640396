"""Giving memory back between stages: Python workers serve many tasks, and allocators keep what is freed."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa


def release_unused() -> None:
    """Return freed memory of earlier tasks of this worker to the system, where the platform can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass
