"""Column-level building blocks (JVM-side expressions only)."""

from tapecraft.functions.columns import *  # noqa: F401,F403
