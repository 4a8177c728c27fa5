"""What tasks remember, bounded, and given back when they end: Python workers live on from stage to stage."""

from __future__ import annotations

import ctypes
import gc


class Recent:
    """Results by key in two halves; the older one goes when the newer is full, so what is common stays."""

    def __init__(self, size: int) -> None:
        self.size, self.new, self.old = size, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value


def give_back() -> None:
    """Return freed memory to the system, where its allocators can."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it keeps its own counsel
