"""Names of runs: unique without any run knowing of another, and sorted by the time they began."""

from __future__ import annotations

import time
import uuid


def moment() -> int:
    """Microseconds since the epoch."""
    return time.time_ns() // 1000


def new_run() -> str:
    return f"{moment():017d}-{uuid.uuid4().hex[:12]}"


def began(run: str) -> int:
    """When a run began; a name that is none is as old as can be."""
    head = run.split("-")[0]
    return int(head) if head.isdigit() else 0
