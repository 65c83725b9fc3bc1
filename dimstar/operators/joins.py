"""Joins with sides whose size is measured before the plan is fixed.

The static planner cannot know how small an aggregate-derived side will be
(duplicated ids, the valid parent keys of a foreign-key rule), so it plans a
shuffle join and the large side is shuffled before AQE can switch to a
broadcast. Here the small sides are stored and counted first; each is
broadcast only when its count is under a row bound, otherwise the join stays a
shuffle join (AQE still splits skewed partitions there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

# Narrow sides only (a key and one or two values): 1M rows stay well under 64 MB.
BROADCAST_MAX_ROWS = 1_000_000


def measured(smalls: list[DataFrame], max_rows: int | None = None) -> list[tuple[DataFrame, bool]]:
    """Store ``smalls``, count them (from the files' footers) and return each
    one broadcast-hinted when its count is at most ``max_rows``, unchanged
    otherwise, with whether it is hinted."""
    max_rows = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    found = []
    for s in smalls:
        s = stored(s, "side")
        small = s.count() <= max_rows
        found.append((F.broadcast(s) if small else s, small))
    return found
