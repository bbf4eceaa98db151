"""The look-back state of the trends: each series' last daily rows before a date, kept beside the table.

A refresh from a date on needs, per series, the ``days`` newest daily rows
before it.  Ranking all earlier rows for them grows with the table's history;
instead a version of the flags table carries these rows as of a date (``before``),
and a later refresh ranks them with the few partitions since then.  The state
holds while no row before its date changes: a refresh from an earlier date ranks
all rows once more and leaves the state of its own date.  It moves on when it is
``STEP_DAYS`` behind, so a refresh reads at most that many partitions beside it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.operators import daily
from adlens.sources.snapshots import SnapshotTable, Version

STATE = "lookback"
STEP_DAYS = 30


def rows_before(table: SnapshotTable, version: Version | None, rows: Callable[[], DataFrame], first: dt.date,
                days: int) -> tuple[DataFrame, dict[str, DataFrame | None], dict]:
    """Each series' ``days`` newest rows before ``first``; and the companion table and notes to commit with what is derived from them.

    ``rows`` gives the daily rows; its partitions before the state's date are not read where the state serves.
    """
    note = (version.notes if version else {}).get(STATE)
    at = F.lit(first).cast("date")
    if note and dt.date.fromisoformat(note["before"]) <= first and note["rows"] >= days:
        before = dt.date.fromisoformat(note["before"])
        since = rows().filter((F.col("date") >= F.lit(before).cast("date")) & (F.col("date") < at))
        earlier = daily.lookback_rows(table.side(STATE, version).unionByName(since), days)
        if (first - before).days <= STEP_DAYS:
            return earlier, {}, {}
    else:
        earlier = daily.lookback_rows(rows().filter(F.col("date") < at), days)
    return earlier, {STATE: earlier}, {STATE: {"before": first.isoformat(), "rows": days}}


def as_date(value) -> dt.date:
    return value if isinstance(value, dt.date) and not isinstance(value, dt.datetime) else dt.date.fromisoformat(str(value)[:10])
