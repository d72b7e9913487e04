"""Structured Streaming forms: daily counts, the latest row of each entity, and months replaced as they arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cohortloom.sources.sinks import TableSpec, write_table


def daily_counts(events: DataFrame, time: str = "ts", kind: str = "event_type", lateness: str = "1 day") -> DataFrame:
    """``day, kind, n`` of a stream of events; a day is final once the watermark has passed it."""
    days = events.withWatermark(time, lateness).groupBy(F.window(time, "1 day").alias("w"), kind).agg(F.count("*").alias("n"))
    return days.select(F.to_date("w.start").alias("day"), kind, "n")


def latest_rows(rows: DataFrame, key: str = "mono_id", time: str = "cohort_dt", value: str = "value") -> DataFrame:
    """``key, time, value`` of the latest row of each key so far: state is one row a key, updates are put out as they come."""

    def update(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        when, what = state.get if state.exists else (None, None)
        changed = False
        for batch in batches:
            for t, v in batch.sort_values(time, kind="stable")[[time, value]].itertuples(index=False):
                stamp = pd.Timestamp(t).isoformat()
                if when is None or stamp >= when:
                    when, what, changed = stamp, None if pd.isna(v) else float(v), True
        if changed:
            state.update((when, what))
            yield pd.DataFrame({key: [k[0]], time: [pd.Timestamp(when).date()], value: [what]})

    return rows.groupBy(key).applyInPandasWithState(update, f"{key} string, {time} date, {value} double", "seen string, value double", "update", GroupStateTimeout.NoTimeout)


def replace_months(rows: DataFrame, table: str, spec: TableSpec, checkpoint: str) -> StreamingQuery:
    """Each micro-batch replaces the months that it has; runs until what is there has been read."""
    return rows.writeStream.foreachBatch(lambda batch, _: write_table(batch, table, spec, "replace")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
