"""Keyed state with event-time timers: order inside a key, thresholds that forget idle keys.

State of a key is held only as long as the watermark asks for it: rows wait until the watermark has passed them, and a key
without news for its time to live is dropped by a timer. The functions run on streams with a watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructType

#: Event time after which a key without news is forgotten.
TIME_TO_LIVE_MS = 3_600_000


def _milliseconds(times: pd.Series) -> pd.Series:
    return times.astype("datetime64[us]").astype("int64") // 1000


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


def in_key_order(events: DataFrame, key: str, time: str, tie: str, time_to_live_ms: int = TIME_TO_LIVE_MS) -> DataFrame:
    """STM-04: the rows of each key in event-time order (``tie`` decides equal times), with their ``place`` in the key from 1.

    Rows arrive in any order within the watermark's delay. They wait in the state of their key until the watermark has
    passed them, so a key holds the rows of one delay; a timer set to its oldest row gives them out when no more come.
    Rows behind the watermark are dropped by the engine. A key that has been idle for its time to live is forgotten and
    would count from 1 again. One file or offset limit per batch bounds what a task receives of a key.
    """
    columns = events.columns
    out = StructType([*events.schema.fields]).add("place", LongType())

    def step(_key: tuple, news: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, given = state.get if state.exists else (None, 0)
        waiting = ([_unpacked(held)] if held else []) + ([] if state.hasTimedOut else list(news))
        mark = state.getCurrentWatermarkMs()
        rows = pd.concat(waiting, ignore_index=True) if waiting else None
        if rows is None or rows.empty:
            if state.hasTimedOut:
                state.remove()
            return
        rows = rows.sort_values([time, tie], kind="stable", ignore_index=True)
        ready = _milliseconds(rows[time]) < mark
        done, rest = rows[ready], rows[~ready]
        state.update((_packed(rest) if len(rest) else None, int(given) + len(done)))
        timer = int(_milliseconds(rest[time]).min()) if len(rest) else mark + time_to_live_ms
        state.setTimeoutTimestamp(max(timer, mark + 1))
        if len(done):
            yield done[columns].assign(place=range(int(given) + 1, int(given) + len(done) + 1))

    return events.groupBy(key).applyInPandasWithState(
        step, out, "waiting binary, given long", "append", GroupStateTimeout.EventTimeTimeout)


def burden_alerts(events: DataFrame, key: str, time: str, limit: int, time_to_live_ms: int = TIME_TO_LIVE_MS) -> DataFrame:
    """STM-07: (key, n) of keys whose running count of events is above the limit, at each batch that adds to it.

    A count is kept while events of its key keep coming within the time to live, measured by the watermark; then a timer
    drops it. The state is a number per active key.
    """
    out = StructType([events.schema[key]]).add("n", LongType())

    def step(keys: tuple, news: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        n, newest = state.get if state.exists else (0, 0)
        for rows in news:
            n += len(rows)
            newest = max(newest, int(_milliseconds(rows[time]).max()))
        state.update((n, newest))
        state.setTimeoutTimestamp(max(newest, state.getCurrentWatermarkMs()) + time_to_live_ms)
        if n > limit:
            yield pd.DataFrame({key: [keys[0]], "n": [n]})

    return events.select(key, time).groupBy(key).applyInPandasWithState(
        step, out, "n long, newest long", "update", GroupStateTimeout.EventTimeTimeout)
