"""Per-user history features on a stream, and the alerts made from them.

State is kept per time slice and bucket of users, so that a batch meets few groups of many rows
instead of a group for nearly every row. An event goes to its own slice and, if it can still be in
a window of the next slice, as context to that one too, so a window finds all it needs in one
state. A user with very many events is thus spread over as many groups as there are slices; a batch
appends what it brings to the state of its groups, and an event-time timer drops a slice whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from txnspark.operators.scoring import mark_unknown_ips, stateful_alerts

WINDOW_SECONDS = 300
LATENESS_SECONDS = 3600
SLICE_SECONDS = 1800

#: Groups of users in a slice.
BUCKETS = 4

_HELD = T.StructType([T.StructField("rows", T.BinaryType())])
_EVENT = pa.schema([("user", pa.string()), ("id", pa.string()), ("micros", pa.int64()), ("cents", pa.int64())])


def _packed(events: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _EVENT) as writer:
        writer.write_table(pa.Table.from_pandas(events, _EVENT, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpacked(rows: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(rows).read_all().to_pandas()


class RecentHistory(StatefulProcessor):
    """Adds to each event the count and sum of its user's events in the window before it.

    The key is (slice, bucket of users). Events count in order of time and id; a late event sees what
    lies before it and has been delivered. An event whose user has one of the same time and id already is a copy
    and gives no row. A slice ends when the watermark has passed it: events that come later still
    get their row, but see, and know as copies, only what their own batch brings. Events without a
    time have no history.
    """

    def __init__(self, seconds: int, slice_seconds: int, names: list[str]):
        self.span, self.slice_seconds, self.names = seconds * 1_000_000, slice_seconds, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", _HELD)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [part for part in rows if len(part)]
        if not parts:
            return
        batch = pd.concat(parts, ignore_index=True)
        # the key of a slice without time is None or NaN
        if key[0] is None or key[0] != key[0]:
            yield batch.assign(history_count=0, history_cents=0)[self.names]
            return
        held = [_unpacked(entry[0]) for entry in self.held.get()]
        if not held:
            self.handle.registerTimer((int(key[0]) + 1) * self.slice_seconds * 1000)
        brought = pd.DataFrame(
            {
                "user": batch["user_id"].astype(object),
                "id": batch["event_id"].astype(object),
                "micros": batch["event_micros"].astype(np.int64),
                "cents": batch["event_cents"].astype(np.int64),
            }
        )
        known = pd.concat([*held, brought], ignore_index=True)
        is_copy = known.duplicated(["user", "micros", "id"]) & known["id"].notna()
        is_new = ~is_copy.to_numpy()
        before = len(known) - len(brought)
        fresh = is_new[before:]
        if fresh.any():
            self.held.appendValue((_packed(brought[fresh]),))
        count, cents = self._counted(known[is_new])
        # what was held has no copies, so the events that are new here stand last
        own = fresh & ~batch["is_context"].to_numpy(bool)
        if own.any():
            places = before + np.cumsum(fresh)[own] - 1
            yield batch[own].assign(history_count=count[places], history_cents=cents[places])[self.names]

    def _counted(self, known: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Count and sum of the window that ends with each event, in the events' order."""
        user = pd.factorize(known["user"], use_na_sentinel=False)[0].astype(np.int64)
        name = pd.factorize(known["id"].fillna(""), sort=True)[0]
        micros = known["micros"].to_numpy() - known["micros"].min()
        order = np.lexsort((name, micros, user))
        # users lie one after another, further apart than a window reaches
        at = (user * (micros.max() + self.span + 1) + micros)[order]
        begins = np.searchsorted(at, at - self.span)
        sums = np.concatenate([[0], np.cumsum(known["cents"].to_numpy()[order])])
        count, cents = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        count[order] = np.arange(1, len(at) + 1) - begins
        cents[order] = sums[1:] - sums[begins]
        return count, cents

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def routed(events: DataFrame, seconds: int, slice_seconds: int) -> DataFrame:
    """Each event with its slice, and once more as context of the next slice if windows there can hold it."""
    width = slice_seconds * 1_000_000
    timed = events.withColumns(
        {
            "event_micros": F.unix_micros("event_timestamp"),
            "event_cents": F.coalesce((F.col("amount") * 100).cast("bigint"), F.lit(0)),
        }
    )
    own = F.floor(F.col("event_micros") / width)
    place = lambda number, context: F.struct(number.alias("slice"), F.lit(context).alias("is_context"))
    near_end = F.col("event_micros") >= (own + 1) * width - seconds * 1_000_000
    places = F.when(near_end, F.array(place(own, False), place(own + 1, True))).otherwise(F.array(place(own, False)))
    return timed.withColumn("__place", F.explode(places)).select("*", "__place.*").drop("__place")


def with_history(
    events: DataFrame,
    seconds: int = WINDOW_SECONDS,
    zero_average: float = 1.0,
    lateness_seconds: int = LATENESS_SECONDS,
    slice_seconds: int = SLICE_SECONDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Adds ``tx_count_1h``, ``amount_avg_1h`` and ``amount_vs_avg`` over the last ``seconds``.

    A missing amount counts as zero. A slice is kept until all events are ``lateness_seconds`` past it.
    Its users are dealt over ``buckets`` groups, of which each must fit a task with all its events of the slice.
    """
    if slice_seconds < seconds:
        raise ValueError("a slice must be as long as the window, so that one slice back is enough")
    # the watermark stands on a copy of the time that does not reach the state, or late rows would be dropped
    marked = events.withColumn("__mark", F.col("event_timestamp")).withWatermark("__mark", f"{lateness_seconds} seconds")
    fields = [*events.schema.fields, T.StructField("history_count", T.LongType()), T.StructField("history_cents", T.LongType())]
    names = [field.name for field in fields]
    counted = (
        routed(marked, seconds, slice_seconds)
        .drop("__mark")
        .withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int"))
        .groupBy("slice", "bucket")
        .transformWithStateInPandas(RecentHistory(seconds, slice_seconds, names), T.StructType(fields), "Append", "EventTime")
    )
    mean = F.try_divide(F.col("history_cents").cast("double") / 100, F.col("history_count"))
    return counted.withColumns(
        {
            "tx_count_1h": F.col("history_count").cast("double"),
            "amount_avg_1h": mean,
            "amount_vs_avg": F.when(mean > 0, F.col("amount").cast("double") / mean).otherwise(
                F.lit(float(zero_average))
            ),
            "hour_of_day": F.hour("event_timestamp").cast("int"),
        }
    ).drop("history_count", "history_cents")


def scored_alerts(
    events: DataFrame,
    known_ips: DataFrame,
    add_probability: Callable[[DataFrame], DataFrame],
    seconds: int = WINDOW_SECONDS,
    threshold: float = 0.8336,
) -> DataFrame:
    """Alerts of a stream of events: history features, unknown-address rule, model.

    ``add_probability`` adds the column ``probability``, for example the transform of a saved
    model. The history counts events from unknown addresses as well.
    """
    featured = mark_unknown_ips(with_history(events, seconds), known_ips)
    return stateful_alerts(add_probability(featured), "probability", threshold)
