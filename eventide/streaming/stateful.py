"""Streams whose memory is keyed state (T2, T5, T6): RocksDB state, watermarks, timers and expiry.

Nothing stored is read again for a batch: a batch costs what it brings (T5: and the
live sessions of the buckets it touches).  Every
query takes the event time's watermark from ``delay``; events later than that
are dropped by Spark and counted in its progress (``numRowsDroppedByWatermark``),
and state whose time has passed is deleted.

Results are updates: one folder per epoch (overwritten on replay), in which a
key's newest epoch holds its current row (``current``).
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventide.functions.columns import ntz_to_instant
from eventide.operators import maintain
from eventide.session import scratch_path
from eventide.streaming.streams import _parts

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB (native memory and local disk, changes and snapshots in the
    checkpoint), in so many partitions if given; a resumed query keeps those it has.  An executor's partitions share
    their native memory (500 MB unless set otherwise)."""
    ours = {"spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
            "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
    if partitions:
        ours["spark.sql.shuffle.partitions"] = str(partitions)
    before = {key: spark.conf.get(key, None) for key in ours}
    for key, value in ours.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def run_available(writer, checkpoint: str) -> list[dict]:
    """Drain what is there (a later call with the same checkpoint goes on after it); the progress of its batches."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return [json.loads(p.json) for p in query.recentProgress]


def write_updates(updates: DataFrame, out: str, checkpoint: str, partition: Sequence[str] = (), partitions: int | None = None
                  ) -> list[dict]:
    """Write an update-mode stream, one folder per epoch."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").partitionBy(*partition).parquet(f"{out}/epoch={epoch}")

    with rocksdb_state(updates.sparkSession, partitions):
        return run_available(updates.writeStream.outputMode("update").foreachBatch(write), checkpoint)


def current(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of every key that ``write_updates`` wrote."""
    return maintain.latest_by(spark.read.option("basePath", out).parquet(out), list(keys), ["epoch"]).drop("epoch")


# ---- T2 ---------------------------------------------------------------------------
def last_writes(events: DataFrame, delay: str = "2 days") -> DataFrame:
    """The last write of each (event_date, event_id), by ingestion time, as an update stream.

    A streaming aggregate, so state and comparison stay in the JVM: one row per
    event until the watermark has passed the event's day.  Equal to U2
    (``dedup_events``) for writes that arrive within ``delay``.
    """
    keys, rest = ["event_date", "event_id"], [c for c in events.columns if c not in ("event_date", "event_id")]
    timed = events.withColumn("_at", ntz_to_instant(F.col("event_time"))).withWatermark("_at", delay)
    best = timed.groupBy(F.window("_at", "1 day").alias("_day"), *keys).agg(
        F.max(F.struct(F.struct("ingestion_time").alias("r"), F.struct(*rest).alias("w"))).alias("_best"))
    return best.select(*(F.col(c) if c in keys else F.col(f"_best.w.`{c}`").alias(c) for c in events.columns))


# ---- T5 ---------------------------------------------------------------------------
SESSION_ROW = T.StructType([T.StructField(n, t) for n, t in (
    ("session_id", T.StringType()), ("user_id", T.LongType()), ("first_event_time", T.TimestampNTZType()),
    ("last_event_time", T.TimestampNTZType()), ("total_events", T.LongType()), ("unique_event_types", T.LongType()),
    ("has_purchase", T.IntegerType()), ("total_premium", T.LongType()), ("first_channel", T.StringType()), ("first_city", T.StringType()),
    ("first_device_type", T.StringType()), ("event_sequence", T.ArrayType(T.StringType())), ("session_duration_seconds", T.LongType()))])
_TEXTS = ("session_id", "user_id", "event_type", "channel", "city", "device_type")
_NUMBERS = ("time", "event_id", "premium", "priced", "bought")
_UNKNOWN = -(1 << 40)                           # is_purchase is an int: below all of them
_HELD = T.StructType([T.StructField("events", T.BinaryType()), T.StructField("buckets", T.LongType())])


def _packed(events: dict[str, np.ndarray]) -> bytes:
    columns = [pa.array(events[c], pa.string()) for c in _TEXTS] + [pa.array(events[c], pa.int64()) for c in _NUMBERS]
    batch, sink = pa.RecordBatch.from_arrays(columns, [*_TEXTS, *_NUMBERS]), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(held: bytes) -> dict[str, np.ndarray]:
    table = pa.ipc.open_stream(held).read_all()
    return {c: table.column(c).to_numpy() for c in (*_TEXTS, *_NUMBERS)}


def _arrived(chunk: pd.DataFrame) -> dict[str, np.ndarray]:
    """The columns of arrived events; texts as objects, so that a null is None."""
    out = {c: chunk[c].to_numpy() for c in _TEXTS}
    out["time"] = chunk["event_time"].to_numpy().astype("datetime64[us]").astype("int64")
    if (out["time"] == np.iinfo("int64").min).any():
        raise ValueError("an event without a time belongs to no place of its session")
    return out | {c: chunk[c].to_numpy().astype("int64") for c in _NUMBERS if c != "time"}


class _Sessions:
    """Events of the sessions of a bucket, sorted by session, time and id."""

    def __init__(self, events: dict[str, np.ndarray], keep_ms: int):
        code = {c: pd.factorize(events[c])[0].astype("int64") + 1 for c in ("session_id", "user_id")}         # 0: null
        code = code["session_id"] * (code["user_id"].max() + 1) + code["user_id"]
        self.order = np.lexsort((events["event_id"], events["time"], code))
        self.events, code = {c: v[self.order] for c, v in events.items()}, code[self.order]
        self.starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        self.stops = np.r_[self.starts[1:], len(code)]
        self.number = np.repeat(np.arange(len(self.starts)), self.stops - self.starts)      # an event's session
        self.ends = self.events["time"][self.stops - 1] // 1_000_000 * 1000 + keep_ms

    def rows(self, of: np.ndarray) -> pd.DataFrame:
        """A3's rows of these sessions; numbers as objects, so that none passes through a float."""
        e, starts, n = self.events, self.starts, len(self.starts)
        first, last = starts[of], self.stops[of] - 1
        kind, kinds = pd.factorize(e["event_type"])
        seen = np.unique((self.number * (len(kinds) + 1) + kind)[kind >= 0]) // (len(kinds) + 1)
        bought, priced = np.maximum.reduceat(e["bought"], starts)[of], np.add.reduceat(e["priced"], starts)[of]
        if np.abs(np.add.reduceat(e["premium"].astype(float), starts)).max() >= 2.0 ** 63:
            raise OverflowError("a session's total premium exceeds a long")
        premium, sequence = np.add.reduceat(e["premium"], starts)[of], e["event_type"].tolist()
        seconds = e["time"] // 1_000_000
        numbers = {"total_events": self.stops[of] - first, "unique_event_types": np.bincount(seen, minlength=n)[of],
                   "has_purchase": [None if x == _UNKNOWN else x for x in bought.tolist()],
                   "total_premium": [x if some else None for x, some in zip(premium.tolist(), priced.tolist())],
                   "session_duration_seconds": seconds[last] - seconds[first],
                   "user_id": [None if x is None else int(x) for x in e["user_id"][first]]}
        out = {c: pd.Series(list(v), dtype=object) for c, v in numbers.items()}
        out |= {"session_id": e["session_id"][first], "first_channel": e["channel"][first], "first_city": e["city"][first],
                "first_device_type": e["device_type"][first], "event_sequence": [sequence[a:b] for a, b in zip(first, last + 1)],
                "first_event_time": e["time"][first].astype("datetime64[us]"), "last_event_time": e["time"][last].astype("datetime64[us]")}
        return pd.DataFrame(out)[SESSION_ROW.names]


def session_row(session_id, user_id, events: list[tuple]) -> Row:
    """A3's row of one session from its events: (time, id, type, channel, city, device, premium, is_purchase)."""
    time, ids, kind, channel, city, device, premium, bought = map(list, zip(*events))
    texts = {"session_id": [session_id] * len(ids), "user_id": [None if user_id is None else str(user_id)] * len(ids), "event_type": kind,
             "channel": channel, "city": city, "device_type": device}
    numbers = {"time": np.array(time, "datetime64[us]").astype("int64"), "event_id": ids, "premium": [x or 0 for x in premium],
               "priced": [x is not None for x in premium], "bought": [_UNKNOWN if x is None else x for x in bought]}
    row = _Sessions({c: np.array(v, object) for c, v in texts.items()} | {c: np.array(v, "int64") for c, v in numbers.items()}, 0).rows(np.arange(1))
    return Row(**{c: v[0].to_pydatetime() if c.endswith("_event_time") else v[0] for c, v in row.items()})


def rebuild_sessions(chunks: Iterator[pd.DataFrame], state, keep_ms: int, buckets: int) -> Iterator[pd.DataFrame]:
    """Rows of the sessions that ``chunks`` bring events of; state holds the bucket's sessions until ``keep_ms`` after their newest
    event, and a timeout comes when the next of them ends."""
    new = [_arrived(c) for c in chunks if len(c)]
    parts, known = new, 0
    if state.exists:
        held, of = state.get
        if of != buckets:
            raise ValueError(f"the state was written with {of} buckets of sessions, not {buckets}")
        parts = [_unpacked(held), *new]
        known = len(parts[0]["time"])
    if not parts:
        return
    sessions = _Sessions({c: np.concatenate([p[c] for p in parts]) for c in (*_TEXTS, *_NUMBERS)}, keep_ms)
    if new:
        yield sessions.rows(np.unique(sessions.number[sessions.order >= known]))
    alive = sessions.ends >= state.getCurrentWatermarkMs()
    if alive.any():
        state.update((_packed({c: v[alive[sessions.number]] for c, v in sessions.events.items()}), buckets))
        state.setTimeoutTimestamp(max(int(sessions.ends[alive].min()), 1))
    elif state.exists:
        state.remove()


def sessions(events: DataFrame, delay: str = "2 days", keep: dt.timedelta = dt.timedelta(days=2), buckets: int = 1024) -> DataFrame:
    """T5: A3's row of every session a batch brings events of, as an update stream.

    Equal to A3 for events that arrive within ``delay``.  A session is held for
    ``keep`` of event time after its newest event; events that follow a longer
    pause begin a session row anew.

    State is keyed by bucket of sessions (a hash) and not by session: Python is called, and its state read and
    written, once a bucket and batch, and works on arrays.  A bucket holds its live sessions only.  ``buckets`` is
    part of the state: a resumed query must be given the same number, another one is refused.
    """
    keep_ms = keep // dt.timedelta(milliseconds=1)
    timed = events.withColumn("_at", ntz_to_instant(F.col("event_time"))).withWatermark("_at", delay)
    rows = timed.select(
        F.pmod(F.xxhash64("session_id", "user_id"), F.lit(buckets)).alias("bucket"), "_at", "event_time", "session_id",
        F.col("user_id").cast("string").alias("user_id"), "event_type", "channel", "city", "device_type",
        F.coalesce(F.col("event_id").cast("long"), F.lit(-(1 << 63))).alias("event_id"),
        F.coalesce(F.col("premium_amount").cast("long"), F.lit(0)).alias("premium"),
        F.col("premium_amount").isNotNull().cast("long").alias("priced"),
        F.coalesce(F.col("is_purchase").cast("long"), F.lit(_UNKNOWN)).alias("bought"))

    def rebuild(key, chunks, state):
        return rebuild_sessions(chunks, state, keep_ms, buckets)

    return rows.groupBy("bucket").applyInPandasWithState(rebuild, SESSION_ROW, _HELD, "update", "EventTimeTimeout")


# ---- T6 ---------------------------------------------------------------------------
ORDER_FIELDS = ["order_id", "insurance_type", "policy_number"]
PAYMENT_FIELDS = ["transaction_id", "payment_method", "payment_status", "total_amount", "payment_date"]


_WAITS = ("side", "id", "at", "lo", "hi", "met")
_LEFT, _RIGHT, _ALONE = 0, 1, 2                  # sides; alone: a left row that can meet nothing


_MOST_PAIRS = 1 << 20                            # at a time, unless one left row has more


def _pairs(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs of equal keys, in slices of left rows."""
    order = np.argsort(right, kind="stable")
    first = np.searchsorted(right[order], left, "left")
    many = np.searchsorted(right[order], left, "right") - first
    ends, start = np.cumsum(many), 0
    while start < len(left):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] - many[start] + _MOST_PAIRS, "right")))
        some = many[start:stop]
        nth = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        yield np.repeat(np.arange(start, stop), some), order[np.repeat(first[start:stop], some) + nth]
        start = stop


def _waiting(chunk: pd.DataFrame, numbers: Sequence[str]) -> pa.Table:
    columns = [pa.array(chunk[c].to_numpy().astype("int64")) for c in numbers] + [pa.array(chunk["payload"].to_numpy(), pa.string())]
    return pa.table(columns, [*numbers, "payload"])


def _meet(chunks: Iterator[pd.DataFrame], state, buckets: int, what: str, names: tuple[str, str], same: Sequence[str] = ()
          ) -> Iterator[pd.DataFrame]:
    """A left join within a bucket of keys: pairs in which at least one row is new, and left rows that end without a pair.

    Rows wait in state until ``hi``, the last time of a row that could meet them; of two rows the right one's time must lie
    between the left one's ``lo`` and ``hi``, and they must agree in ``id`` and the columns ``same``.  Python looks at keys
    and times only; payloads are passed on as they are.
    """
    tables, known = [_waiting(c, (*_WAITS, *same)) for c in chunks if len(c)], 0
    if state.exists:
        held, of = state.get
        if of != buckets:
            raise ValueError(f"the state was written with {of} buckets of {what}, not {buckets}")
        tables.insert(0, pa.ipc.open_stream(held).read_all())
        known = tables[0].num_rows
    if not tables:
        return
    table = pa.concat_tables(tables)
    side, key, at, lo, hi, met = (table.column(c).to_numpy() for c in _WAITS)
    new, met = np.arange(len(side)) >= known, met.copy()
    left, right = np.flatnonzero(side == _LEFT), np.flatnonzero(side == _RIGHT)
    agree, payload = [table.column(c).to_numpy() for c in same], table.column("payload")

    def texts(rows: np.ndarray) -> np.ndarray:
        return payload.take(pa.array(rows)).to_numpy()

    fresh, asked = left[new[left]], np.unique(key[left[new[left]]])
    if len(asked):                              # else no stored right row can make a new pair
        old = right[~new[right]]
        old = old[asked[np.minimum(np.searchsorted(asked, key[old]), len(asked) - 1)] == key[old]]
    else:
        old = right[:0]
    right = right[new[right]]
    for lefts, rights in ((fresh, np.r_[old, right]), (left[~new[left]], right)):
        for l, r in _pairs(key[lefts], key[rights]):
            l, r = lefts[l], rights[r]
            ok = (lo[l] <= at[r]) & (at[r] <= hi[l])
            for value in agree:
                ok &= value[l] == value[r]
            l, r = l[ok], r[ok]
            met[l] = 1
            if len(l):
                yield pd.DataFrame({names[0]: texts(l), names[1]: texts(r)})
    over = hi <= state.getCurrentWatermarkMs() * 1000
    alone = np.flatnonzero((side == _ALONE) | (side == _LEFT) & over & (met == 0))
    if len(alone):
        yield pd.DataFrame({names[0]: texts(alone), names[1]: np.full(len(alone), None, object)})
    waits = (side != _ALONE) & ~over
    if waits.any():
        rest = table.set_column(_WAITS.index("met"), "met", pa.array(met)).filter(pa.array(waits)).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rest.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
            writer.write_table(rest)
        state.update((sink.getvalue().to_pybytes(), buckets))
        state.setTimeoutTimestamp(max(-(-int(hi[waits].min()) // 1000), 1))
    elif state.exists:
        state.remove()


def meet_payments(chunks: Iterator[pd.DataFrame], state, buckets: int) -> Iterator[pd.DataFrame]:
    """Purchases and payments of a bucket of orders."""
    return _meet(chunks, state, buckets, "orders", ("purchase", "payment"))


_HELD_UNTIL = T.StructType([*_HELD.fields, T.StructField("until", T.LongType())])


class MeetOrders(StatefulProcessor):
    """Purchases and orders of a bucket of users and days.  Rows carry the time that the next join may take them at."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.held = handle, handle.getValueState("held", _HELD_UNTIL)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = _Held(self.held.get(), timerValues.getCurrentWatermarkInMs())
        before = state.until
        for met in _meet(rows, state, self.buckets, "users", ("purchase", "order"), ("user", "day")):
            yield met.assign(seen=pd.Timestamp(state.watermark + 1, unit="ms", tz="UTC"))
        if state.exists:
            self.held.update((*state.get, state.until))
        elif before is not None:
            self.held.clear()
        if before is not None and before != state.until and before > state.watermark:      # else it ends by itself
            self.handle.deleteTimer(before)
        if state.exists and before != state.until:
            self.handle.registerTimer(state.until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.held.get()
        if held is not None and held[2] <= expiredTimerInfo.getExpiryTimeInMs():     # else a later timer waits
            yield from self.handleInputRows(key, (), timerValues)

    def close(self) -> None:
        pass


class _Held:
    """The state of a bucket in one call, as a group state."""

    def __init__(self, held, watermark: int):
        self.get, self.until, self.watermark = (held[:2], held[2], watermark) if held else (None, None, watermark)

    @property
    def exists(self) -> bool:
        return self.get is not None

    def update(self, value: tuple) -> None:
        self.get = value

    def remove(self) -> None:
        self.get = self.until = None

    def getCurrentWatermarkMs(self) -> int:
        return self.watermark

    def setTimeoutTimestamp(self, until: int) -> None:
        self.until = until


def _payload(*columns: str):
    """Values as a JSON array of their texts: Python passes it on without reading it."""
    return F.to_json(F.array(*(F.col(c).cast("string") for c in columns)))


def _values(payload: str, types: dict[str, T.DataType]) -> list:
    values = F.from_json(F.col(payload), "array<string>")
    return [values[i].cast(kind).alias(c) for i, (c, kind) in enumerate(types.items())]


def purchase_payments(purchases: DataFrame, orders: DataFrame, payments: DataFrame, delay: str = "1 day",
                      order_bound: str = "1 day", payment_bound: str = "40 days", buckets: int = 1024) -> DataFrame:
    """Purchases left-joined to orders, then to payments, as all three arrive.

    Two chained left joins of streams.  Orders meet a purchase by user and
    day, payments by order_id; both within a bound of the purchase's time, which
    with the watermarks of all three sources tells when a purchase can
    meet no further order and an order no further payment: the row is then
    emitted with NULLs and its state dropped.  Times are TIMESTAMP columns
    ``event_time``, ``order_ts`` and ``payment_ts``.

    State is keyed by bucket (a hash of user and day, then of the order) and worked on as arrays (``_meet``); ``buckets`` is
    part of it, as in ``sessions``.  A purchase reaches the second join at most ``order_bound`` behind the watermark, so
    payments wait so much longer.
    """
    bought = {c: purchases.schema[c].dataType for c in ("event_id", "user_id", "event_date", "premium_amount")}
    ordered = {**{c: orders.schema[c].dataType for c in ORDER_FIELDS}, "order_premium_amount": orders.schema["premium_amount"].dataType}
    paid = {c: payments.schema[c].dataType for c in PAYMENT_FIELDS}

    def waiting(side, bucket, key, at, lo, hi, payload, seen, **same):
        numbers = {"side": side, "id": key, "at": F.unix_micros(at), "lo": F.unix_micros(lo), "hi": F.unix_micros(hi), "met": F.lit(0), **same}
        return [seen.alias("seen"), F.pmod(bucket, F.lit(buckets)).alias("bucket"), payload.alias("payload"),
                *(F.coalesce(v.cast("long"), F.lit(0)).alias(c) for c, v in numbers.items())]

    # purchases and orders
    bound = F.expr(f"INTERVAL {order_bound}")
    e, o = purchases.withWatermark("event_time", delay), orders.withWatermark("order_ts", delay)
    by_day, at = F.xxhash64(F.col("user_id").cast("long"), "day"), F.col("event_time")
    complete = F.col("user_id").isNotNull() & F.col("day").isNotNull() & at.isNotNull()
    e = e.withColumn("day", F.col("event_date").cast("date")).withColumn("micros", F.unix_micros("event_time")).select(
        waiting(F.when(complete, _LEFT).otherwise(_ALONE), F.when(complete, by_day).otherwise(F.xxhash64("event_id")), by_day, at, at - bound,
                at + bound, _payload(*bought, "micros"), at, user=F.col("user_id"), day=F.unix_date("day")))
    at = F.col("order_ts")
    o = (o.filter("user_id is not null and order_date is not null and order_ts is not null")
         .withColumn("day", F.col("order_date").cast("date")).withColumn("order_premium_amount", F.col("premium_amount"))
         .select(waiting(F.lit(_RIGHT), by_day, by_day, at, at, at + bound, _payload(*ordered), at, user=F.col("user_id"), day=F.unix_date("day"))))
    met = e.union(o).groupBy("bucket").transformWithStateInPandas(
        MeetOrders(buckets), "purchase string, order string, seen timestamp", "append", "eventTime", eventTimeColumnName="seen")
    met = met.select("seen", *_values("purchase", {**bought, "micros": T.LongType()}), *_values("order", ordered))

    # these and payments
    bound = F.expr(f"INTERVAL {payment_bound}")
    by_order, at = F.xxhash64("order_id"), F.timestamp_micros("micros")
    complete = F.col("order_id").isNotNull() & F.col("micros").isNotNull()
    met = met.select(waiting(F.when(complete, _LEFT).otherwise(_ALONE), F.when(complete, by_order).otherwise(F.xxhash64("event_id", "user_id")),
                             F.col("order_id"), at, at - bound, at + bound, _payload(*bought, *ordered), F.col("seen")))
    f, at = payments.withWatermark("payment_ts", delay), F.col("payment_ts")
    f = (f.filter("order_id is not null and payment_ts is not null").withColumn("order_id", F.col("order_id").cast(ordered["order_id"]))
         .select(waiting(F.lit(_RIGHT), by_order, F.col("order_id"), at, at, at + bound + F.expr(f"INTERVAL {order_bound}"),
                         _payload(*paid), at)))

    def meet(key, chunks, state):
        return meet_payments(chunks, state, buckets)

    pairs = met.union(f).groupBy("bucket").applyInPandasWithState(meet, "purchase string, payment string", _HELD, "append", "EventTimeTimeout")
    return pairs.select(*_values("purchase", {**bought, **ordered}), *_values("payment", paid))


def append_rows(joined: DataFrame, out: str, checkpoint: str, partitions: int | None = None) -> list[dict]:
    """Run an append-mode stream into a Parquet sink (exactly once)."""
    with rocksdb_state(joined.sparkSession, partitions):
        return run_available(joined.writeStream.format("parquet").option("path", out), checkpoint)


def heartbeat(spark: SparkSession, path: str, schema: T.StructType, values: dict) -> None:
    """Append one row that carries a late time, and keys that meet nothing, to a source: nothing older will follow.

    With a heartbeat in each source the watermark passes every waiting row, so
    both joins close.  Its file is dated after all others, so that a file stream
    takes it last.  Keys must not be null: Spark filters such rows before it
    takes their time.
    """
    fs, parts = _parts(spark, path)
    row = spark.range(1).select(*(F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields))
    row.coalesce(1).write.mode("append").parquet(path)
    known, newest = {f.getPath().getName() for f in parts}, max((f.getModificationTime() for f in parts), default=0)
    for f in _parts(spark, path)[1]:
        if f.getPath().getName() not in known:
            fs.setTimes(f.getPath(), max(newest + 1000, f.getModificationTime()), -1)


def purchase_payment_rows(spark: SparkSession, out: str) -> DataFrame:
    """What the sink holds, without heartbeats."""
    return spark.read.parquet(out).filter("not (event_id <=> -1 and user_id <=> -1)")


def drain_purchase_payments(spark: SparkSession, sources: dict[str, tuple[str, T.StructType]], close_at: dt.datetime,
                            name: str = "purchase-payments", max_files: int | dict[str, int] | None = None,
                            partitions: int | None = None, buckets: int = 1024, **bounds: str) -> DataFrame:
    """T6 over three bounded sources (``purchases``, ``orders``, ``payments``: folder and schema), closed by their heartbeats.

    A heartbeat ends each source, so the run that drains them closes both
    joins too; the watermark is that of the slowest source, so none closes early.
    """
    out, checkpoint = scratch_path(spark, f"{name}-sink"), scratch_path(spark, f"{name}-checkpoint")
    for source, values in (("purchases", {"event_id": -1, "user_id": -1, "event_date": close_at, "event_time": close_at}),
                           ("orders", {"order_id": -2, "user_id": -2, "order_date": close_at, "order_ts": close_at}),
                           ("payments", {"order_id": -3, "payment_ts": close_at})):
        heartbeat(spark, *sources[source], values)

    def read(source):
        path, schema = sources[source]
        reader = spark.readStream.schema(schema)
        limit = max_files.get(source) if isinstance(max_files, dict) else max_files
        return (reader.option("maxFilesPerTrigger", limit) if limit else reader).parquet(path)

    append_rows(purchase_payments(read("purchases"), read("orders"), read("payments"), buckets=buckets, **bounds), out, checkpoint, partitions)
    return purchase_payment_rows(spark, out)
