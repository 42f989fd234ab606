"""Streaming customer journey: purchase as-of (cart as-of view) per user.

Input is one stream carrying all three event kinds (``side``: 0 view, 1 cart,
2 purchase), dealt by a hash of the user into slices and fed to
``applyInPandasWithState`` (RocksDB state, one value per slice). A call matches
all rows of a slice's users by one sort, so its cost follows the rows, not the
users. A row travels as its user, time, kind, id and one JSON text of its other
columns, which Python only passes on. Kept per slice, as one Arrow table:

* recent views, and recent carts with the view each one attached when it was
  processed;
* ``waiting`` rows (mode ``on_watermark`` only): those not yet final.

Modes:

* ``on_arrival``: every row is processed when it arrives, against the rows seen
  so far (rows of one micro-batch in time order). A purchase is emitted at once;
  a cart or view that arrives later never revises it. This is the reference's
  behaviour.
* ``on_watermark``: rows wait until the watermark passes their time, then are
  processed in time order; a timeout at the earliest waiting row flushes slices
  that receive no new rows. The output then equals the batch as-of join for
  every row that is not later than the watermark delay. A bounded input needs
  one final row far in the future (``flush_row``) to move the watermark past
  the last rows.

State stays bounded: a view or cart older than the watermark can only matter
as its user's newest such row (later rows are never older than the watermark),
so all older ones are dropped. With a ``tolerance`` a timeout also drops rows
once the watermark is past their range, so users that never come back leave
nothing; without one that newest row has to stay.

Rows with a NULL time or user match nothing: such purchases pass by the state
and come out without a cart or view, other such rows are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.timestamps import micros_to_ntz

VIEW, CART, PURCHASE = 0, 1, 2
FLUSH_USER = "__flush__"

VIEW_COLS = ["view_product_id", "view_product_name", "view_category"]
CART_COLS = ["cart_product_id", "cart_product_name", "cart_quantity"]
BUY_COLS = ["order_id", "purchase_product_id", "purchase_product_name", "purchase_quantity",
            "total_amount", "payment_method"]

# Input rows: user_id is the grouping key; ts_us = event time in microseconds.
INPUT_SCHEMA = (
    "user_id string, side int, ts_us bigint, event_id string, "
    "view_product_id string, view_product_name string, view_category string, "
    "cart_product_id string, cart_product_name string, cart_quantity bigint, price double, "
    "order_id string, purchase_product_id string, purchase_product_name string, purchase_quantity bigint, "
    "total_amount double, payment_method string"
)
_INPUT_COLS = [c.split()[0] for c in INPUT_SCHEMA.split(", ")]
OUTPUT_SCHEMA = (
    "event_id string, user_id string, view_product_id string, view_product_name string, view_category string, "
    "ts_us bigint, cart_product_id string, cart_product_name string, cart_quantity bigint, price double, "
    "order_id string, purchase_product_id string, purchase_product_name string, purchase_quantity bigint, "
    "total_amount double, payment_method string"
)
_OUTPUT_COLS = [c.split()[0] for c in OUTPUT_SCHEMA.split(", ")]

#: Slices that users are dealt into; a slice's state and its rows of a micro-batch are in memory at once.
SLICES = 64
_KEPT = {"user_id": pa.string(), "ts_us": pa.int64(), "side": pa.int32(), "event_id": pa.string(), "payload": pa.string(),
         "viewed": pa.string(), "waiting": pa.bool_()}
# Columns of the JSON text, in it named by their place here.
_PAYLOAD = [c for c in _INPUT_COLS if c not in ("user_id", "side", "ts_us", "event_id")]
_PAYLOAD_SCHEMA = ", ".join(f"`{_PAYLOAD.index(c.split()[0])}` {c.split()[1]}" for c in INPUT_SCHEMA.split(", ")
                            if c.split()[0] in _PAYLOAD)
_MATCHED = "event_id string, user_id string, ts_us bigint, bought string, cart string, viewed string"


def tag_views(views: DataFrame, ts_us: Column) -> DataFrame:
    return _tag(views, VIEW, ts_us)


def tag_carts(carts: DataFrame, ts_us: Column) -> DataFrame:
    return _tag(carts, CART, ts_us)


def tag_purchases(purchases: DataFrame, ts_us: Column) -> DataFrame:
    return _tag(purchases, PURCHASE, ts_us)


def _tag(df: DataFrame, side: int, ts_us: Column) -> DataFrame:
    have = set(df.columns)
    cols = []
    for spec in INPUT_SCHEMA.split(", "):
        name, typ = spec.split()
        if name == "side":
            cols.append(F.lit(side).alias(name))
        elif name == "ts_us":
            cols.append(ts_us.alias(name))
        elif name in have:
            cols.append(F.col(name).cast(typ).alias(name))
        else:
            cols.append(F.lit(None).cast(typ).alias(name))
    return df.select(*cols)


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, pa.schema(_KEPT), preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


def _newest(of: np.ndarray, user: np.ndarray) -> np.ndarray:
    """For each row the last row up to it where ``of`` holds, if that is of the same user; else -1."""
    at = np.maximum.accumulate(np.where(of, np.arange(len(of)), -1))
    return np.where((at >= 0) & (user[at] == user), at, -1)


class JourneyMatcher:
    """``applyInPandasWithState`` function of one slice of users."""

    def __init__(self, mode: str = "on_watermark", tolerance_us: int | None = None):
        if mode not in ("on_arrival", "on_watermark"):
            raise ValueError("mode is on_arrival or on_watermark")
        self.mode = mode
        self.tolerance_us = tolerance_us

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        parts = [_unpacked(state.get[0])] if state.exists else []
        if not state.hasTimedOut:
            parts += [f.assign(viewed=None, waiting=True) for f in frames]
        rows = pd.concat([p[list(_KEPT)] for p in parts], ignore_index=True)
        wm = max(0, state.getCurrentWatermarkMs()) * 1000
        waiting = rows["waiting"].to_numpy(bool)
        later = waiting & (rows["ts_us"].to_numpy() > wm) & (self.mode == "on_watermark")
        out, kept = self._match(rows[~later], wm)
        if len(out):
            yield out
        due = [int(rows["ts_us"][later].min())] if later.any() else []
        if self.tolerance_us is not None and len(kept):
            due.append(int(kept["ts_us"].min()) + self.tolerance_us + 1)
        left = pd.concat([kept, rows[later]])
        if not len(left):
            state.remove()
            return
        state.update((_packed(left),))
        if due:  # looks again when a waiting row is due or a kept one out of range
            state.setTimeoutTimestamp(max(-(-min(due) // 1000), wm // 1000 + 1))

    def _match(self, rows: pd.DataFrame, wm: int) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Purchases with what they match, and the views and carts that later rows may match."""
        user = pd.factorize(rows["user_id"])[0]
        named = pd.factorize(rows["event_id"].fillna(""), sort=True)[0]
        # A purchase sees the carts, and a cart the views, of its own time too; of equal rows the last one counts.
        order = np.lexsort((named, rows["side"].to_numpy(), rows["ts_us"].to_numpy(), user))
        rows, user = rows.iloc[order], user[order]
        ts, side = rows["ts_us"].to_numpy(), rows["side"].to_numpy()
        payload, viewed = rows["payload"].to_numpy(object), rows["viewed"].to_numpy(object).copy()
        tol = np.iinfo(np.int64).max if self.tolerance_us is None else self.tolerance_us

        view = _newest(side == VIEW, user)
        fresh = (side == CART) & rows["waiting"].to_numpy(bool)
        found = fresh & (view >= 0) & (ts - ts[view] <= tol)
        viewed[found] = payload[view[found]]
        cart = _newest(side == CART, user)
        cart = np.where((cart >= 0) & (ts - ts[cart] <= tol), cart, -1)

        bought = side == PURCHASE
        of = cart[bought]
        out = rows.loc[bought, ["event_id", "user_id", "ts_us"]].assign(
            bought=payload[bought], cart=np.where(of >= 0, payload[of], None), viewed=np.where(of >= 0, viewed[of], None))

        kept = ~bought
        if wm:
            for kind in (VIEW, CART):
                of_kind = np.flatnonzero(side == kind)
                old = ts[of_kind] < wm
                # An old row is followed by another old one of its user and kind: it matches nothing more.
                passed = np.zeros(len(of_kind), bool)
                passed[:-1] = old[1:] & (user[of_kind][1:] == user[of_kind][:-1])
                kept[of_kind[old & (passed | (ts[of_kind] < wm - tol))]] = False
        return out, rows[kept].assign(viewed=viewed[kept], waiting=False)


_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ensure_rocksdb(spark) -> None:
    """The state of all users is kept in RocksDB, not on the heap; set it when the session
    uses another provider (it applies to queries started afterwards)."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != _ROCKSDB:
        spark.conf.set(key, _ROCKSDB)


def journey_stream(tagged: DataFrame, mode: str = "on_watermark", tolerance_us: int | None = None,
                   time_col: str = "event_time", delay: str = "8 days", dedup: bool = False, slices: int = SLICES) -> DataFrame:
    """Tagged union (see ``tag_*``) with an event-time column -> journey rows.

    ``time_col`` must be a ``timestamp`` (instant) column for the watermark.
    ``slices`` should follow the number of users; a checkpoint keeps it.
    With ``dedup`` an event that is delivered again within ``delay`` counts once:
    the ids seen are kept until the watermark is ``delay`` past their time. Rows
    without an id count once if all their columns are the same. (Purchases that
    match nothing for want of a user or a time are passed on as often as they come.)
    """
    _ensure_rocksdb(tagged.sparkSession)
    able = F.col("user_id").isNotNull() & F.col("ts_us").isNotNull() & F.col(time_col).isNotNull()
    keyed = tagged.where(able).withWatermark(time_col, delay)
    if dedup:
        row = F.xxhash64(*[F.col(c) for c in _INPUT_COLS]).cast("string")
        known = F.struct("side", F.col("event_id").isNull(), F.coalesce("event_id", row))
        keyed = keyed.withColumn("_event", known).dropDuplicatesWithinWatermark(["user_id", "_event"]).drop("_event")
    payload = F.to_json(F.struct(*[F.col(c).alias(str(i)) for i, c in enumerate(_PAYLOAD)]))
    slice_ = F.pmod(F.xxhash64("user_id"), F.lit(slices)).alias("slice")
    rows = keyed.select(slice_, "user_id", time_col, "ts_us", "side", "event_id", payload.alias("payload"))
    matched = rows.groupBy("slice").applyInPandasWithState(
        JourneyMatcher(mode, tolerance_us), _MATCHED, "rows binary", "append", GroupStateTimeout.EventTimeTimeout)
    parsed = matched.withColumns({c: F.from_json(c, _PAYLOAD_SCHEMA) for c in ("bought", "cart", "viewed")})
    of = {**dict.fromkeys(_PAYLOAD, "bought"), **dict.fromkeys(CART_COLS, "cart"), **dict.fromkeys(VIEW_COLS, "viewed")}
    out = parsed.select(*[F.col(of[c])[str(_PAYLOAD.index(c))].alias(c) if c in of else F.col(c) for c in _OUTPUT_COLS])
    attached = {*VIEW_COLS, *CART_COLS}
    alone = tagged.where(~able & (F.col("side") == PURCHASE)).select(
        *[(F.lit(None) if f.name in attached else F.col(f.name)).cast(f.dataType).alias(f.name) for f in out.schema.fields])
    return out.union(alone)


def journey_output(rows: DataFrame) -> DataFrame:
    """Processor rows -> journey table columns (``timestamp`` as UTC ``timestamp_ntz``)."""
    return rows.where(F.col("user_id") != FLUSH_USER).select(
        *[(micros_to_ntz(F.col("ts_us")).alias("timestamp") if c == "ts_us" else F.col(c)) for c in _OUTPUT_COLS])
