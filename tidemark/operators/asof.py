"""As-of join: for each left row, the latest right row with the same key and a
time at or before the left row's time.

Semantics (``how="left"``, ``merge="keep-left"``):

* every left row is emitted once; unmatched rows carry NULL right columns;
* a right row at exactly the left time matches (inclusive); among right rows at
  the same time the greatest ``tiebreak`` wins;
* ``tolerance``: a match older than ``left time - tolerance`` is dropped (the
  latest candidate is the only one that can qualify, so this is exact);
* NULL keys and NULL times never match;
* on a column name both sides share, the left value wins even when it is NULL;
  the output columns are the right's columns in the right's order followed by
  the left-only columns.

Plan, and why it survives skew: rows of both sides are tagged and unioned, then
split by ``(key, time bucket)``; a running ``last(right, ignorenulls)`` window
inside each group finds matches within the bucket. For left rows whose bucket
holds no earlier right row, the answer is the last right row of an earlier
bucket: a ``max_by`` aggregate (map-side combined) gives one summary row per
(key, bucket), a window over those small summaries carries the last one
forward, and a join on (key, bucket) attaches it. One hot key is therefore
spread over as many tasks as it has buckets, and the only per-key work is on
one summary row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TS = "__ao_ts"
_SIDE = "__ao_side"   # 0 = right, 1 = left: rights sort first at equal time
_TB = "__ao_tb"
_L = "__ao_l"
_R = "__ao_r"
_BUCKET = "__ao_bucket"
_SALT = "__ao_salt"
_KEY = "__ao_key"
_SALT_BUCKETS = 4096


def _keys(by: str | list[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str | list[str],
    on: str = "timestamp",
    right_on: str | None = None,
    tolerance: str | None = None,
    tiebreak: str | None = None,
    bucket: str = "hour",
) -> DataFrame:
    """Left as-of join with keep-left merge; see the module docstring.

    ``on``/``right_on``: time columns; ``tolerance``: an interval string such
    as ``"7 DAYS"``; ``bucket``: a ``date_trunc`` unit that bounds the rows one
    task sees for one key (``"minute"`` ... ``"month"``).
    """
    keys = _keys(by)
    right_on = right_on or on
    lcols, rcols = left.columns, right.columns
    r_only = [c for c in rcols if c not in set(lcols)]
    tb = F.col(f"`{tiebreak}`") if tiebreak else F.lit(None).cast("string")

    r_payload = F.struct(*[F.col(f"`{c}`") for c in r_only],
                         F.col(f"`{right_on}`").alias(_TS), tb.alias(_TB))
    r_type = right.select(r_payload.alias(_R)).schema[_R].dataType
    l_type = left.select(F.struct(*[F.col(f"`{c}`") for c in lcols]).alias(_L)).schema[_L].dataType

    key_null_l = F.lit(False)
    for k in keys:
        key_null_l = key_null_l | F.col(f"`{k}`").isNull()
    key_null_l = key_null_l | F.col(f"`{on}`").isNull()
    key_ok_r = F.col(f"`{right_on}`").isNotNull()
    for k in keys:
        key_ok_r = key_ok_r & F.col(f"`{k}`").isNotNull()

    lrows = left.select(
        *[F.col(f"`{k}`").alias(f"__ao_k{i}") for i, k in enumerate(keys)],
        F.col(f"`{on}`").alias(_TS), F.lit(1).alias(_SIDE), F.lit(None).cast(r_type.fields[-1].dataType).alias(_TB),
        F.struct(*[F.col(f"`{c}`") for c in lcols]).alias(_L), F.lit(None).cast(r_type).alias(_R),
        # Left rows with a NULL key or time can never match: a row hash as their
        # bucket spreads them over the tasks instead of one group.
        F.when(key_null_l, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in lcols]), F.lit(_SALT_BUCKETS)) + 1)
        .alias(_SALT))
    rrows = right.where(key_ok_r).select(
        *[F.col(f"`{k}`").alias(f"__ao_k{i}") for i, k in enumerate(keys)],
        F.col(f"`{right_on}`").alias(_TS), F.lit(0).alias(_SIDE), tb.alias(_TB),
        F.lit(None).cast(l_type).alias(_L), r_payload.alias(_R), F.lit(None).cast("bigint").alias(_SALT))
    kcols = [f"__ao_k{i}" for i in range(len(keys))]
    u = lrows.unionByName(rrows).withColumn(
        _BUCKET, F.when(F.col(_SALT).isNull(), F.date_trunc(bucket, F.col(_TS)))
        .otherwise(F.timestamp_micros(F.col(_SALT)))).drop(_SALT)

    # 1. Matches inside the (key, bucket) group. The final join is on the same
    # (key, bucket), so this partitioning serves it too.
    w_in = (Window.partitionBy(*kcols, _BUCKET).orderBy(_TS, _SIDE, _TB)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = u.withColumn("__ao_in", F.last(_R, ignorenulls=True).over(w_in)).where(F.col(_SIDE) == 1)

    # 2. Last right row of each earlier bucket, carried forward over summaries.
    is_right = F.col(_SIDE) == 0
    keyed = F.lit(True)
    for k in kcols:
        keyed = keyed & F.col(k).isNotNull()
    summary = (u.where(keyed)
               .groupBy(*kcols, _BUCKET)
               .agg(F.max_by(F.when(is_right, F.col(_R)), F.when(is_right, F.struct(_TS, _TB))).alias("__ao_last")))
    w_prev = (Window.partitionBy(*kcols).orderBy(_BUCKET)
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = summary.select(*kcols, _BUCKET, F.last("__ao_last", ignorenulls=True).over(w_prev).alias("__ao_prev"))

    joined = within.join(carried, on=[*kcols, _BUCKET], how="left")
    match = F.when(F.col(f"{_L}.`{on}`").isNotNull(), F.coalesce(F.col("__ao_in"), F.col("__ao_prev")))
    if tolerance:
        ok = F.col(f"{_L}.`{on}`") - F.expr(f"INTERVAL {tolerance}") <= match[_TS]
        match = F.when(ok, match)
    m = joined.select(F.col(_L), match.alias("__ao_m"))

    out: list[Column] = []
    lset = set(lcols)
    for c in rcols:
        out.append((F.col(f"{_L}.`{c}`") if c in lset else F.col(f"__ao_m.`{c}`")).alias(c))
    out += [F.col(f"{_L}.`{c}`").alias(c) for c in lcols if c not in set(rcols)]
    return m.select(*out)


def customer_journey(views: DataFrame, carts: DataFrame, purchases: DataFrame,
                     by: str = "user_id", on: str = "timestamp", tolerance: str | None = None,
                     tiebreak: str | None = "event_id", bucket: str = "hour") -> DataFrame:
    """purchase as-of (cart as-of view): one row per purchase.

    The view attached is the latest one before the *cart*, not the purchase;
    names the three share (event_id, user_id, timestamp, price) keep the
    purchase's values. Rules of matching are those of ``asof_join``.

    All three kinds go through one exchange by (key, bucket) and one sort: a
    first running ``last`` gives every cart its view, a second one, over the same
    order, gives every purchase its cart with that view. Both the purchases and
    the summary that carries views and carts on to later buckets are read from
    this one exchange, so each input is scanned once. The keys are one struct,
    which is never NULL: a join on it puts no filter of its own into one branch.
    """
    keys = _keys(by)
    own = set(purchases.columns)
    cart_cols = [c for c in carts.columns if c not in own]
    view_cols = [c for c in views.columns if c not in own and c not in set(carts.columns)]
    view, cart, buy = "__ao_view", "__ao_cart", "__ao_buy"

    def payload(df: DataFrame, cols: list[str]) -> Column:
        return F.struct(*[F.col(f"`{c}`") for c in cols], F.col(f"`{on}`").alias(_TS))

    packed = {view: (views, payload(views, view_cols)), cart: (carts, payload(carts, cart_cols)),
              buy: (purchases, F.struct(*[F.col(f"`{c}`") for c in purchases.columns]))}
    types = {name: df.select(value.alias(name)).schema[name].dataType for name, (df, value) in packed.items()}

    def rows(name: str, side: int) -> DataFrame:
        df, value = packed[name]
        able = F.col(f"`{on}`").isNotNull()
        for k in keys:
            able = able & F.col(f"`{k}`").isNotNull()
        # Purchases that can never match are spread by a row hash; others of the kind are left out.
        spread = F.timestamp_micros(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(_SALT_BUCKETS)) + 1)
        tb = F.col(f"`{tiebreak}`") if tiebreak else F.lit(None).cast("string")
        return (df if side == 2 else df.where(able)).select(
            F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]).alias(_KEY), F.col(f"`{on}`").alias(_TS), F.lit(side).alias(_SIDE), tb.alias(_TB),
            F.when(able, F.date_trunc(bucket, F.col(f"`{on}`"))).otherwise(spread).alias(_BUCKET),
            *[(value if n == name else F.lit(None).cast(types[n])).alias(n) for n in (view, cart, buy)])

    every = rows(view, 0).unionByName(rows(cart, 1)).unionByName(rows(buy, 2))
    so_far = (Window.partitionBy(_KEY, _BUCKET).orderBy(_TS, _SIDE, _TB)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = every.withColumn("__ao_v", F.last(view, ignorenulls=True).over(so_far))
    seen = seen.withColumn("__ao_c", F.when(F.col(_SIDE) == 1, F.struct(F.col(cart).alias("c"), F.col("__ao_v").alias("v"))))
    within = seen.withColumn("__ao_in", F.last("__ao_c", ignorenulls=True).over(so_far)).where(F.col(_SIDE) == 2)

    def latest(value: str, side: int) -> Column:
        return F.max_by(F.when(F.col(_SIDE) == side, F.col(value)), F.when(F.col(_SIDE) == side, F.struct(_TS, _TB)))

    # The count leaves both branches with the same columns, so that they share the exchange.
    summary = seen.groupBy(_KEY, _BUCKET).agg(latest(view, 0).alias("v"), latest("__ao_c", 1).alias("c"), F.count(buy).alias("n"))
    before = Window.partitionBy(_KEY).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.withColumn("__ao_pv", F.last("v", ignorenulls=True).over(before))
    carried = carried.withColumn("c", F.when(F.col("c").isNotNull(), F.struct(F.col("c.c"), F.coalesce(F.col("c.v"), F.col("__ao_pv")).alias("v"))))
    carried = carried.withColumn("__ao_pc", F.last("c", ignorenulls=True).over(before)).where("n > 0").select(_KEY, _BUCKET, "__ao_pv", "__ao_pc")

    here = F.when(F.col("__ao_in").isNotNull(), F.struct(F.col("__ao_in.c"), F.coalesce(F.col("__ao_in.v"), F.col("__ao_pv")).alias("v")))
    able = F.col(f"{buy}.`{on}`").isNotNull()
    for k in keys:
        able = able & F.col(f"{buy}.`{k}`").isNotNull()
    match = F.when(able, F.coalesce(here, F.col("__ao_pc")))
    if tolerance:
        match = F.when(F.col(f"{buy}.`{on}`") - F.expr(f"INTERVAL {tolerance}") <= match["c"][_TS], match)
    found = within.join(carried, on=[_KEY, _BUCKET], how="left").select(buy, match.alias("m"))
    seen_view = F.col("m.v")
    if tolerance:
        seen_view = F.when(F.col(f"m.c.{_TS}") - F.expr(f"INTERVAL {tolerance}") <= F.col(f"m.v.{_TS}"), seen_view)
    found = found.select(buy, F.col("m.c").alias(cart), seen_view.alias(view))

    names = views.columns + [c for c in carts.columns if c not in set(views.columns)]
    names += [c for c in purchases.columns if c not in set(names)]
    return found.select(*[F.col(f"{buy if c in own else cart if c in set(cart_cols) else view}.`{c}`").alias(c) for c in names])
