"""MERGE (upsert) as a DataFrame composition.

``merge(target, source, ...)`` returns the table's next contents; nothing is
written here (``tidemark.table`` writes it). The plan is a left join of the
target to the source on the merge predicate, a union with the source rows that
match nothing (where a clause takes those), one CASE column that names the
clause each row takes, and one projection per target column. A small source can
be broadcast into the left join, so that the target is not shuffled, and AQE can
split a skewed key; neither holds for a full outer join.

Clause semantics (as in Delta Lake MERGE):

* ``when_matched_*`` apply to target rows that satisfy the predicate with a
  source row, ``when_not_matched_insert*`` to source rows that match nothing,
  ``when_not_matched_by_source_*`` to target rows that match nothing.
* Within each of those three groups the clauses are tried in order; the first
  whose own condition holds wins. A matched or by-source row that no clause
  takes is copied unchanged; a source-only row that no clause takes is dropped.
* ``update_all`` / ``insert_all`` take every target column from the source
  column of the same name; a target column the source lacks keeps its value
  on update and is NULL on insert. Extra source columns are ignored.
* NULL keys never match.

Scale notes:

* Rows with a NULL in any equi-key column can never match. A salt column joins
  the shuffle keys: 0 for keyed rows, a row hash for NULL-key rows, so those
  spread over all reducers instead of hashing to the one partition of NULL.
* ``on_duplicate="latest"`` keeps one source row per key with a ``max_by``
  aggregate, which is combined map-side, so a hot key costs one small partial
  row per task instead of one giant group.
* Source rows that match nothing are found against the distinct source keys that
  the target has, so the target's own rows take part in no second join.
* An insert-only merge is that anti join alone; the table layer appends it
  without rewriting or reading the rest.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import DataWriterError

# The merge method names, in the order the options builder emits them.
MERGE_METHODS = (
    "when_matched_delete",
    "when_matched_update",
    "when_matched_update_all",
    "when_not_matched_by_source_delete",
    "when_not_matched_by_source_update",
    "when_not_matched_insert",
    "when_not_matched_insert_all",
)

_MATCHED = {"when_matched_delete", "when_matched_update", "when_matched_update_all"}
_NOT_MATCHED = {"when_not_matched_insert", "when_not_matched_insert_all"}
_BY_SOURCE = {"when_not_matched_by_source_delete", "when_not_matched_by_source_update"}
_DELETES = {"when_matched_delete", "when_not_matched_by_source_delete"}
_UPDATES = {"when_matched_update", "when_matched_update_all", "when_not_matched_by_source_update"}
_INSERTS = _NOT_MATCHED
_NEEDS_MAP = {"when_matched_update", "when_not_matched_by_source_update", "when_not_matched_insert"}

# Action codes for rows no clause takes.
COPY = -1
SKIP = -2

_T_FLAG = "__tm_t"
_S_FLAG = "__tm_s"
ACTION = "__tm_action"
MATCHED_TWICE = ("a target row matched more than one source row; deduplicate the source "
                 "(on_duplicate='latest') or allow it (on_duplicate='expand')")


@dataclass(frozen=True)
class Clause:
    method: str
    predicate: str | None = None
    updates: dict[str, str] | None = None

    def __post_init__(self):
        if self.method not in MERGE_METHODS:
            raise DataWriterError(
                f"invalid merge method: {self.method}; valid methods are: {', '.join(MERGE_METHODS)}")
        if self.method in _NEEDS_MAP and not self.updates:
            raise DataWriterError(f"{self.method} needs a column -> expression map")


def merge_options(
    when_matched_delete: bool = False,
    when_matched_update: bool = False,
    when_matched_update_params: dict | None = None,
    when_matched_update_all: bool = False,
    when_not_matched_by_source_delete: bool = False,
    when_not_matched_by_source_update: bool = False,
    when_not_matched_by_source_update_params: dict | None = None,
    when_not_matched_insert: bool = False,
    when_not_matched_insert_params: dict | None = None,
    when_not_matched_insert_all: bool = False,
) -> dict[str, dict]:
    """Flags and column maps to ``{method: arguments}``, tried in the order of ``MERGE_METHODS``.

    ``Clause`` validates: a method that needs a column map raises without one.
    """
    given = {
        "when_matched_delete": (when_matched_delete, None),
        "when_matched_update": (when_matched_update, when_matched_update_params),
        "when_matched_update_all": (when_matched_update_all, None),
        "when_not_matched_by_source_delete": (when_not_matched_by_source_delete, None),
        "when_not_matched_by_source_update": (when_not_matched_by_source_update, when_not_matched_by_source_update_params),
        "when_not_matched_insert": (when_not_matched_insert, when_not_matched_insert_params),
        "when_not_matched_insert_all": (when_not_matched_insert_all, None),
    }
    wanted = [Clause(method, updates=given[method][1]) for method in MERGE_METHODS if given[method][0]]
    return {c.method: {"updates": c.updates} if c.updates else {"predicate": None} for c in wanted}


def clauses_from_options(options: dict[str, dict] | list[Clause]) -> list[Clause]:
    """An options dict (in its own order) or a clause list, validated."""
    if isinstance(options, list):
        return list(options)
    bad = [k for k in options if k not in MERGE_METHODS]
    if bad:
        raise DataWriterError(
            f"invalid merge method: {', '.join(bad)}; valid methods are: {', '.join(MERGE_METHODS)}")
    return [Clause(k, (v or {}).get("predicate"), (v or {}).get("updates")) for k, v in options.items()]


_CONJ = re.compile(r"^\s*(\w+)\.`?(\w+)`?\s*=\s*(\w+)\.`?(\w+)`?\s*$")
#: A predicate with any of these is not read for keys: a conjunct may stand inside something else.
_COMPOUND = re.compile(r"[()'\"]|\b(or|not|case|between)\b", re.IGNORECASE)


def equi_keys(predicate: str, source_alias: str, target_alias: str) -> tuple[list[tuple[str, str]], bool]:
    """``(target_col, source_col)`` pairs of the predicate's top-level ``a.x = b.y``
    conjuncts, and whether those pairs are the whole predicate.

    Only a plain chain of conjuncts is read; a predicate with parentheses, NOT,
    OR, CASE, BETWEEN or text yields no pairs. Give ``on`` for those.
    """
    if _COMPOUND.search(predicate):
        return [], False
    pairs, whole = [], True
    for conj in re.split(r"\s+and\s+", predicate, flags=re.IGNORECASE):
        m = _CONJ.match(conj)
        if not m:
            whole = False
            continue
        a1, c1, a2, c2 = m.groups()
        if a1 == target_alias and a2 == source_alias:
            pairs.append((c1, c2))
        elif a1 == source_alias and a2 == target_alias:
            pairs.append((c2, c1))
        else:
            whole = False
    return pairs, whole


def merge_keys(predicate: str | None, on: list[str] | None, source_alias: str,
               target_alias: str) -> tuple[list[tuple[str, str]], bool, str]:
    """Key pairs, whether they are all of the condition, and the condition as SQL."""
    if predicate is None and not on:
        raise DataWriterError("give a merge predicate or key columns")
    same = [f"{source_alias}.`{k}` = {target_alias}.`{k}`" for k in on or []]
    if predicate is None:
        return [(k, k) for k in on], True, " AND ".join(same)
    keys, whole = equi_keys(predicate, source_alias, target_alias)
    if not on:
        return keys, whole, predicate
    more = [pair for pair in keys if pair not in {(k, k) for k in on}]
    return [(k, k) for k in on] + more, whole, " AND ".join([*same, f"({predicate})"])


@dataclass
class MergePlan:
    """The joined, action-tagged rows and the projection to the new table."""
    tagged: DataFrame
    target_columns: list[str]
    output: DataFrame
    clauses: list[Clause]
    source: DataFrame
    keys: list[tuple[str, str]] = field(default_factory=list)
    keep: Column | None = None
    outputs: list[Column] = field(default_factory=list)
    only_inserts: bool = False
    only_new: DataFrame | None = None

    def rows(self) -> DataFrame:
        """The new table's rows with the code of the clause that made each (``ACTION``)."""
        return self.tagged.where(self.keep).select(*self.outputs, ACTION)

    def inserted_rows(self) -> DataFrame:
        """Only the rows an insert clause makes, with its code (append path: the target is not read for copies)."""
        return self.only_new.where(F.col(ACTION).isin(_codes(self.clauses, _INSERTS))).select(*self.outputs, ACTION)

    def metrics(self) -> DataFrame:
        """One row of merge statistics, computed in one pass over ``tagged``.

        Columns: num_source_rows, num_target_rows_inserted, _updated, _deleted,
        _copied, num_output_rows.
        """
        return metrics_frame(self.tagged, self.clauses, self.source)


def _codes(clauses: list[Clause], kinds: set[str]) -> list[int]:
    return [i for i, c in enumerate(clauses) if c.method in kinds]


def metric_columns(clauses: list[Clause]) -> list[Column]:
    """Aggregates over ``tagged`` (the action column) for the merge statistics."""
    a = F.col(ACTION)

    def count_in(codes):
        return F.count(F.when(a.isin(codes), 1)).cast("bigint") if codes else F.lit(0).cast("bigint")

    ins = count_in(_codes(clauses, _INSERTS))
    upd = count_in(_codes(clauses, _UPDATES))
    dele = count_in(_codes(clauses, _DELETES))
    cop = F.count(F.when(a == COPY, 1)).cast("bigint")
    return [ins.alias("num_target_rows_inserted"), upd.alias("num_target_rows_updated"),
            dele.alias("num_target_rows_deleted"), cop.alias("num_target_rows_copied")]


def metrics_frame(tagged: DataFrame, clauses: list[Clause], source: DataFrame) -> DataFrame:
    m = tagged.agg(*metric_columns(clauses))
    n_src = source.agg(F.count(F.lit(1)).cast("bigint").alias("num_source_rows"))
    return n_src.crossJoin(m).select(
        "num_source_rows", "num_target_rows_inserted", "num_target_rows_updated",
        "num_target_rows_deleted", "num_target_rows_copied",
        (F.col("num_target_rows_inserted") + F.col("num_target_rows_updated")
         + F.col("num_target_rows_copied")).alias("num_output_rows"))


def _any_null(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


_SALT = "__tm_salt"
SALT_BUCKETS = 4096


def _salt(alias: str, key_cols: list[str], all_cols: list[str]) -> Column:
    """0 for rows with a full key; 1..SALT_BUCKETS (a row hash) when a key is NULL."""
    key_null = _any_null([F.col(f"{alias}.`{k}`") for k in key_cols])
    spread = F.pmod(F.xxhash64(*[F.col(f"{alias}.`{c}`") for c in all_cols]), F.lit(SALT_BUCKETS)) + 1
    return F.when(key_null, spread).otherwise(F.lit(0)).cast("int")


def dedupe_latest(source: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One source row per non-NULL key: the one with the greatest ``order_by``.

    Rows with a NULL key are all kept (they never match anyway): each gets its
    own group through a row id that is NULL for keyed rows. The aggregate is
    ``max_by(struct(row), struct(order))``, combined map-side, so a hot key is
    one partial row per task. Ties on the order columns are broken by the whole
    row, so the pick is deterministic. One scan of the source.
    """
    cols = source.columns
    order = order_by or []
    key_null = _any_null([F.col(k) for k in keys])
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    ordering = F.struct(*[F.col(f"`{c}`") for c in order], row)
    solo = F.when(key_null, F.monotonically_increasing_id())
    picked = source.groupBy(*keys, solo.alias("__tm_solo")).agg(F.max_by(row, ordering).alias("__r"))
    return picked.select(*[F.col(f"__r.`{c}`").alias(c) for c in cols])


def source_duplicate_keys(source: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """Non-NULL source keys that occur more than once (a map-side-combined count)."""
    skeys = [s for _, s in keys]
    return (source.where(~_any_null([F.col(s) for s in skeys]))
            .groupBy(*skeys).count().where(F.col("count") > 1).drop("count"))


def duplicate_matches(target: DataFrame, source: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """Target keys that more than one source row matches (keys only): the
    source's repeated keys semi-joined to the target."""
    dups = source_duplicate_keys(source, keys)
    cond = reduce(lambda a, b: a & b, [F.col(f"__d.{s}") == F.col(f"__t.{t}") for t, s in keys])
    return dups.alias("__d").join(target.alias("__t"), cond, "left_semi")


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's estimate of ``df`` is within the session's broadcast threshold."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= conf.autoBroadcastJoinThreshold()


def merge_plan(
    target: DataFrame,
    source: DataFrame,
    clauses: dict[str, dict] | list[Clause],
    predicate: str | None = None,
    on: list[str] | None = None,
    source_alias: str = "source",
    target_alias: str = "target",
    on_duplicate: str = "error",
    latest_by: list[str] | None = None,
    check_source: DataFrame | None = None,
    source_has_duplicate_keys: bool | None = None,
    allow_nested_loop: bool = False,
) -> MergePlan:
    """Plan a merge; see the module docstring for the semantics.

    ``predicate`` is a SQL boolean over ``<source_alias>.col`` and
    ``<target_alias>.col``; ``on`` names columns that must be equal on
    both sides; with both, both must hold. Without an equality to join on, every
    target row would be held against every source row: that is refused unless
    ``allow_nested_loop``. ``on_duplicate``: ``"error"`` (a target row matched by several
    source rows fails the merge, as in Delta), ``"latest"`` (keep the source
    row with the greatest ``latest_by`` per key first) or ``"expand"`` (every
    matching pair is a row, as a plain join gives). ``check_source``: the same
    rows as ``source`` for the duplicate check, when ``source`` carries an
    observation that must only be fulfilled by the write.
    ``source_has_duplicate_keys``: known from a profile of the source (False
    skips the duplicate check); when None the source keys are counted first
    and the target is consulted only if some key repeats.
    """
    clauses = clauses_from_options(clauses)
    if not clauses:
        raise DataWriterError("a merge needs at least one clause")
    keys, whole, predicate = merge_keys(predicate, on, source_alias, target_alias)
    if not keys and not allow_nested_loop:
        raise DataWriterError("the merge predicate has no plain `source.col = target.col` conjunct to join on; "
                              "give key columns with on=, or allow_nested_loop=True for a small source")
    if on_duplicate not in ("error", "latest", "expand"):
        raise DataWriterError(f"on_duplicate must be error, latest or expand, not {on_duplicate!r}")

    check_source = source if check_source is None else check_source
    if on_duplicate == "latest":
        if not keys:
            raise DataWriterError("on_duplicate='latest' needs equality conjuncts in the predicate")
        source = dedupe_latest(source, [s for _, s in keys], latest_by)

    tcols, scols = target.columns, source.columns
    T, S = target_alias, source_alias

    def wrap(df: DataFrame, alias: str, flag: str) -> DataFrame:
        return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(alias), F.lit(True).alias(flag))

    t_w = wrap(target, T, _T_FLAG)
    s_w = wrap(source, S, _S_FLAG)
    t_struct_type = t_w.schema[T].dataType
    s_struct_type = s_w.schema[S].dataType
    cond = F.expr(predicate)

    has_matched = any(c.method in _MATCHED for c in clauses)
    has_inserts = any(c.method in _NOT_MATCHED for c in clauses)
    only_inserts = all(c.method in _NOT_MATCHED for c in clauses)

    if keys:
        # NULL-key rows never match; a salt in the join keys spreads them over
        # the reducers instead of hashing them all to the partition of NULL.
        t_w = t_w.withColumn(_SALT, _salt(T, [t for t, _ in keys], tcols))
        s_w = s_w.withColumn(_SALT, _salt(S, [s for _, s in keys], scols))
        cond = cond & (t_w[_SALT] == s_w[_SALT])
    def unmatched_source() -> DataFrame:
        """Source rows that match no target row."""
        if keys and whole:
            # Keys of the source that the target has: few, however large the target is.
            skeys = reduce(lambda x, y: x & y, [F.col(f"__t.`{t}`") == F.col(f"__s.`{k}`") for t, k in keys])
            found = target.select(*{t for t, _ in keys}).alias("__t").join(source.select(*{k for _, k in keys}).alias("__s"), skeys, "left_semi").distinct().alias("__f")
            none = reduce(lambda x, y: x & y, [F.col(f"__f.`{t}`") == F.col(f"{S}.`{k}`") for t, k in keys])
            if _SALT in s_w.columns:
                found = found.select("*", F.lit(0).alias("__f_salt"))
                none = none & (F.col("__f_salt") == F.col(_SALT))
            return s_w.join(found, none, "left_anti")
        return s_w.join(t_w, cond, "left_anti")

    inserts = None
    # A source too large to broadcast meets the target in one full join; a small
    # one leaves the target where it is, whose keys are then read once more.
    once = has_inserts and not only_inserts and bool(keys) and whole and not fits_broadcast(source)
    if has_inserts and not once:
        inserts = unmatched_source().select(F.lit(None).cast(t_struct_type).alias(T), F.col(S),
                                            F.lit(None).cast("boolean").alias(_T_FLAG), F.col(_S_FLAG))
    if only_inserts:
        # No target row changes: they are copied as they are.
        joined = t_w.select(F.col(T), F.lit(None).cast(s_struct_type).alias(S), F.col(_T_FLAG),
                            F.lit(None).cast("boolean").alias(_S_FLAG))
    else:
        joined = t_w.join(s_w, cond, "full_outer" if once else "left").select(T, S, _T_FLAG, _S_FLAG)
    if inserts is not None:
        joined = joined.unionByName(inserts)

    if on_duplicate == "error" and has_matched:
        if keys and whole:
            if source_has_duplicate_keys is None:
                source_has_duplicate_keys = bool(source_duplicate_keys(check_source, keys).limit(1).count())
            dup = (duplicate_matches(target, check_source, keys).limit(1).count()
                   if source_has_duplicate_keys else 0)
        else:
            rid = "__tm_rid"
            t_id = target.withColumn(rid, F.monotonically_increasing_id())
            probe = wrap(t_id, T, _T_FLAG).join(wrap(check_source, S, _S_FLAG), F.expr(predicate), "inner")
            dup = probe.groupBy(F.col(f"{T}.{rid}")).count().where(F.col("count") > 1).limit(1).count()
        if dup:
            raise DataWriterError(MATCHED_TWICE)

    matched = F.col(_T_FLAG).isNotNull() & F.col(_S_FLAG).isNotNull()
    not_matched = F.col(_T_FLAG).isNull()
    by_source = F.col(_S_FLAG).isNull()

    action = None
    for group, cond_group, default in ((_MATCHED, matched, COPY), (_NOT_MATCHED, not_matched, SKIP),
                                       (_BY_SOURCE, by_source, COPY)):
        for i, c in enumerate(clauses):
            if c.method not in group:
                continue
            test = cond_group if c.predicate is None else (cond_group & F.coalesce(F.expr(c.predicate), F.lit(False)))
            action = F.when(test, F.lit(i)) if action is None else action.when(test, F.lit(i))
        action = (F.when(cond_group, F.lit(default)) if action is None
                  else action.when(cond_group, F.lit(default)))
    tagged = joined.withColumn(ACTION, action)
    only_new = None if inserts is None else inserts.withColumn(ACTION, action)

    scols_set = set(scols)
    ttypes = {f.name: f.dataType for f in target.schema.fields}
    outputs = []
    for col in tcols:
        tval = F.col(f"{T}.`{col}`")
        expr = None
        for i, c in enumerate(clauses):
            if c.method in _DELETES:
                continue
            updates = {k.strip("`"): v for k, v in (c.updates or {}).items()}
            if c.method == "when_matched_update_all":
                val = F.col(f"{S}.`{col}`") if col in scols_set else tval
            elif c.method == "when_not_matched_insert_all":
                val = F.col(f"{S}.`{col}`") if col in scols_set else F.lit(None)
            elif c.method == "when_not_matched_insert":
                val = F.expr(updates[col]) if col in updates else F.lit(None)
            else:  # matched update / by-source update
                val = F.expr(updates[col]) if col in updates else tval
            val = val.cast(ttypes[col])
            expr = F.when(F.col(ACTION) == i, val) if expr is None else expr.when(F.col(ACTION) == i, val)
        outputs.append((tval if expr is None else expr.otherwise(tval)).alias(col))

    keep = ~F.col(ACTION).isin(_codes(clauses, _DELETES) + [SKIP])
    output = tagged.where(keep).select(*outputs)
    return MergePlan(tagged, tcols, output, clauses, source, keys, keep, outputs, only_inserts, only_new)


def merge(target: DataFrame, source: DataFrame, clauses, **kwargs) -> DataFrame:
    """The table's next contents after merging ``source`` into ``target``."""
    return merge_plan(target, source, clauses, **kwargs).output
