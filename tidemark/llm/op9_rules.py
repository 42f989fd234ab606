"""Quality rules as robust multivariate outliers, with DataFrame functions only.

Each text gives five counts by array functions on its own row; no text is
shuffled. Their transformed values are judged per language and source by the
minimum covariance determinant, which stands as long as over half of a group's
rows are good. From two starts (medians, and middles of the shortest halves),
concentration steps each keep the ``COVERAGE`` share of rows that lies closest
and take mean and covariance of those, until no determinant falls any more; the
start with the smaller one counts. Then the rows within a chi-square quantile of
that estimate give the mean and covariance by which rows are judged. A step is
two small aggregations (a quantile sketch, then moments), combined before the
shuffle, so a source with most rows is no larger a task than others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.store import stored, tables

#: Share of rows that a step keeps, and steps at most; they end when determinants have settled.
COVERAGE, STEPS = 0.5, 30
#: Logarithm by which a determinant's root has to fall to count as falling.
SETTLED = 1e-9
#: Groups of fewer rows are judged by the estimate over their language, languages of fewer by that over all rows.
LEAST_ROWS = 100
#: Squared distance by the reweighted estimate beyond which a row goes.
CUT = 60.0
#: Least spread of each transformed statistic: what counts as no difference.
FLOORS = {"x_words": 0.15, "x_length": 0.05, "x_symbols": 0.02, "x_lines": 0.08, "x_repeats": 0.1}
X = list(FLOORS)
#: Median of chi-square with five degrees of freedom.
CHI_MEDIAN = 4.351
#: Its 0.975 quantile: rows within it are averaged in the reweighting step.
CHI_NEAR = 12.833
#: Squared distances by the closer half's covariance are too large by this: 0.5 / P(chi-square with seven degrees <= CHI_MEDIAN).
CONSISTENCY = 1.918
#: Quantiles of the starts: every fortieth; ``HALF`` of these steps hold half of the rows.
MARKS, HALF = [k / 40 for k in range(41)], 20

_SPACES = " \t\n\x0b\x0c\r"


def with_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    bare = F.translate(text, _SPACES, "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, _SPACES, "") != "")
    df = docs.withColumn("_words", F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")).withColumn("_lines", lines)
    df = df.withColumn("n_words", F.size("_words").cast("long")).withColumn("word_chars", F.length(bare).cast("long"))
    df = df.withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"))
    df = df.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    # Windows by hash and place: equal ones lie next to each other when sorted.
    windows = "transform(sequence(0, size(_words) - 3), i -> struct(xxhash64(_words[i], _words[i + 1], _words[i + 2]) AS h, i AS i))"
    df = df.withColumn("_windows", F.expr(f"CASE WHEN size(_words) >= 3 THEN sort_array({windows}) END"))
    again = ("transform(filter(_windows, (x, j) -> (j > 0 AND _windows[greatest(j - 1, 0)].h = x.h) "
             "OR (j < size(_windows) - 1 AND _windows[least(j + 1, size(_windows) - 1)].h = x.h)), x -> x.i)")
    df = df.withColumn("_again", F.expr(f"sort_array({again})"))
    # A repeated window at each place covers three words, or as many as lie before the next one.
    cover = "aggregate(transform(_again, (x, j) -> CASE WHEN j = size(_again) - 1 THEN 3 ELSE least(3, _again[least(j + 1, size(_again) - 1)] - x) END), 0L, (a, x) -> a + x)"
    df = df.withColumn("n_repeat_words", F.coalesce(F.expr(cover), F.lit(0).cast("long")))
    return df.drop("_words", "_lines", "_windows", "_again")


def with_vector(df: DataFrame) -> DataFrame:
    """The transformed statistics: logarithms of size and word length, roots of shares."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return (df.withColumn("x_words", F.log1p("n_words")).withColumn("x_length", F.log1p(F.col("word_chars") / n))
            .withColumn("x_symbols", F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))))
            .withColumn("x_lines", F.sqrt(F.col("n_dup_lines") / n)).withColumn("x_repeats", F.sqrt(F.col("n_repeat_words") / n)))


def _lower_triangle() -> dict[str, Column]:
    """Cholesky factor of the covariance columns ``c_i_j``, column by column."""
    out: dict[str, Column] = {}
    for j in range(len(X)):
        for i in range(j, len(X)):
            rest = F.col(f"c_{i}_{j}")
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            out[f"l_{i}_{j}"] = F.sqrt(F.greatest(rest, F.lit(FLOORS[X[i]] ** 2 / 4))) if i == j else rest / F.col(f"l_{j}_{j}")
    return out


def _moments(near: DataFrame) -> DataFrame:
    """Means, the factor of the covariance and the logarithm ``det`` of its determinant's root, per group and start, of the rows that are near."""
    pairs = [(i, j) for i in range(len(X)) for j in range(i + 1)]
    got = near.groupBy("_group", "_start").agg(*[F.avg(x).alias(f"m_{i}") for i, x in enumerate(X)], *[F.covar_pop(X[i], X[j]).alias(f"c_{i}_{j}") for i, j in pairs])
    for i, x in enumerate(X):
        got = got.withColumn(f"c_{i}_{i}", F.col(f"c_{i}_{i}") + FLOORS[x] ** 2)
    for name, value in _lower_triangle().items():
        got = got.withColumn(name, value)
    det = sum((F.log(f"l_{i}_{i}") for i in range(len(X))), F.lit(0.0))
    return got.withColumn("det", det).drop(*[f"c_{i}_{j}" for i, j in pairs])


def _distance(df: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d`` by forward substitution."""
    total = F.lit(0.0)
    for i, x in enumerate(X):
        rest = F.col(x) - F.col(f"m_{i}")
        for k in range(i):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"_z{k}")
        df = df.withColumn(f"_z{i}", rest / F.col(f"l_{i}_{i}"))
        total = total + F.col(f"_z{i}") * F.col(f"_z{i}")
    return df.withColumn("d", total)


def _starts(rows: DataFrame) -> DataFrame:
    """Per group, medians with quartile distances (0), and middles with widths of the shortest halves (1), as means and diagonal factors."""
    marks = rows.groupBy("_group").agg(*[F.percentile_approx(x, MARKS, 2000).alias(f"q_{i}") for i, x in enumerate(X)])
    for i in range(len(X)):
        widths = f"transform(sequence(0, {HALF}), k -> struct(q_{i}[k + {HALF}] - q_{i}[k] AS width, k AS k))"
        marks = marks.withColumn(f"h_{i}", F.array_min(F.expr(widths)))
    out = []
    for start in (0, 1):
        got = marks.withColumn("_start", F.lit(start))
        for i, x in enumerate(X):
            q, half = F.col(f"q_{i}"), F.col(f"h_{i}")
            middle = q[HALF] if start == 0 else (q[half["k"]] + q[half["k"] + HALF]) / 2
            spread = (q[HALF + HALF // 2] - q[HALF // 2] if start == 0 else half["width"]) / 1.349
            got = got.withColumn(f"m_{i}", middle)
            for j in range(i):
                got = got.withColumn(f"l_{i}_{j}", F.lit(0.0))
            got = got.withColumn(f"l_{i}_{i}", F.greatest(spread, F.lit(FLOORS[x])))
        out.append(got.drop(*[f"{c}_{i}" for c in "qh" for i in range(len(X))]))
    return out[0].unionByName(out[1])


def robust_estimates(rows: DataFrame, coverage: float = COVERAGE, steps: int = STEPS) -> DataFrame:
    """Per ``_group``: mean, covariance factor, and ``unit``, the scale of squared distances. ``rows`` has the statistics."""
    key = ["_group", "_start"]
    moving, settled = stored(_starts(rows).withColumn("det", F.lit(float("inf"))), "mcd"), []
    for step in range(steps):
        at = _distance(rows.join(moving, "_group"))
        limit = stored(at.groupBy(*key).agg(F.percentile_approx("d", coverage, 10_000).alias("limit")), "mcd")
        # Starts of a group that has settled are at rest; only the others take another step.
        last = moving.select(*key, F.col("det").alias("last"))
        got = stored(_moments(at.join(limit, key).where("d <= limit")).join(last, key), "mcd")
        falls = F.col("det") < F.col("last") - SETTLED
        moving = got.where(falls).drop("last")
        settled.append(got.where(~falls).drop("last") if step < steps - 1 else got.drop("last"))
        if not moving.limit(1).count():
            break
    every = settled[0]
    for some in settled[1:]:
        every = every.unionByName(some)
    names = [c for c in every.columns if c not in ("_group", "det")]
    best = every.groupBy("_group").agg(F.min(F.struct("det", *names)).alias("_best")).select("_group", *[f"_best.{c}" for c in names])
    estimate = stored(best.drop("_start"), "mcd")
    scale = _distance(rows.join(estimate, "_group")).groupBy("_group").agg((F.percentile_approx("d", 0.5, 10_000) / CHI_MEDIAN).alias("unit"))
    # Spreads below the floors make distances small; those are not blown up.
    return estimate.join(stored(scale.withColumn("unit", F.greatest("unit", F.lit(1.0))), "mcd"), "_group")


def reweighted(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Per ``_group``: mean and covariance factor of the rows that lie within ``CHI_NEAR`` by ``estimates``."""
    near = _distance(rows.join(estimates, "_group")).where(F.col("d") / CONSISTENCY <= CHI_NEAR)
    return stored(_moments(near.withColumn("_start", F.lit(0))).drop("_start", "det"), "mcd")


def with_groups(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (with ``_lang`` and ``_own``) by the ``_group`` that judges each, and by every group whose estimate they are part of."""
    counts = stored(rows.groupBy("_lang", "_own").agg(F.count("*").alias("n")), "groups")
    langs = counts.groupBy("_lang").agg(F.sum("n").alias("n_lang"), F.min("n").alias("least"))
    sizes = counts.join(stored(langs, "groups"), "_lang")
    own, lang, every = F.col("n") >= LEAST_ROWS, F.col("n_lang") >= LEAST_ROWS, F.lit("*")
    small = sizes.where(~lang & ~own).limit(1).count() > 0
    judge_by = F.when(own, F.col("_own")).when(lang, F.col("_lang")).otherwise(every)
    parts = F.array_compact(F.array(F.when(own, F.col("_own")), F.when(lang & (F.col("least") < LEAST_ROWS), F.col("_lang")), every if small else F.lit(None).cast("string")))
    plan = stored(sizes.select("_own", judge_by.alias("_group"), parts.alias("_parts")), "groups")
    return (rows.join(plan.drop("_parts"), "_own"), rows.join(plan.select("_own", F.explode("_parts").alias("_group")), "_own"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cut: float = CUT) -> DataFrame:
    """``id_col``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept``, ``distance``, ``judged``.

    ``base_failed``: under 50 words, or over half of them in repeated windows.
    ``kept``: not failed, and no outlier of its language and source: ``judged``,
    the squared distance by the reweighted estimate, is at most ``cut``.
    ``distance`` is the one by the estimate before that. A null text has no words. Null language or source is a group like others. A group below
    ``LEAST_ROWS`` rows is judged by all rows of its language, and by all rows
    of the table where those are too few as well. One row out for each row in,
    repeated rows and null ids too; an empty table gives an empty result.
    """
    group = F.to_json(F.struct(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{source_col}`").alias("source")))
    lang = F.concat(F.lit("lang "), F.to_json(F.struct(F.col(f"`{lang_col}`").alias("lang"))))
    picked = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), lang.alias("_lang"), group.alias("_own"))
    rows = stored(with_vector(with_counts(picked, "_text")).drop("_text"), "statistics")
    rows, parts = with_groups(rows)
    estimates = robust_estimates(parts)
    raw = _distance(rows.join(estimates, "_group", "left")).withColumn("distance", F.col("d") / F.col("unit")).select(*rows.columns, "distance")
    judged = _distance(raw.join(reweighted(parts, estimates), "_group", "left"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                         (~failed & (F.col("d") <= cut)).alias("kept"), "distance", F.col("d").alias("judged"))


def op9(spark, sf_dir: str) -> DataFrame:
    return judge(tables(spark, sf_dir, "documents")).drop("distance", "judged")


QUERIES = {"op9_quality_rules": op9}
ORACLES = {}
