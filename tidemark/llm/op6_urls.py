"""URL filters: host and path rules, and a ratio of character models for the rest. DataFrame functions only.

URLs that a rule decides are the examples: two variable-order Markov models of
characters, one of allowed and one of blocked URLs, are counted over all of
them. A context that a model has not seen falls back on its shorter one; counts
are smoothed by Witten and Bell's rule at each order. A URL is judged by the
difference of the two log-likelihoods per character, against a threshold that
lies equally many standard deviations from the means of both kinds.

Counts and scores are taken over distinct grams and distinct URLs, so a host or
URL that fills a third of the rows is pre-aggregated before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.store import stored, tables

#: (verdict, host, path). A rule fits its host and all subdomains, if the path starts with the rule's.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Characters of context at most.
ORDER = 4
#: Characters that an unseen one could be, for the model without context.
ALPHABET = 256
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_START = "\x02"


def with_parts(pages: DataFrame, url_col: str) -> DataFrame:
    """``pages`` plus ``host`` and ``path``, both empty without a ``://``, and ``_letters``, what the models read."""
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return (pages.withColumn("host", F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER))
            .withColumn("path", F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))
            .withColumn("_letters", F.translate(F.when(at > 0, rest).otherwise(url), _UPPER, _LOWER)))


def rule_columns(rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, or nulls. Of equally long ones the last counts."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        text, verdict = F.when(fits, F.lit(host + path)).otherwise(text), F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def _grams(urls: DataFrame) -> DataFrame:
    """Each character of each URL with the ``ORDER`` before it; ``urls`` has ``_letters``."""
    padded = urls.withColumn("_c", F.split(F.concat(F.lit(_START * ORDER), "_letters"), "")).where("_letters <> ''")
    gram = ", ".join(f"_c[i + {k}]" for k in range(ORDER + 1))
    return padded.withColumn("gram", F.explode(F.expr(f"transform(sequence(0, length(_letters) - 1), i -> array({gram}))"))).drop("_c")


def gram_scores(grams: DataFrame) -> DataFrame:
    """``gram``, ``score``: the log ratio of its last character's probabilities. ``grams``: gram, a, b (counts by kind)."""
    level = F.explode(F.sequence(F.lit(0), F.lit(ORDER)))
    by_level = grams.withColumn("k", level)
    by_level = by_level.withColumn("context", F.expr(f"array_join(slice(gram, {ORDER + 1} - k, k), '')")).withColumn("c", F.col("gram")[ORDER])
    counts = by_level.groupBy("k", "context", "c").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    totals = counts.groupBy("k", "context").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"), F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("b") > 0).alias("tb"))
    levels = by_level.select("gram", "k", "context", "c").join(counts, ["k", "context", "c"]).join(totals, ["k", "context"])
    rows = levels.groupBy("gram").agg(F.sort_array(F.collect_list(F.struct("k", "a", "b", "na", "nb", "ta", "tb"))).alias("x"))  # ORDER + 1 each
    mixed = "aggregate(x, double({p}), (p, y) -> CASE WHEN y.n{m} = 0 THEN p ELSE (y.{m} + y.t{m} * p) / (y.n{m} + y.t{m}) END)"
    a, b = (F.expr(mixed.format(p=1 / ALPHABET, m=m)) for m in "ab")
    return rows.select("gram", (F.ln(a) - F.ln(b)).alias("score"))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule``, ``verdict``, ``score`` for every row.

    A null url, or one without ``://``, has an empty host and path. ``verdict``
    is the rule's; without a rule it is ``allow`` where ``score`` (the difference
    of log-likelihoods per character, 0 for an empty url) reaches the calibrated
    threshold, else ``block``. If no URL is allowed, or none blocked, by a rule,
    there is nothing to tell them apart by and the rest is allowed. One row out
    for each row in, repeated rows and null ids too; an empty table gives an
    empty result.
    """
    text, verdict = rule_columns(rules)
    rows = with_parts(pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").alias("_url")), "_url")
    rows = rows.withColumn("_rule", text).withColumn("_verdict", verdict)
    urls = stored(rows.groupBy("_letters").agg(F.count_if(F.col("_verdict") == "allow").alias("a"), F.count_if(F.col("_verdict") == "block").alias("b")), "urls")
    grams = _grams(urls).groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    scores = stored(gram_scores(grams), "grams")
    scored = _grams(urls).join(scores, "gram").groupBy("_letters", "a", "b").agg(F.avg("score").alias("score"))
    scored = stored(scored, "scores")
    mean = lambda w, x: F.try_divide(F.sum(F.col(w) * x), F.sum(F.col(w).cast("double")))
    marks = scored.agg(*[mean(w, F.col("score") ** p).alias(f"{w}{p}") for w in "ab" for p in (1, 2)])
    spread = {w: F.sqrt(F.greatest(F.col(f"{w}2") - F.col(f"{w}1") ** 2, F.lit(0.0))) + 1e-9 for w in "ab"}
    limit = marks.select(((F.col("a1") * spread["b"] + F.col("b1") * spread["a"]) / (spread["a"] + spread["b"])).alias("limit")).first()[0]
    score = F.coalesce("score", F.lit(0.0))
    judged = rows.join(scored.select("_letters", "score"), "_letters", "left")
    other = F.when(score >= F.lit(limit), "allow").otherwise("block") if limit is not None else F.lit("allow")
    return judged.select(F.col("_id").alias(id_col), "host", "path", F.col("_rule").alias("rule"), F.coalesce("_verdict", other).alias("verdict"), score.alias("score"))


def op6(spark, sf_dir: str) -> DataFrame:
    return filter_urls(tables(spark, sf_dir, "pages")).drop("score")


def _oracle() -> str:
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{t}'" for f, t, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits) + " END"
    flat = f"CAST(1.0 AS DOUBLE) / {ALPHABET}"
    levels = []
    for k in range(ORDER + 1):
        levels.append(f"""c{k} AS (SELECT right(gram, {k + 1}) AS g, sum(a) AS a, sum(b) AS b FROM grams GROUP BY 1),
t{k} AS (SELECT left(g, {k}) AS x, sum(a) AS na, sum(b) AS nb, count(*) FILTER (a > 0) AS ta, count(*) FILTER (b > 0) AS tb FROM c{k} GROUP BY 1),
p{k} AS (SELECT gram, CASE WHEN na = 0 THEN pa ELSE (c.a + ta * pa) / (na + ta) END AS pa, CASE WHEN nb = 0 THEN pb ELSE (c.b + tb * pb) / (nb + tb) END AS pb
  FROM {f'p{k - 1}' if k else f'(SELECT gram, {flat} AS pa, {flat} AS pb FROM grams)'} JOIN c{k} c ON right(gram, {k + 1}) = g JOIN t{k} ON left(g, {k}) = x)""")
    return f"""
WITH parts AS (SELECT page_id, coalesce(url, '') AS url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
  translate(CASE WHEN contains(url, '://') THEN rest ELSE url END, '{_UPPER}', '{_LOWER}') AS letters FROM parts),
ruled AS (SELECT *, {rule} AS rule, {verdict} AS ruling FROM split),
urls AS (SELECT letters, count(*) FILTER (ruling = 'allow') AS a, count(*) FILTER (ruling = 'block') AS b FROM ruled GROUP BY letters),
pos AS MATERIALIZED (SELECT letters, a, b, substr(repeat(chr(2), {ORDER}) || letters, i, {ORDER + 1}) AS gram FROM (SELECT *, unnest(range(1, length(letters) + 1)) AS i FROM urls)),
grams AS (SELECT gram, sum(a) AS a, sum(b) AS b FROM pos GROUP BY gram),
{", ".join(levels)},
scored AS (SELECT letters, a, b, avg(ln(pa) - ln(pb)) AS score FROM pos JOIN p{ORDER} USING (gram) GROUP BY ALL),
marks AS (SELECT sum(a * score) / sum(a) AS a1, sum(b * score) / sum(b) AS b1, sum(a * score * score) / sum(a) AS a2, sum(b * score * score) / sum(b) AS b2 FROM scored),
spread AS (SELECT a1, b1, sqrt(greatest(a2 - a1 * a1, 0)) + 1e-9 AS sa, sqrt(greatest(b2 - b1 * b1, 0)) + 1e-9 AS sb FROM marks),
edge AS (SELECT (a1 * sb + b1 * sa) / (sa + sb) AS cut FROM spread)
SELECT page_id, host, path, rule, coalesce(ruling, CASE WHEN cut IS NULL OR coalesce(score, 0) >= cut THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled LEFT JOIN scored USING (letters) CROSS JOIN edge
"""


QUERIES = {"op6_url_filter": op6}
ORACLES = {"op6_url_filter": _oracle()}
