"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

1. Random indexing over the whole corpus: a word's vector is the sum of sparse
   random index vectors of its neighbours. Words are hashed into ``BUCKETS``
   rows, so each task sums one small integer table, the tables are added up by
   Spark, and the result has a fixed size that can be broadcast.
2. A document is the mean of its words' unit vectors, plain and with frequent
   words weighted down, with a few figures of how those vectors follow on each other.
3. A network with one hidden layer is fitted with numpy on a bounded sample of
   labelled rows; a temperature fitted on a part left out calibrates its output.
4. Every document is scored where it lies; no text is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.store import tables
from tidemark.llm.words import chunks, flat, mix, out_schema, owner, word_bounds, word_hashes

BUCKETS, WIDTH, NONZERO = 1 << 14, 48, 4
#: Labelled rows that the network is fitted on, at most.
TRAIN_ROWS = 20_000
THRESHOLD = 0.7
_CHUNK = 1 << 19

_KIND = np.zeros(256, np.uint8)  # 0 white space, 1 letters, 2 digits, 3 the rest
for _b in range(256):
    _KIND[_b] = 1 if _b >= 0x80 or chr(_b).isalpha() else 2 if chr(_b).isdigit() else 0 if _b == 0x20 or 0x09 <= _b <= 0x0D else 3


def word_buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each run of letters, digits or signs, and each text's first run."""
    data, bounds = flat(column)
    kind = np.zeros(len(data) + 2, np.uint8)
    kind[1:-1] = _KIND[data]
    edge = kind[1:] != kind[:-1]
    edge[bounds] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    real = kind[starts + 1] > 0
    starts, ends = starts[real], ends[real]
    return (word_hashes(data, starts, ends) % np.uint64(BUCKETS)).astype(np.int64), np.searchsorted(starts, bounds)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each bucket's index vector."""
    x = mix(np.arange(BUCKETS * NONZERO, dtype=np.uint64) + np.uint64(0x51ED)).reshape(BUCKETS, NONZERO)
    return (x % np.uint64(WIDTH)).astype(np.int64), np.where((x >> np.uint64(40)) & np.uint64(1), 1, -1)


def add_contexts(table: np.ndarray, counts: np.ndarray, bucket: np.ndarray, first: np.ndarray, reach: int = 2) -> None:
    """Add to each word's row the index vectors of the words up to ``reach`` away in its text."""
    places, signs = index_vectors_cached()
    row = owner(first)
    counts += np.bincount(bucket, minlength=BUCKETS)
    for step in range(1, reach + 1):
        same = np.flatnonzero(row[step:] == row[:-step])
        for a, b in ((bucket[same], bucket[same + step]), (bucket[same + step], bucket[same])):
            at = (a[:, None] * WIDTH + places[b]).ravel()
            table += np.bincount(at, weights=signs[b].ravel(), minlength=BUCKETS * WIDTH).astype(np.int64)


_cache: list = []


def index_vectors_cached():
    if not _cache:
        _cache.append(index_vectors())
    return _cache[0]


def word_vectors(docs: DataFrame, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and counts of all buckets, summed over every text of ``docs``."""
    def sums(batches):
        table, counts = np.zeros(BUCKETS * WIDTH, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in chunks(batches, "_text", _CHUNK):
            add_contexts(table, counts, *word_buckets(batch.column(0)))
        used = np.flatnonzero(counts)
        own = table.reshape(BUCKETS, WIDTH)[used]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), *(pa.array(own[:, j]) for j in range(WIDTH))], names=["bucket", "n", *(f"v{j}" for j in range(WIDTH))])

    columns = ["n", *(f"v{j}" for j in range(WIDTH))]
    parts = docs.select(F.col(f"`{text_col}`").alias("_text")).mapInArrow(sums, "bucket long, " + ", ".join(f"{c} long" for c in columns))
    # BUCKETS rows at most, whatever the input.
    rows = parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    vectors, counts = np.zeros((BUCKETS, WIDTH), np.float32), np.zeros(BUCKETS)
    at = rows["bucket"].to_numpy()
    counts[at] = rows["n"].to_numpy()
    vectors[at] = np.stack([rows[c].to_numpy() for c in columns[1:]], 1)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9), counts


def pooled(column: pa.Array, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One row of features for each text; zeros stand for what a text without words lacks."""
    bucket, first = word_buckets(column)
    n = np.diff(first)
    out = np.zeros((len(n), 2 * WIDTH + 4))
    if not len(bucket):
        return out
    row, have = owner(first), np.flatnonzero(n)
    own = vectors[bucket]
    weight = weights[bucket][:, None]
    out[have, :WIDTH] = np.add.reduceat(own, first[have]) / n[have, None]
    total = np.maximum(np.add.reduceat(weight, first[have]), 1e-9)
    out[have, WIDTH:2 * WIDTH] = np.add.reduceat(own * weight, first[have]) / total
    follow = np.zeros(len(bucket))
    same = row[1:] == row[:-1]
    follow[:-1][same] = np.einsum("ij,ij->i", own[:-1][same], own[1:][same])
    again = np.zeros(len(bucket))
    again[:-1][same] = bucket[:-1][same] == bucket[1:][same]
    out[have, -4] = np.linalg.norm(out[have, :WIDTH], axis=1)
    out[have, -3] = np.add.reduceat(follow, first[have]) / n[have]
    out[have, -2] = np.add.reduceat(again, first[have]) / n[have]
    out[have, -1] = np.log1p(n[have])
    return out


class Network:
    """Standardised features, one hidden layer of tanh units, a logistic output with a temperature."""

    def __init__(self, hidden: int = 24, seed: int = 5):
        self.hidden, self.seed, self.temperature = hidden, seed, 1.0

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 60, batch: int = 128, rate: float = 0.01, decay: float = 1e-4) -> "Network":
        rng = np.random.default_rng(self.seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        x = self._standard(x)
        prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        w = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], self.hidden)), np.zeros(self.hidden),
             rng.normal(0, self.hidden ** -0.5, self.hidden), np.array(np.log(prior / (1 - prior)))]
        m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for k in range(0, len(x), batch):
                own, want = x[order[k:k + batch]], y[order[k:k + batch]]
                h = np.tanh(own @ w[0] + w[1])
                d = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -30, 30))) - want) / len(own)
                back = np.outer(d, w[2]) * (1 - h * h)
                grads = [own.T @ back + decay * w[0], back.sum(0), h.T @ d + decay * w[2], np.array(d.sum())]
                t += 1
                step = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    w[i] = w[i] - step * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        self.weights = w
        return self

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> "Network":
        """The temperature with the least log loss on rows that were not fitted on."""
        if len(y):
            z = self._logit(x)
            losses = [(np.logaddexp(0, np.where(y > 0, -z, z) / t).mean(), t) for t in np.geomspace(0.25, 8, 61)]
            self.temperature = float(min(losses)[1])
        return self

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _logit(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.tanh(self._standard(x) @ w[0] + w[1]) @ w[2] + w[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._logit(x) / self.temperature, -40, 40)))


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus ``held_out``, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from ``threshold`` on).

    The network learns from at most ``train_rows`` labelled rows (those whose
    ids hash lowest) with crc32(id as text) mod 4 not 2; of these, remainder 3
    calibrates. Word vectors come from all of ``docs``. Labels that are null,
    not 0 or 1, contradictory, or of an unknown id are left out. Without both
    labels in the sample every score is their mean (0.5 without any). A null or
    empty text is scored like others, from its zero features. One row out for
    each row in, repeated ids too; columns of ``docs`` with an added name are
    replaced.
    """
    docs = docs.drop("held_out", "score", "predicted")
    vectors, counts = word_vectors(docs, text_col)
    weights = (1e-3 / (1e-3 + counts / max(1.0, counts.sum()))).astype(np.float32)
    sc = docs.sparkSession.sparkContext
    model = sc.broadcast((vectors, weights))

    label = F.col(f"`{label_col}`")
    known = (labels.select(F.col(f"`{id_col}`").alias("_id"), label.cast("int").alias("_y")).where("_id IS NOT NULL AND _y IN (0, 1)")
             .groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_z")).where("_y = _z").drop("_z").where(~held_out("_id")))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(train_rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).join(F.broadcast(sample), "_id")

    def features(batches):
        table, weight = model.value
        for batch in chunks(batches, "_text", _CHUNK):
            x = pooled(batch.column(batch.schema.get_field_index("_text")), table, weight)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("_id")), batch.column(batch.schema.get_field_index("_y")), pa.array(list(x), pa.list_(pa.float64()))], names=["_id", "_y", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts.select("_id", "_text", "_y").mapInArrow(features, f"_id {kind}, _y int, x array<double>")
    rows = rows.withColumn("_part", F.crc32(F.col("_id").cast("string").cast("binary")) % 4).toPandas()
    network = None
    if rows["_y"].nunique() == 2:
        x, y, part = np.array(rows["x"].tolist()), rows["_y"].to_numpy(float), rows["_part"].to_numpy()
        order = np.lexsort((*x.T[:3], rows["_id"].to_numpy()))  # the order of rows must not matter
        x, y, part = x[order], y[order], part[order]
        fit = part != 3 if len(set(y[part != 3])) == 2 else part >= 0
        network = Network().fit(x[fit], y[fit]).calibrate(x[~fit], y[~fit])
    plain = float(rows["_y"].mean()) if len(rows) else 0.5
    net = sc.broadcast(network)
    passed = docs.schema.fields
    names = [f.name for f in passed]

    def score(batches):
        table, weight = model.value
        for batch in chunks(batches, text_col, _CHUNK):
            if net.value is None:
                s = np.full(batch.num_rows, plain)
            else:
                s = net.value.score(pooled(batch.column(batch.schema.get_field_index(text_col)), table, weight))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], names=[*names, "score"])

    scored = docs.mapInArrow(score, out_schema("score double", passed))
    return scored.withColumn("held_out", held_out(id_col)).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op3(spark, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, tables(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


QUERIES = {"op3_quality": op3}
ORACLES = {}
