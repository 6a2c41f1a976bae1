"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes
log-count ratios.

Features are the distinct character n-grams of the lower-cased whole text, as
64-bit hashes. Over a bounded sample of labelled rows:

1. every n-gram's hash falls into one of 2 ** BITS buckets, and the documents of
   either class that hold a bucket are counted (one aggregate, at most that many rows);
   buckets that are significantly (log-likelihood ratio) more frequent in
   one class go on;
2. the n-grams of those buckets are counted by their full hash; the significant
   ones become the vocabulary, each with its ratio r = log((p + a) / |p|) - log((q + a) / |q|);
3. a logistic regression is fitted on vectors that hold r for each vocabulary
   n-gram present.

A score is then one sum per document: the bucket table screens all positions,
full hashes decide, and each distinct n-gram counts once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import only

BITS = 20
_CHUNK = 1 << 20


@dataclass(frozen=True)
class Model:
    """``table`` marks the buckets of the vocabulary's hashes (sorted);
    ``weights`` are their coefficients times their ratios."""
    sizes: tuple[int, ...]
    hashes: np.ndarray
    weights: np.ndarray
    intercept: float

    @property
    def table(self) -> np.ndarray:
        t = np.zeros(1 << BITS, dtype=bool)
        t[(self.hashes >> np.uint64(64 - BITS)).astype(np.int64)] = True
        return t


def code_points(text: str | None) -> np.ndarray:
    """The lower-cased text with a space at either end (so that the ends of
    words show), runs of other separators as they are."""
    return np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def ngram_hashes(points: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash at each start of an n-gram."""
    n = len(points) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        h = (h ^ points[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h * np.uint64(0xD6E8FEB86659FD93)


def distinct_hashes(text: str | None, sizes: tuple[int, ...], table: np.ndarray | None = None) -> np.ndarray:
    """The distinct n-gram hashes of a whole text (in a bucket that ``table``
    marks, where given). Long texts go piece by piece, overlapping so that no n-gram is cut."""
    points, found = code_points(text), []
    for size in sizes:
        for a in range(0, max(len(points) - size + 1, 0), _CHUNK):
            h = ngram_hashes(points[a:a + _CHUNK + size - 1], size)
            found.append(np.unique(h if table is None else h[table[h >> np.uint64(64 - BITS)]]))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint64)


def held_out(doc_id) -> bool:
    """Whether a row's label is never learned from: crc32 of the id as text
    divisible by 5. Null ids are."""
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


def _ratio(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int, smooth: float) -> np.ndarray:
    """The log-count ratio of documents that hold a feature."""
    return np.log((pos + smooth) / (n_pos + 2 * smooth)) - np.log((neg + smooth) / (n_neg + 2 * smooth))


def _counts(sample: DataFrame, sizes: tuple[int, ...], table: np.ndarray | None) -> DataFrame:
    """(feature, label, docs) of (text, label): buckets, or with ``table`` full hashes
    inside the buckets it marks. Added up inside each task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        dense = np.zeros((2, 1 << BITS), dtype=np.int64)
        for b in batches:
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                h = distinct_hashes(text, sizes, table)
                if table is None:
                    dense[label, np.unique(h >> np.uint64(64 - BITS)).astype(np.int64)] += 1
                else:
                    for x in h.view(np.int64).tolist():
                        sums[x, label] = sums.get((x, label), 0) + 1
        for label in range(2):
            if table is None:
                at = np.flatnonzero(dense[label])
                n = dense[label, at]
            else:
                at = np.array([x for x, k in sums if k == label], dtype=np.int64)
                n = np.array([v for (_, k), v in sums.items() if k == label], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(np.full(len(at), label, np.int32)), pa.array(n)],
                                             ["feature", "label", "docs"])

    parts = sample.mapInArrow(run, "feature long, label int, docs long")
    return parts.groupBy("feature").agg(F.sum(F.when(F.col("label") == 1, F.col("docs")).otherwise(0)).alias("pos"),
                                        F.sum(F.when(F.col("label") == 0, F.col("docs")).otherwise(0)).alias("neg"))


def _significant(counts: DataFrame, most: int | None, n_pos: int, n_neg: int, least: float):
    """(feature, pos, neg) where the log-likelihood ratio of the feature's and the
    label's independence is at least ``least``, the ``most`` largest of them. The rest is
    dropped before the driver gets any."""
    n = float(n_pos + n_neg)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    g = F.lit(0.0)
    for seen, row, col in ((pos, pos + neg, n_pos), (neg, pos + neg, n_neg), (n_pos - pos, n - pos - neg, n_pos), (n_neg - neg, n - pos - neg, n_neg)):
        g = g + F.when(seen > 0, 2 * seen * F.log(seen * n / (row * float(col)))).otherwise(0.0)
    kept = counts.withColumn("g", g).where(F.col("g") >= least)
    if most:
        kept = kept.orderBy(F.desc("g"), "feature").limit(most)
    rows = kept.select("feature", "pos", "neg").toPandas()
    return rows["feature"].to_numpy(np.int64), rows["pos"].to_numpy(float), rows["neg"].to_numpy(float)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int, seed: int = 42) -> DataFrame:
    """(text, label) of at most ``max_rows`` labelled rows, those with the
    smallest seeded hash of their id, none of them held out. An id that has
    both labels counts as 1. The picked ids are that many at most, so they are
    broadcast and the documents aren't shuffled."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    known = labels.where("doc_id is not null and label in (0, 1)").where(crc % 5 != 0)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    picked = known.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(max_rows)
    return docs.join(F.broadcast(picked), "doc_id").select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, sizes: tuple[int, ...] = (3, 4, 5), max_rows: int = 12000, smooth: float = 1.0,
        significance: float = 16.0, max_features: int | None = None, reg: float = 1e-3) -> Model:
    """A classifier of (doc_id, text) learned from (doc_id, label).

    At most ``max_rows`` labelled rows, whatever the corpus; every n-gram of theirs whose
    ratio is significant is a feature. With labels of one class only, or none, every score is the
    share of label 1 (0 without labels).
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import SparseVector, VectorUDT
    from pyspark.sql.types import DoubleType, StructField, StructType

    sample = labelled_sample(docs, labels, max_rows).select("text", F.col("label").cast("int").alias("label")).persist()
    try:
        n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
        n_pos, n_neg = n.get(1, 0), n.get(0, 0)
        empty = np.zeros(0)
        if not n_pos or not n_neg:
            return Model(sizes, empty.astype(np.uint64), empty, 50.0 if n_pos else -50.0)
        # other n-grams of a bucket weaken the one that counts, so buckets pass from half the level on
        buckets, _, _ = _significant(_counts(sample, sizes, None), None, n_pos, n_neg, significance / 2)
        table = np.zeros(1 << BITS, dtype=bool)
        table[buckets] = True
        feature, pos, neg = _significant(_counts(sample, sizes, table), max_features, n_pos, n_neg, significance)
        hashes = feature.view(np.uint64)
        order = np.argsort(hashes)
        hashes = hashes[order]
        ratio = _ratio(pos[order], neg[order], n_pos, n_neg, smooth)
        if not len(hashes):
            return Model(sizes, hashes, empty, float(np.log(n_pos / n_neg)))
        screen = Model(sizes, hashes, ratio, 0.0)

        def vectors(batches):
            import pandas as pd

            marked = screen.table
            for frame in batches:
                at = [_present(t, screen, marked) for t in frame["text"]]
                yield pd.DataFrame({"label": frame["label"].astype(float), "at": [a.tolist() for a in at]})

        rows = sample.mapInPandas(vectors, "label double, at array<int>")
        size, values = len(hashes), ratio.tolist()

        # a vector holds r at each vocabulary n-gram that is present
        def vector(r):
            return r["label"], SparseVector(size, r["at"], [values[i] for i in r["at"]])

        spark = docs.sparkSession
        schema = StructType([StructField("label", DoubleType()), StructField("features", VectorUDT())])
        train = spark.createDataFrame(rows.rdd.map(vector), schema).coalesce(
            max(1, spark.sparkContext.defaultParallelism)).persist()
        try:
            lr = LogisticRegression(maxIter=60, regParam=reg, standardization=False).fit(train)
        finally:
            train.unpersist()
        return Model(sizes, hashes, lr.coefficients.toArray() * ratio, float(lr.intercept))
    finally:
        sample.unpersist()


def _present(text: str | None, model: Model, table: np.ndarray) -> np.ndarray:
    """Positions in the vocabulary of a text's distinct n-grams."""
    h = distinct_hashes(text, model.sizes, table)
    at = np.searchsorted(model.hashes, h)
    at[at == len(model.hashes)] = 0
    return at[model.hashes[at] == h] if len(model.hashes) else at[:0]


def score_text(text: str | None, model: Model, table: np.ndarray | None = None) -> float:
    at = _present(text, model, model.table if table is None else table)
    x = float(np.clip(model.intercept + model.weights[at].sum(), -700, 700))
    return 1 / (1 + np.exp(-x))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted (1 from 0.5 up).

    Whole texts; null counts as empty, and an empty text's score is the
    intercept's. Rows with a null id count as held out. Repeated rows get equal scores. An
    empty table gives no rows. Other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table
        for b in batches:
            ids = b.column("doc_id")
            s = np.array([score_text(t, model, table) for t in b.column("text").to_pylist()], dtype=float)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([held_out(i) for i in ids.to_pylist()], pa.bool_()), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    docs = only(df, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The input's rows that score below 0.5, with all their columns, whatever
    their names. Null and empty texts score as the intercept does, repeated rows
    alike; an empty table gives no rows."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("boolean")
    def clean(texts):
        table = model.table
        return texts.map(lambda t: score_text(t, model, table) < 0.5).astype(bool)

    return df.where(clean(F.col(f"`{text_col}`")))
