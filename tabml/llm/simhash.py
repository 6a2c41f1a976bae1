"""SimHash near-dedup with multi-index hashing.

A fingerprint is cut into two halves. Of two fingerprints at most 3 bits
apart, one half differs by at most one bit, so every fingerprint enumerates
the ball of radius 1 around each of its halves, fetches what the table holds
there, and complete distances are verified. Probes only go from a 0 bit to a
1 bit (the pair's other end has the 1), so a pair meets once per half.

Documents of equal fingerprints collapse to one node before that. Matches of a
table bucket never leave their task as pairs: a spanning forest of the verified
links does, which is as connected and at most as large as the bucket. Buckets of
very many rows are cut into chunks, and each pair of chunks is a group of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import LOWER, only, shared_table, shuffle_partitions, signed, texts_of
from tabml.llm.components import components, local_roots, local_star

#: rows of a bucket above which it is cut into chunks, each pair of them a task's group
CHUNK = 1 << 14
#: values that are compared at once inside one bucket
_BLOCK = 2048


def shingle_hashes(text: bytes, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every shingle, repeats included; with fewer words than a shingle
    has, of the whole sequence; without words, none."""
    found = text.translate(LOWER).split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) < words:
        return np.array([digest(joined, seed)], dtype=np.uint64)
    ends = list(accumulate(map(len, found), lambda at, n: at + n + 1))
    return np.array([digest(joined[a:e], seed) for a, e in zip([0, *(e + 1 for e in ends)], ends[words - 1:])], dtype=np.uint64)


def fingerprint(text: bytes, words: int, seed: int = 42) -> int:
    """A bit is 1 if it is set in over half the shingle hashes; 0 without words."""
    h = shingle_hashes(text, words, seed)
    if not len(h):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, len(h), 1 << 16):
        part = h[a:a + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, row_hash, fp) of every row of (doc_id, row_hash, text); null text has no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, words, seed) for t in texts_of(b.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row_hash"), pa.array(signed(fp))], ["doc_id", "row_hash", "fp"])

    return docs.mapInArrow(run, "doc_id long, row_hash long, fp long")


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Table rows and ball probes of (node, fp): the bucket is the half's index
    and value; a table row has ``probe`` false."""
    one = np.uint64(1)
    for b in batches:
        node = b.column("node").to_numpy(zero_copy_only=False)
        fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for step in range(0, len(fp), 1 << 14):
            f, n = fp[step:step + (1 << 14)], node[step:step + (1 << 14)]
            for half in range(2):
                value = (f >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
                keys, fps, nodes, probes = [value], [f], [n], [np.zeros(len(f), bool)]
                for bit in range(32):
                    flip = one << np.uint64(bit)
                    free = (value & flip) == 0
                    keys.append(value[free] | flip)
                    fps.append(f[free])
                    nodes.append(n[free])
                    probes.append(np.ones(int(free.sum()), bool))
                key = np.concatenate(keys) | np.uint64(half << 32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(key)), pa.array(np.concatenate(probes)), pa.array(signed(np.concatenate(fps))), pa.array(np.concatenate(nodes))],
                    ["bucket", "probe", "fp", "node"])


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _links(fp: np.ndarray, probe: np.ndarray, distance: int):
    """Verified links inside one bucket, block by block: (i, j) positions where i
    is a table row. Rows that probe the bucket aren't compared with each other."""
    home = int((~probe).sum())
    for a in range(0, home, _BLOCK):
        for c in range(a, len(fp), _BLOCK):
            i, j = np.nonzero(_bits(fp[a:min(a + _BLOCK, home), None] ^ fp[None, c:c + _BLOCK]) <= distance)
            i, j = i + a, j + c
            ok = i < j
            if ok.any():
                yield i[ok], j[ok]


def _verify(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None

        def forest(fp, probe, node):
            stars = [local_star(i, j) for i, j in _links(fp, probe, distance)]
            if not stars:
                return []
            root = local_roots(*(np.concatenate(x) for x in zip(*stars)), node)
            return list(zip(node[root != node].tolist(), root[root != node].tolist()))

        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "i", "j", "probe", "fp", "node")]
            if left is not None:
                cols = [np.concatenate([x, y]) for x, y in zip(left, cols)]
            bucket, i, j, probe, fp, node = cols
            starts = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            last = int(starts[-1])
            left = [c[last:] for c in cols]
            ends = np.r_[starts[1:], len(bucket)][:-1]
            starts = starts[:-1]
            edges = []
            # a table row first (probe false sorts first), and something beside it
            for s, e in zip(*(x[(~probe[starts]) & (ends - starts > 1)].tolist() for x in (starts, ends))):
                edges += forest(fp[s:e].view(np.uint64), probe[s:e], node[s:e])
            yield _edges(edges)
        if left is not None and not left[3][0] and len(left[0]) > 1:
            yield _edges(forest(left[4].view(np.uint64), left[3], left[5]))

    return run


def _edges(edges) -> pa.RecordBatch:
    u, v = (np.array(x, dtype=np.int64) for x in (zip(*edges) if edges else ([], [])))
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def link(nodes: DataFrame, distance: int = 3, chunk: int = CHUNK) -> DataFrame:
    """Edges (u, v) that connect exactly the nodes of (node, fp) which links of
    at most ``distance`` differing bits (0 to 3) connect; fp must be distinct."""
    if not 0 <= distance <= 3:
        raise ValueError("two halves with balls of radius 1 find distances up to 3")
    probes = nodes.mapInArrow(_probe, "bucket long, probe boolean, fp long, node long")
    dealt = _pairs(probes, chunk).repartition(shuffle_partitions(nodes.sparkSession), "bucket", "i", "j")
    return dealt.sortWithinPartitions("bucket", "i", "j", "probe").mapInArrow(_verify(distance), "u long, v long")


def _pairs(probes: DataFrame, chunk: int) -> DataFrame:
    """The rows of each bucket with the pairs (i, j) of chunks that they belong to:
    one pair (0, 0), or all pairs of a chunk where a bucket has over ``chunk`` rows."""
    large = probes.groupBy("bucket").count().where(F.col("count") > chunk)
    large = shared_table(large.select("bucket", F.ceil(F.col("count") / chunk).cast("int").alias("chunks")), "large_buckets")
    rows = probes.join(large, "bucket", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return rows.select("bucket", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "probe", "fp", "node")


def _found(df: DataFrame, id_col: str, text_col: str, words: int, distance: int, seed: int) -> DataFrame:
    """(doc_id, row_hash, fp, component, component_id) of every row; ``component`` is
    the component's smallest fingerprint, also for rows without an id."""
    docs = only(df, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    docs = docs.withColumn("row_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    fps = shared_table(fingerprints(docs, words, seed), "fingerprints")
    # fingerprints are the nodes: an id may have several of them
    nodes = shared_table(fps.groupBy("fp").agg(F.min("doc_id").alias("id")), "nodes")
    comp = components(link(nodes.select(F.col("fp").alias("node"), "fp"), distance))
    of = nodes.join(comp, nodes["fp"] == comp["node"], "left").select("fp", "id", F.coalesce("component", "fp").alias("component"))
    of = shared_table(of, "components")
    least = of.groupBy("component").agg(F.min("id").alias("component_id"))
    return fps.join(of.join(least, "component").select("fp", "component", "component_id"), "fp")


def simhash(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, distance: int = 3,
            seed: int = 42) -> DataFrame:
    """One row per input row: doc_id, fp (signed long), fingerprint (16 hex
    digits), component_id (smallest id reachable over links of at most
    ``distance`` bits).

    Words are what lies between spaces and U+0009 to U+000D, A-Z lower-cased. Null and
    empty texts have fingerprint 0 and link like others. Repeated rows share a
    fingerprint; rows with one id and unlike texts each have their own component.
    Rows without an id get component null when nothing with an id
    has a linked fingerprint, and never lend their id. An empty table gives no
    rows. Other columns are ignored.
    """
    return _found(df, id_col, text_col, words, distance, seed).select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, distance: int = 3) -> DataFrame:
    """The input's rows that stay, with all their columns: of each component the
    row with the smallest id. Of several rows with that id in one component the one with the
    smallest fingerprint stays, then the smallest hash of the text, and a repeated row
    only once; rows with one id in different components don't affect each
    other. Rows without an id stay (nothing names them). Any column names are fine: the
    input's row travels as one struct. An empty table gives no rows."""
    found = shared_table(_found(df, id_col, text_col, words, distance, 42), "near_copies")
    stay = found.where("doc_id is not null").groupBy("component").agg(F.min(F.struct("doc_id", "fp", "row_hash")).alias("s"))
    stay = stay.select("s.doc_id", "s.row_hash")
    rows = df.select(F.struct("*").alias("row"))
    rows = rows.select("row", F.col("row").getField(id_col).cast("long").alias("id"),
                       F.xxhash64(F.coalesce(F.col("row").getField(text_col), F.lit(""))).alias("hash"))
    kept = rows.where("id is not null").join(stay, (F.col("id") == F.col("doc_id")) & (F.col("hash") == F.col("row_hash")), "left_semi")
    if not found.where("doc_id is not null").groupBy("doc_id", "row_hash").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["id", "hash"])
    return kept.unionAll(rows.where("id is null")).select("row.*")
