"""Exact dedup through an extendible-hash index on shared files.

1. ``entry_log``: every scan task groups equal texts of its rows by comparing
   bytes and writes one entry per distinct text (hash key, text, members) to the
   shared folder. A text that a third of all rows share leaves a task once.
2. ``grow_directory``: the directory starts with one bucket. While a bucket is
   overfull it splits by its next hash bit, and the directory doubles whenever
   a bucket's depth would pass its own. Bytes come from one aggregate per prefix.
3. ``chain``: owner tasks each take a contiguous range of hash keys (whole
   buckets, about equal bytes), stream their entries in key order and keep the
   chain of distinct texts of the current key, comparing bytes. What they find is
   the index: one row per entry, pointing to the head of its chain position.
4. ``members``: entries meet their group's size and unfold to rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import SEPARATORS, arrow, only, shared_table, shuffle_partitions

_LOG = ("uid long, key long, norm binary, best_chars long, best_id long, n long, "
        "members array<struct<doc_id: long, row_hash: long, best: boolean>>")
#: bytes that a member takes in a scan task, about
_MEMBER = 256
_INDEX = "uid long, bucket int, key long, chain int, head boolean, keep_id long, n long, text_sha256 string"


def hash_key(norm: bytes, bits: int = 64) -> int:
    """The text's hash, of which only ``bits`` vary (fewer bits force
    collisions, for tests), as a signed long in the order of the unsigned one."""
    h = xxhash.xxh64_intdigest(norm, 7)
    return ((h >> (64 - bits)) << (64 - bits)) - (1 << 63)


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def entry_log(docs: DataFrame, hash_bits: int = 64, flush_bytes: int = 32 << 20) -> DataFrame:
    """Entries of (doc_id, text): one per distinct text and task, or more where a
    task's distinct texts and their members (_MEMBER bytes each) pass ``flush_bytes``."""
    schema = arrow(_LOG)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId() << 33, 0

        def rows(groups):
            nonlocal seq
            out = []
            for norm, members in groups.items():
                best = min(range(len(members)), key=lambda i: (-members[i][0], members[i][1] is None, members[i][1] or 0))
                out.append({"uid": part + seq, "key": hash_key(norm, hash_bits), "norm": norm, "best_chars": members[best][0],
                            "best_id": members[best][1], "n": len(members),
                            "members": [{"doc_id": m[1], "row_hash": m[2], "best": i == best} for i, m in enumerate(members)]})
                seq += 1
            return pa.RecordBatch.from_pylist(out, schema=schema)

        groups: dict[bytes, list] = {}
        held = 0
        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = text or ""
                raw = text.encode()
                norm = raw.translate(None, SEPARATORS)
                if norm not in groups:
                    held += len(norm)
                held += _MEMBER
                groups.setdefault(norm, []).append((len(text), i, _signed(xxhash.xxh64_intdigest(raw, 42))))
                if held > flush_bytes:
                    yield rows(groups)
                    groups, held = {}, 0
        if groups:
            yield rows(groups)

    return docs.mapInArrow(combine, _LOG)


class Directory:
    """``local[bucket]`` is the number of hash bits that a bucket's keys share,
    ``bits[bucket]`` are these bits; ``slots`` maps each prefix of ``depth`` bits
    to its bucket."""

    def __init__(self) -> None:
        self.depth, self.local, self.bits = 0, [0], [0]

    def split(self, bucket: int) -> int:
        """One more bit for an overfull bucket; the directory doubles where the
        bucket is already as deep as it. Returns the bucket of the upper half."""
        if self.local[bucket] == self.depth:
            self.depth += 1
        self.local[bucket] += 1
        self.bits[bucket] <<= 1
        self.local.append(self.local[bucket])
        self.bits.append(self.bits[bucket] | 1)
        return len(self.local) - 1

    def span(self, bucket: int, depth: int) -> slice:
        """The prefixes of ``depth`` bits that belong to a bucket."""
        free = depth - self.local[bucket]
        return slice(self.bits[bucket] << free, (self.bits[bucket] + 1) << free)

    @property
    def slots(self) -> np.ndarray:
        out = np.zeros(1 << self.depth, dtype=np.int32)
        for b in range(len(self.local)):
            out[self.span(b, self.depth)] = b
        return out

    def prefix(self, key: Column | str) -> Column:
        """The first ``depth`` bits of a key."""
        return _prefix(F.col(key) if isinstance(key, str) else key, self.depth)


def _prefix(key: Column, depth: int) -> Column:
    flipped = key.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    return F.shiftrightunsigned(flipped, 64 - depth).cast("int") if depth else F.lit(0)


def grow_directory(entries: DataFrame, bucket_bytes: int = 64 << 20, max_depth: int = 16) -> tuple[Directory, list[float]]:
    """The directory over (key, bytes) and the bytes of its buckets.

    It has at most 2 ** max_depth slots, and the bytes per prefix of that length
    are all that the driver gets. Buckets that such a directory still leaves
    overfull (very large inputs, or one text with very many entries) stay
    whole: owners stream them, nothing holds them."""
    sizes = np.zeros((1 << max_depth) + 1)
    for prefix, size in entries.groupBy(_prefix(F.col("key"), max_depth).alias("p")).agg(F.sum("bytes")).collect():
        sizes[prefix + 1] = size or 0
    upto = np.cumsum(sizes)

    def held(b: int) -> float:
        s = directory.span(b, max_depth)
        return float(upto[s.stop] - upto[s.start])

    directory = Directory()
    worklist = [0]
    while worklist:
        b = worklist.pop()
        if held(b) > bucket_bytes and directory.local[b] < max_depth:
            worklist += [b, directory.split(b)]
    return directory, [held(b) for b in range(len(directory.local))]


def owners(directory: Directory, total: list[float], tasks: int) -> np.ndarray:
    """The owner of each slot: contiguous slots, whole buckets, about equal bytes."""
    by_key = np.array(sorted(range(len(total)), key=lambda b: directory.span(b, directory.depth).start))
    size = np.array(total)[by_key]
    share = (np.cumsum(size) - size / 2) / max(size.sum(), 1)
    owner = np.zeros(len(total), dtype=np.int32)
    owner[by_key] = np.minimum((share * tasks).astype(np.int32), tasks - 1)
    return owner[directory.slots]


def _lookup(slots: np.ndarray, prefix: Column) -> Column:
    return F.element_at(F.split(F.lit(",".join(map(str, slots.tolist()))), ","), prefix + 1).cast("int")


def chain(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Index rows of entries that arrive by key, most characters and smallest id
    first. Holds the distinct texts of one key."""
    key, texts = None, []
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["key"] != key:
                key, texts = r["key"], []
            at = next((c for c, (norm, _, _) in enumerate(texts) if norm == r["norm"]), len(texts))
            head = at == len(texts)
            if head:
                texts.append((r["norm"], r["best_id"], hashlib.sha256(r["norm"]).hexdigest()))
            out.append({"uid": r["uid"], "bucket": r["bucket"], "key": key, "chain": at, "head": head,
                        "keep_id": texts[at][1], "n": r["n"], "text_sha256": texts[at][2]})
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64,
                bucket_bytes: int = 64 << 20, flush_bytes: int = 32 << 20) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256,
    row_hash (XXH64 of the text as it was).

    Texts are equal when identical after deleting space and U+0009 to U+000D. Null counts
    as empty. The row with the most code points stays, then the smallest id; a
    null id comes last. Of repeated rows (same id, same text) one is kept. An
    empty table gives no rows. Other columns are ignored.
    """
    spark = df.sparkSession
    log = shared_table(entry_log(only(df, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long")),
                                 hash_bits, flush_bytes), "entries")
    directory, total = grow_directory(log.select("key", F.length("norm").alias("bytes")), bucket_bytes)
    tasks = shuffle_partitions(spark)
    prefix = directory.prefix("key")
    routed = log.select("uid", "key", "norm", "best_chars", "best_id", "n", _lookup(directory.slots, prefix).alias("bucket"),
                        _lookup(owners(directory, total, tasks), prefix).alias("owner"))
    owned = routed.repartitionById(tasks, "owner").drop("owner")
    owned = owned.sortWithinPartitions("key", F.desc("best_chars"), F.asc_nulls_last("best_id"))
    schema = arrow(_INDEX)
    index = shared_table(owned.mapInArrow(lambda batches: chain(batches, schema), _INDEX), "index")
    sizes = index.groupBy("key", "chain").agg(F.sum("n").alias("group_size"))
    found = index.join(sizes, ["key", "chain"]).select("uid", "head", "keep_id", "group_size", "text_sha256")
    members = log.select("uid", F.explode("members").alias("m"))
    return members.join(found, "uid").select(
        "m.doc_id", "keep_id", "group_size", (F.col("head") & F.col("m.best")).alias("kept"), "text_sha256", "m.row_hash")


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's kept rows with all their columns, one per group of equal texts.

    Kept rows are found again by id and hash of their text; a row that the
    input repeats (same id, same text) comes back once. Any column names are
    fine: the input's row travels as one struct. An empty table gives no rows.
    """
    found = shared_table(exact_dedup(df, id_col, text_col), "groups")
    kept = found.where("kept").select("doc_id", "row_hash")
    rows = df.select(F.struct("*").alias("row"))
    rows = rows.select("row", F.col("row").getField(id_col).cast("long").alias("id"),
                       F.xxhash64(F.coalesce(F.col("row").getField(text_col), F.lit(""))).alias("hash"))
    back = rows.join(kept, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("row_hash")), "left_semi")
    if not found.groupBy("doc_id", "row_hash").count().where("count > 1").isEmpty():
        back = back.dropDuplicates(["id", "hash"])
    return back.select("row.*")
