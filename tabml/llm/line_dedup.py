"""Line dedup: documents probe the arrays of a sharded minimal perfect hash.

1. ``slices``: scan tasks hash the lines of their documents and write slices,
   each with its distinct line hashes in order, the smallest and largest id and the
   number of documents of each, and which document has which line. A line leaves
   a slice once, however many documents have it.
2. ``line_index``: the hash's first bits are its shard. A shard's parts of all
   slices meet in one task, which numbers the hashes of lines that two documents
   have by a minimal perfect hash and lays out arrays by that number: fingerprint,
   count, smallest id. One row per shard is the index, on shared files. A line
   that isn't there is in one document only.
3. ``probe``: the slices' hashes are sent to the shards' arrays, packed, and come
   back as positions in the slice with the smallest id.
4. ``verdicts``: each slice tells its documents which hashes they lose.
5. ``line_dedup``: the texts meet their verdicts once.

A line's hash has 128 bits (XXH3): all of them place it, and half of them are the
fingerprint that an entry is compared by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import LOWER, SEPARATORS, arrow, only, shared_table, shuffle_partitions, sorted_groups, texts_of
from tabml.llm.minimal_hash import MinimalHash, build

_SLICE = "uid long, n long, hashes binary, first binary, last binary, count binary, starts binary, docs binary, ids binary, salts binary"
_PART = "shard long, owner int, uid long, at int, hashes binary, first binary, last binary, count binary"
_INDEX = "shard long, owner int, n long, sizes binary, words binary, fingerprint binary, count binary, first binary"
_REPLY = "uid long, at binary, first binary"
_VERDICT = "row_id long, row_salt long, dropped binary"
_KEPT = "doc_id long, n_lines long, n_dropped long, kept string"
#: a null id is above all others
NO_ID = (1 << 63) - 1
#: distinct hashes of a slice and of a shard, about
SLICE, SHARD = 1 << 19, 1 << 18
#: bytes of parts that a task gets, about
_TASK = 32 << 20
_CONTINUATION = bytes(range(0x80, 0xC0))

digest = xxhash.xxh3_128_digest


def line_key(line: bytes) -> bytes:
    """What two equal lines have in common: stripped, A-Z lower-cased."""
    return line.translate(LOWER).strip(SEPARATORS)


def _counts(key: bytes, chars: int) -> bool:
    """The key has at least ``chars`` code points."""
    return len(key) >= chars and (len(key) >= 4 * chars or len(key.translate(None, _CONTINUATION)) >= chars)


def line_keys(text: bytes, chars: int) -> list[bytes | None]:
    """The key of every line, None for those of fewer code points."""
    return [k if _counts(k := line.strip(SEPARATORS), chars) else None for line in text.translate(LOWER).split(b"\n")]


def _u64(x: bytes) -> np.ndarray:
    return np.frombuffer(x, dtype=np.uint64)


def _i64(x: bytes) -> np.ndarray:
    return np.frombuffer(x, dtype=np.int64)


def _i32(x: bytes) -> np.ndarray:
    return np.frombuffer(x, dtype=np.int32)


def slices(docs: DataFrame, chars: int, slice_lines: int = SLICE) -> DataFrame:
    """Slices of (row_id, row_salt, text): one per ``slice_lines`` lines of a scan task.
    They are numbered by task: write them before they are used."""
    schema = arrow(_SLICE)

    def one(uid, digests, doc, ids, salts) -> pa.RecordBatch:
        h = np.frombuffer(b"".join(digests), dtype=">u8").reshape(-1, 2).astype(np.uint64)
        doc, ids = np.array(doc, dtype=np.int32), np.array(ids, dtype=np.int64)
        order = np.lexsort((ids[doc], h[:, 1], h[:, 0]))
        h, doc = h[order], doc[order]
        new = np.r_[True, (h[1:] != h[:-1]).any(axis=1)]
        starts = np.r_[np.flatnonzero(new), len(h)].astype(np.int32)
        row = {"uid": uid, "n": len(starts) - 1, "hashes": h[starts[:-1]].tobytes(), "first": ids[doc[starts[:-1]]].tobytes(),
               "last": ids[doc[starts[1:] - 1]].tobytes(), "count": np.diff(starts).astype(np.int32).tobytes(), "starts": starts.tobytes(),
               "docs": doc.tobytes(), "ids": ids.tobytes(), "salts": np.array(salts, dtype=np.int64).tobytes()}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId() << 33, 0
        digests, doc, ids, salts = [], [], [], []
        for b in batches:
            for i, s, text in zip(b.column("row_id").to_pylist(), b.column("row_salt").to_pylist(), texts_of(b.column("text"))):
                found = [digest(k) for k in set(line_keys(text, chars)) if k is not None]
                for a in range(0, len(found), slice_lines):  # a document of very many lines is in several slices
                    some = found[a:a + slice_lines]
                    digests += some
                    doc += [len(ids)] * len(some)
                    ids.append(i)
                    salts.append(s)
                    if len(digests) >= slice_lines:
                        yield one(part + seq, digests, doc, ids, salts)
                        seq += 1
                        digests, doc, ids, salts = [], [], [], []
        if digests:
            yield one(part + seq, digests, doc, ids, salts)

    return docs.mapInArrow(run, _SLICE)


class Layout:
    """How many shards (a power of two) and owner tasks some hashes get. The first
    ``bits`` bits of a hash are its shard; an owner has a range of shards."""

    def __init__(self, lines: int, tasks: int, shard_lines: int = SHARD) -> None:
        self.tasks = max(tasks, -(-lines * 24 // _TASK))
        self.bits = max(1, (max(2 * self.tasks, -(-lines // shard_lines)) - 1).bit_length())

    def cut(self, columns: tuple[str, ...]):
        """The parts of a slice by shard, with these of its columns."""
        width = {"hashes": 16, "first": 8, "last": 8, "count": 4}
        names = ["shard", "owner", "uid", "at", *columns]
        schema = pa.schema([f for f in arrow(_PART) if f.name in names])
        edges = np.arange(1, 1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in b.to_pylist():
                    hi = _u64(r["hashes"])[::2]
                    at = np.r_[0, np.searchsorted(hi, edges), len(hi)].tolist()
                    out = [{"shard": s, "owner": (s * self.tasks) >> self.bits, "uid": r["uid"], "at": x}
                           | {c: r[c][x * width[c]:y * width[c]] for c in columns} for s, (x, y) in enumerate(zip(at[:-1], at[1:])) if x < y]
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

        return run, ", ".join(f for f in _PART.split(", ") if f.split()[0] in names)


def line_index(found: DataFrame, layout: Layout) -> DataFrame:
    """The index of what ``slices`` gave: per shard the minimal perfect hash and its arrays."""
    schema = arrow(_INDEX)

    def shard(group: pa.Table) -> pa.RecordBatch:
        whole = {c: b"".join(group.column(c).to_pylist()) for c in ("hashes", "first", "last", "count")}
        h = _u64(whole["hashes"]).reshape(-1, 2)
        order = np.lexsort((h[:, 1], h[:, 0]))
        h = h[order]
        starts = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]).any(axis=1)])
        first = np.minimum.reduceat(_i64(whole["first"])[order], starts)
        last = np.maximum.reduceat(_i64(whole["last"])[order], starts)
        count = np.add.reduceat(_i32(whole["count"])[order].astype(np.int64), starts)
        again = first != last  # repeated rows with one id are one document
        hi, lo, first, count = h[starts, 0][again], h[starts, 1][again], first[again], count[again]
        if not len(hi):
            return pa.RecordBatch.from_pylist([], schema=schema)
        sizes, words = build(hi, lo)
        number = MinimalHash(sizes, words).numbers(hi, lo)
        arrays = []
        for values in (lo, count, first):
            laid = np.empty_like(values)
            laid[number] = values
            arrays.append(laid.tobytes())
        return pa.RecordBatch.from_pylist([{
            "shard": group.column("shard")[0].as_py(), "owner": group.column("owner")[0].as_py(), "n": len(hi), "sizes": sizes.tobytes(),
            "words": words.tobytes(), "fingerprint": arrays[0], "count": arrays[1], "first": arrays[2]}], schema=schema)

    cut, columns = layout.cut(("hashes", "first", "last", "count"))
    parts = found.select("uid", "hashes", "first", "last", "count").mapInArrow(cut, columns)
    dealt = parts.repartitionById(layout.tasks, "owner").sortWithinPartitions("shard")
    return dealt.mapInArrow(lambda batches: (shard(g) for g in sorted_groups(batches, ["shard"])), _INDEX)


def probe(found: DataFrame, index: DataFrame, layout: Layout, documents: int = 2) -> DataFrame:
    """(uid, at, first): positions in a slice of the hashes that at least
    ``documents`` documents have, and the smallest id that has each."""
    schema = arrow(_REPLY)
    arrays = ("sizes", "words", "fingerprint", "count", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = table = None
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["uid"] is None:
                    shard, table = r["shard"], MinimalHash(_i64(r["sizes"]), _u64(r["words"]))
                    fingerprint, count, first = _u64(r["fingerprint"]), _i64(r["count"]), _i64(r["first"])
                elif r["shard"] == shard:
                    h = _u64(r["hashes"]).reshape(-1, 2)
                    number = table.numbers(h[:, 0], h[:, 1])
                    hit = np.flatnonzero(number >= 0)
                    hit = hit[(fingerprint[number[hit]] == h[hit, 1]) & (count[number[hit]] >= documents)]
                    if len(hit):
                        out.append({"uid": r["uid"], "at": (hit + r["at"]).astype(np.int32).tobytes(), "first": first[number[hit]].tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    cut, columns = layout.cut(("hashes",))
    asked = found.select("uid", "hashes").mapInArrow(cut, columns)
    both = index.select("shard", "owner", *arrays).unionByName(asked, allowMissingColumns=True)
    dealt = both.repartitionById(layout.tasks, "owner").sortWithinPartitions("shard", F.asc_nulls_first("uid"))
    return dealt.select("shard", "uid", "at", "hashes", *arrays).mapInArrow(run, _REPLY)


def verdicts(found: DataFrame, replies: DataFrame) -> DataFrame:
    """(row_id, row_salt, dropped): the hashes, 16 bytes each, that a document of
    a slice loses because a smaller id has them."""
    schema = arrow(_VERDICT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                h, starts, docs = _u64(r["hashes"]).reshape(-1, 2), _i32(r["starts"]), _i32(r["docs"])
                ids, salts = _i64(r["ids"]), _i64(r["salts"])
                first = np.full(len(h), NO_ID, dtype=np.int64)
                for reply in r["replies"]:
                    first[_i32(reply["at"])] = _i64(reply["first"])
                line = np.repeat(np.arange(len(h)), np.diff(starts))
                gone = np.flatnonzero(ids[docs] > first[line])
                gone = gone[np.argsort(docs[gone], kind="stable")]
                if not len(gone):
                    continue
                packed = h[line[gone]].astype(">u8").tobytes()
                cuts = np.r_[0, np.flatnonzero(np.diff(docs[gone])) + 1, len(gone)].tolist()
                doc = docs[gone[cuts[:-1]]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[doc]), pa.array(salts[doc]), pa.array([packed[16 * a:16 * z] for a, z in zip(cuts[:-1], cuts[1:])], pa.binary())],
                    schema=schema)

    replies = replies.groupBy("uid").agg(F.collect_list(F.struct("at", "first")).alias("replies"))
    return found.select("uid", "hashes", "starts", "docs", "ids", "salts").join(replies, "uid").mapInArrow(run, _VERDICT)


def keep_lines(text: bytes, dropped: set[bytes], chars: int) -> tuple[int, list[bytes]]:
    """The number of lines, and those that stay."""
    lines = text.split(b"\n")
    if not dropped:
        return len(lines), lines
    return len(lines), [x for x, k in zip(lines, line_keys(text, chars)) if k is None or digest(k) not in dropped]


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars: int = 10,
               slice_lines: int = SLICE, shard_lines: int = SHARD) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_dropped, kept (the text without
    the lines that a smaller id has, joined by \\n).

    Lines end at \\n. Two are equal when they are so without space and U+0009 to
    U+000D at both ends and with A-Z lower-cased; those of fewer than ``chars`` code
    points then always stay. A null or empty text is one empty line. Rows with one
    id are one document: they lose nothing to each other. Rows without an id come
    after all ids, and lose nothing to each other either. An empty table gives no
    rows. Other columns are ignored.
    """
    schema = arrow(_KEPT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, text, lost in zip(b.column("doc_id").to_pylist(), texts_of(b.column("text")), b.column("lost").to_pylist()):
                dropped = {x[a:a + 16] for x in lost or () for a in range(0, len(x), 16)}
                n, kept = keep_lines(text, dropped, chars)
                out.append((i, n, n - len(kept), b"\n".join(kept)))
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary()).cast(pa.string())], schema=schema)

    docs = only(df, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    docs = docs.withColumn("row_id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn(
        "row_salt", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0)).cast("long"))
    found = shared_table(slices(docs.select("row_id", "row_salt", "text"), chars, slice_lines), "line_slices")
    lines = found.agg(F.sum("n")).first()[0] or 0
    layout = Layout(lines, shuffle_partitions(df.sparkSession), shard_lines)
    index = shared_table(line_index(found, layout), "line_index")
    lost = verdicts(found, probe(found, index, layout))
    lost = lost.groupBy("row_id", "row_salt").agg(F.collect_list("dropped").alias("lost"))
    return docs.join(lost, ["row_id", "row_salt"], "left").select("doc_id", "text", "lost").mapInArrow(run, _KEPT)
