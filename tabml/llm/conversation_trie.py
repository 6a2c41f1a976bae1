"""The trie of conversation prefixes by truncation peeling.

A conversation is a path of entries, one per turn (the turn's digest and the
bytes of its text); a node is a path's first d entries. Peeling descends from the
deepest level: at each level newly ended conversations join the nodes that
survived from below, equal prefixes are regrouped and aggregated, the nodes are
written out, and their last turn is stripped.

1. ``sequences``: turns become paths, one shuffle of digests, not of texts.
2. ``peel``: paths are range-partitioned and sorted, so that the members of a
   node are neighbours, however many there are, and chunks of neighbours are peeled
   each in one pass. A node is whole within its chunk unless it lies on the chunk's
   first or last path; what the chunk knows of those is a comb: the path with
   partial aggregates at each depth.
3. Combs are peeled in the same way, round after round, until one chunk is left.
   Each chunk leaves at most two combs of hundreds, so rounds are few, and depth
   costs no rounds.
4. Nodes whose parent was still open meet it by a key of its path.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import arrow, only, shared_table, shuffle_partitions

#: bytes of an entry: 16 of the turn's digest, 8 of its text's length
ENTRY = 24
#: a chunk ends at so many bytes of paths, with at least so many paths
CHUNK, CHUNK_PATHS = 8 << 20, 64
#: combs that one task peels last, and bytes of paths that a task gets, about
LAST, _TASK = 1024, 32 << 20
#: open nodes that are broadcast to their children's rows at most; above, the rows are joined
_BROADCAST = 200_000
_NONE = np.iinfo(np.int64).max
_NOTHING = hashlib.sha256(b"").hexdigest()
#: what a peeled chunk gives: nodes, combs and pieces of id lists, told apart by ``kind``
NODE, COMB, PIECE = 0, 1, 2
_OUT = ("kind int, conv_id long, depth long, parent_conv_id long, parent_key binary, key binary, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string, path binary, marks binary, ids string")
_RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def sequences(df: DataFrame, share: tuple[int, int] | None = None) -> DataFrame:
    """(conv_id, path) of (conv_id, turn, role, text): entries in the order of turns.

    With ``share`` = (g, m) a conversation c is rebuilt: the first h turns of
    conversation c - c % g (% takes the sign of c), then its own after its first h,
    where h is the CRC-32 of decimal c modulo m.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    entry = F.unhex(F.concat(digest, F.lpad(F.hex(F.octet_length(text)), 16, "0")))
    group, most = share or (1, 1)
    turns = df.where("conv_id is not null").select("conv_id", "turn", entry.alias("entry"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    sort = ("base", F.col("conv_id") != F.col("base"), "conv_id", F.asc_nulls_first("turn"), "entry")
    names = ["conv_id", "path"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = conv = None
        head, own, ids, paths = [], [], [], []
        size = 0

        def close():
            nonlocal head, own, size
            if conv is not None:
                if conv == base:
                    head = own[:most]
                h = zlib.crc32(b"%d" % conv) % most
                ids.append(conv)
                paths.append(b"".join(head[:h] + own[h:]))
                size += len(paths[-1])
                own = []

        for b in batches:
            for c, g, e in zip(b.column("conv_id").to_pylist(), b.column("base").to_pylist(), b.column("entry").to_pylist()):
                if c != conv:
                    close()
                    if g != base:
                        base, head = g, []
                    conv = c
                own.append(e)
            if size > CHUNK:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(paths, pa.binary())], names)
                ids, paths, size = [], [], 0
        close()
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(paths, pa.binary())], names)

    turns = turns.repartition("base").sortWithinPartitions(*sort)
    return turns.select("conv_id", "base", "entry").mapInArrow(run, "conv_id long, path binary")


def common(a: bytes, b: bytes) -> int:
    """The number of entries that two paths begin with alike."""
    same, differ = 0, min(len(a), len(b)) // ENTRY + 1
    while differ - same > 1:
        middle = (same + differ) // 2
        same, differ = (middle, differ) if a[:middle * ENTRY] == b[:middle * ENTRY] else (same, middle)
    return same


def chain(path: bytes) -> list[bytes]:
    """The key of each prefix of a path, the empty one included."""
    keys = [b"\0" * 16]
    for a in range(0, len(path), ENTRY):
        keys.append(xxhash.xxh3_128_digest(keys[-1] + path[a:a + ENTRY]))
    return keys


class Peeled:
    """Columns of ``_OUT`` as they come out of a chunk."""

    def __init__(self) -> None:
        self.rows: list[dict] = []

    def nodes(self, at: dict) -> None:
        self.rows += [dict(zip(at, r), kind=NODE) for r in zip(*at.values())]


def peel_chunk(paths: list[bytes], ids: list[int], marks: list[np.ndarray | None], last: bool, keyed: bool) -> list[dict]:
    """Rows of ``_OUT`` for neighbours in the order of (path, id).

    Without marks an item is a conversation that ends with its path; a comb's
    marks are five rows of longs by depth: members, smallest member, children,
    leaves and saved tokens that whole nodes gave the node there. ``last``: no
    other chunk exists, so no node stays open. ``keyed``: nodes carry their key.
    """
    m, out = len(paths), Peeled()
    length = np.array([len(p) // ENTRY for p in paths])
    lcp = np.array([-1, *(common(a, b) for a, b in zip(paths[:-1], paths[1:]))])
    words, offset = np.frombuffer(b"".join(paths), dtype=">u8"), 3 * (np.cumsum(length) - length)
    ids = np.array([_NONE if i is None else i for i in ids], dtype=np.int64)
    combs = np.array([x is not None for x in marks])
    by_length = np.argsort(-length, kind="stable")
    deepest = int(length.max())
    alive_at = np.searchsorted(-length[by_length], -np.arange(deepest + 1), side="right")
    edge = {} if last else {0: chain(paths[0]), m - 1: chain(paths[-1])}
    keys = {k: chain(p) for k, p in enumerate(paths)} if keyed else {}
    open_marks = {k: np.zeros((5, length[k] + 1), dtype=np.int64) for k in edge}
    for x in open_marks.values():
        x[1] = _NONE
    below = None
    for depth in range(deepest, -1, -1):
        alive = np.sort(by_length[:alive_at[depth]])
        label = np.cumsum(lcp[alive] < depth) - 1  # also behind an item that isn't as deep
        k = int(label[-1]) + 1
        n, least, children, leaves, saved = (np.full(k, _NONE if c == 1 else 0, dtype=np.int64) for c in range(5))
        if below is not None:  # what survived, without its last turn
            at = label[np.searchsorted(alive, below["position"])]
            np.add.at(n, at, below["n_convs"])
            np.minimum.at(least, at, below["conv_id"])
            children += np.bincount(at, minlength=k)
            np.add.at(leaves, at, below["n_leaves"])
            np.add.at(saved, at, below["saved_tokens"])
        ending = ~combs[alive] & (length[alive] == depth)  # what newly ends here
        ended, ended_at = alive[ending], label[ending]
        n += np.bincount(ended_at, minlength=k)
        np.minimum.at(least, ended_at, ids[ended])
        for i, at_ in zip(alive[combs[alive]].tolist(), label[combs[alive]].tolist()):
            part = marks[i][:, depth]
            n[at_] += part[0]
            least[at_] = min(least[at_], part[1])
            children[at_] += part[2]
            leaves[at_] += part[3]
            saved[at_] += part[4]
        opened = {}
        for item in edge:
            if length[item] >= depth:
                opened[int(label[np.searchsorted(alive, item)])] = item  # the last path has what both share
        whole = np.ones(k, dtype=bool)
        whole[list(opened)] = False
        for at_, item in opened.items():
            open_marks[item][:, depth] = n[at_], least[at_], children[at_], leaves[at_], saved[at_]
        if below is not None and len(below["position"]):
            parent = [int(least[x]) if whole[x] else None for x in at.tolist()]
            parent_key = [None if whole[x] else edge[opened[x]][depth] for x in at.tolist()]
            out.nodes(below["rows"] | {"parent_conv_id": parent, "parent_key": parent_key})
        leaves[whole & (children == 0)] = 1
        position = alive[np.flatnonzero(np.r_[True, label[1:] != label[:-1]])]
        if depth:
            saved[whole] += (n[whole] - 1) * words[offset[position[whole]] + 3 * depth - 1].astype(np.int64)
        ends = dict.fromkeys(range(k), _NOTHING)
        cuts = np.flatnonzero(np.r_[True, ended_at[1:] != ended_at[:-1]]).tolist() if len(ended) else []
        for a, z in zip(cuts, [*cuts[1:], len(ended)]):
            at_, listed = int(ended_at[a]), ",".join(map(str, ids[ended[a:z]].tolist()))
            if whole[at_]:
                ends[at_] = hashlib.sha256(listed.encode()).hexdigest()
            else:
                out.rows.append({"kind": PIECE, "key": edge[opened[at_]][depth], "conv_id": int(ids[ended[a]]), "ids": listed})
        some = np.flatnonzero(whole)
        below = {"position": position[some], "n_convs": n[some], "conv_id": least[some], "n_leaves": leaves[some], "saved_tokens": saved[some]}
        below["rows"] = {c: below[c].tolist() for c in ("conv_id", "n_convs", "n_leaves", "saved_tokens")} | {
            "depth": [depth] * len(some), "n_children": children[some].tolist(),
            # the ends of a keyed node come from its pieces
            "ends_sha256": [None if keyed else ends[x] for x in some.tolist()],
            "key": [keys[p][depth] if keyed else None for p in position[some].tolist()]}
    out.nodes(below["rows"] | {"parent_conv_id": [None] * len(some), "parent_key": [None] * len(some)})
    for item in ([] if last else [m - 1] if paths[-1].startswith(paths[0]) else [0, m - 1]):
        out.rows.append({"kind": COMB, "path": paths[item], "marks": open_marks[item].tobytes()})
    return out.rows


def peel(items: DataFrame, last: bool, keyed: bool, chunk: int = CHUNK, chunk_paths: int = CHUNK_PATHS) -> DataFrame:
    """Sorted items (path, conv_id, marks) peeled chunk by chunk within their partition."""
    schema = arrow(_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, ids, marks, size = [], [], [], 0

        def close():
            rows = peel_chunk(paths, ids, marks, last, keyed)
            for a in range(0, len(rows), 1 << 16):
                yield pa.RecordBatch.from_pylist(rows[a:a + (1 << 16)], schema=schema)

        for b in batches:
            for p, i, x in zip(b.column("path").to_pylist(), b.column("conv_id").to_pylist(), b.column("marks").to_pylist()):
                paths.append(p)
                ids.append(i)
                marks.append(None if x is None else np.frombuffer(x, dtype=np.int64).reshape(5, -1))
                size += len(p) + len(x or b"") + 64
                if size > chunk and len(paths) >= chunk_paths and not last:
                    yield from close()
                    paths, ids, marks, size = [], [], [], 0
        if paths:
            yield from close()

    return items.mapInArrow(run, _OUT)


def _listed(pieces: DataFrame) -> DataFrame:
    """(key, ends): the checksum of each key's ids, whose pieces follow each other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = sha = None
        for b in batches:
            done = []
            for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist()):
                if k != key:
                    if sha:
                        done.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([x for _, x in done], pa.string())], ["key", "ends"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()], pa.string())], ["key", "ends"])

    return pieces.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ids").mapInArrow(run, "key binary, ends string")


def trie(paths: DataFrame, chunk: int = CHUNK, chunk_paths: int = CHUNK_PATHS, last: int = LAST) -> DataFrame:
    """The nodes of a written table of (conv_id, path), ids distinct."""
    spark = paths.sparkSession
    size = paths.agg(F.sum(F.octet_length("path") + 64)).first()[0] or 0
    tasks = max(shuffle_partitions(spark), -(-size // _TASK))
    items = paths.select("path", "conv_id", F.lit(None).cast("binary").alias("marks"))
    items = items.repartitionByRange(tasks, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    first = shared_table(peel(items, False, False, chunk, chunk_paths), "peeled")
    rounds, n = [], first.where(F.col("kind") == COMB).count()
    combs = first
    while n:
        items = combs.where(F.col("kind") == COMB).select("path", "conv_id", "marks")
        final = n <= last
        items = items.repartition(1) if final else items.repartitionByRange(-(-n // last), "path")
        rounds.append(shared_table(peel(items.sortWithinPartitions("path"), final, True, chunk, max(4, chunk_paths)), "peeled"))
        combs, n = rounds[-1], 0 if final else rounds[-1].where(F.col("kind") == COMB).count()
    whole = first.where(F.col("kind") == NODE)
    if not rounds:
        return whole.select(*_RESULT)
    late = reduce(DataFrame.unionAll, rounds).where(F.col("kind") == NODE)
    ends = _listed(first.where(F.col("kind") == PIECE))
    found = late.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(_NOTHING)))
    nodes = whole.select(*_RESULT, "parent_key").unionAll(found.select(*_RESULT, "parent_key"))
    up = late.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("up"))
    if late.count() <= _BROADCAST:
        up = F.broadcast(up)
    met = nodes.where("parent_key is not null").join(up, "parent_key").withColumn("parent_conv_id", F.col("up"))
    return nodes.where("parent_key is null").select(*_RESULT).unionAll(met.select(*_RESULT))


def conversation_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                      share: tuple[int, int] | None = None) -> DataFrame:
    """One row per node, a distinct sequence of first turns (role, text): conv_id
    (its smallest member), depth, parent_conv_id (the parent's conv_id, null for the
    root), n_convs (conversations that begin so), n_children, n_leaves (childless nodes
    in its subtree), saved_tokens (over its subtree, members but one times the UTF-8
    bytes of the last text), ends_sha256 (of the ascending decimal ids of the
    conversations that end there, comma-joined).

    Turns are ordered with null first; of equal turn numbers the order is that of
    the turns' digests, and repeated rows are repeated turns. A null role or text
    counts as empty. Rows without a conversation id belong to no conversation. No
    conversations give no rows. ``share`` as in ``sequences``. Other columns are ignored.
    """
    rows = only(df, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col).withColumn("conv_id", F.col("conv_id").cast("long"))
    return trie(shared_table(sequences(rows, share), "paths"))
