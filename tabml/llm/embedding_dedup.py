"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors with cosine >= t lie within a squared distance of 2 - 2t. They are
rotated (seeded, orthonormal) and split into blocks; a block of k of d dimensions
gets k/d of that budget, and the sum over blocks can only stay within the whole if
some block stays within its own. Each block is range-joined: its first coordinates make a
grid with cells of twice the budget's radius, a vector is at home in one cell
and probes those neighbours that its radius reaches, in one direction only.
Inside a cell block distances select candidates, whose cosines are then
computed exactly from the vectors as given.

A pair that several blocks find counts in the first. Cells don't hand out
pairs: a vector leaves with the number of its links and the root of its local
component. Equal vectors are one node with a multiplicity. Cells of very many
vectors are cut into chunks, and each pair of chunks is a task of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import shared_table, shuffle_partitions, sorted_groups
from tabml.llm.components import components, local_roots, local_star

#: vectors of a cell that one task holds
CHUNK = 4096
#: vectors compared at once
_TILE = 1024
_SLACK = 1e-9


def rotation(d: int, seed: int) -> np.ndarray:
    """A random orthonormal matrix, the same wherever it is made."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def split(d: int, blocks: int) -> list[slice]:
    """The dimensions of each block, as even as they can be."""
    edges = np.linspace(0, d, min(blocks, d) + 1).astype(int).tolist()
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]


def budgets(parts: list[slice], d: int, threshold: float) -> np.ndarray:
    return np.array([(2 - 2 * threshold) * (p.stop - p.start) / d for p in parts]) * (1 + _SLACK) + 1e-12


class Space:
    """Rotated unit vectors of one dimension, and their blocks."""

    def __init__(self, d: int, blocks: int, threshold: float, seed: int) -> None:
        self.turn, self.parts = rotation(d, seed), split(d, blocks)
        self.budgets = budgets(self.parts, d, threshold)

    def place(self, x: np.ndarray) -> np.ndarray:
        return (x / np.linalg.norm(x, axis=1, keepdims=True)) @ self.turn


def _decode(column) -> list[np.ndarray]:
    return [np.frombuffer(v, dtype=np.float64) for v in column.to_pylist()]


def cells(rows: np.ndarray, part: slice, budget: float, grid: int):
    """(row, cell, probe) triples: each row's home, and the cells behind a wall
    that its radius reaches, in the direction where the first step is up."""
    radius = np.sqrt(budget) * (1 + _SLACK)
    x = rows[:, part][:, :grid] / (2 * radius)
    home = np.floor(x).astype(np.int64)
    up, down = x - home >= 0.5 - _SLACK, x - home <= 0.5 + _SLACK
    yield np.arange(len(rows)), home, False
    for step in product((-1, 0, 1), repeat=x.shape[1]):
        if next((s for s in step if s), -1) < 0:
            continue
        ok = np.ones(len(rows), dtype=bool)
        for dim, s in enumerate(step):
            if s:
                ok &= up[:, dim] if s > 0 else down[:, dim]
        if ok.any():
            yield np.flatnonzero(ok), home[ok] + np.array(step), True


def _deal(blocks: int, grid: int, threshold: float, seed: int, keys_only: bool):
    """A row for each cell that a vector is at home in or probes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces: dict[int, Space] = {}
        for b in batches:
            vectors = _decode(b.column("vec"))
            sizes = np.array([len(v) for v in vectors])
            label = b.column("label").to_numpy(zero_copy_only=False).astype("<i8")
            node, n = (b.column(c).to_numpy(zero_copy_only=False) for c in ("node", "n"))
            for d in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == d)
                space = spaces.setdefault(d, Space(d, blocks, threshold, seed))
                rows = space.place(np.stack([vectors[i] for i in own]))
                for k, part in enumerate(space.parts):
                    for at, cell, probe in cells(rows, part, space.budgets[k], grid):
                        i = own[at]
                        head = np.column_stack([label[i], np.full(len(i), d), np.full(len(i), k), cell]).astype("<i8")
                        key = pa.array([r.tobytes() for r in head], pa.binary())
                        if keys_only:
                            yield pa.RecordBatch.from_arrays([key], ["key"])
                        else:
                            yield pa.RecordBatch.from_arrays(
                                [key, pa.array(np.full(len(i), probe)), pa.array(node[i]), pa.array(n[i]), b.column("vec").take(pa.array(i))],
                                ["key", "probe", "node", "n", "vec"])

    return run


def _join(blocks: int, threshold: float, seed: int):
    """Links inside each (key, i, j): rows of chunk i against those of chunk j."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces: dict[int, Space] = {}
        for group in sorted_groups(batches, ["key", "i", "j"]):
            if group.num_rows < 2:
                continue
            probe = group.column("probe").to_numpy()
            if probe.all():
                continue
            _, d, block = np.frombuffer(group.column("key")[0].as_py(), dtype="<i8")[:3].tolist()
            space = spaces.setdefault(d, Space(d, blocks, threshold, seed))
            vectors = np.stack(_decode(group.column("vec")))
            node, n, chunk = (group.column(c).to_numpy() for c in ("node", "n", "chunk"))
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            links = np.zeros(len(node), dtype=np.int64)
            pairs = []
            for a, b in _pairs(space, block, vectors, probe, chunk, i != j, threshold):
                np.add.at(links, a, n[b])
                np.add.at(links, b, n[a])
                pairs.append(local_star(a, b))
            if pairs:
                a, b = (np.concatenate(x) for x in zip(*pairs))
                root = local_roots(a, b, node)
                out = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(node[out]), pa.array(links[out]), pa.array(root[out])], ["node", "links", "root"])

    return run


def _pairs(space: Space, block: int, vectors: np.ndarray, probe: np.ndarray, chunk: np.ndarray, across: bool, threshold: float):
    """Verified pairs of rows that this block is the first to find, tile by tile."""
    rows, norms = space.place(vectors), np.linalg.norm(vectors, axis=1)
    own = rows[:, space.parts[block]]
    square = (own * own).sum(axis=1)
    for a0 in range(0, len(own), _TILE):
        for b0 in range(a0, len(own), _TILE):
            a1, b1 = a0 + _TILE, b0 + _TILE
            near = square[a0:a1, None] + square[None, b0:b1] - 2 * own[a0:a1] @ own[b0:b1].T <= space.budgets[block] + 1e-9
            near &= ~(probe[a0:a1, None] & probe[None, b0:b1])
            if across:
                near &= chunk[a0:a1, None] != chunk[None, b0:b1]
            a, b = np.nonzero(near)
            a, b = a + a0, b + b0
            a, b = a[a < b], b[a < b]
            for s in range(0, len(a), 1 << 16):
                x, y = a[s:s + (1 << 16)], b[s:s + (1 << 16)]
                cosine = np.einsum("ij,ij->i", vectors[x], vectors[y]) / (norms[x] * norms[y])
                x, y = x[cosine >= threshold], y[cosine >= threshold]
                apart = (rows[x] - rows[y]) ** 2
                found = np.column_stack([apart[:, p].sum(axis=1) <= limit for p, limit in zip(space.parts[:block + 1], space.budgets)])
                first = found[:, block] & ~found[:, :block].any(axis=1)
                if first.any():
                    yield x[first], y[first]


def vector_links(nodes: DataFrame, threshold: float, blocks: int, grid: int, seed: int, chunk: int = CHUNK) -> DataFrame:
    """(node, links, root): from each cell, the number of vectors that a node
    links to and a node it is connected to. Of distinct (label, vec) with ``n`` copies."""
    spark = nodes.sparkSession
    full = nodes.mapInArrow(_deal(blocks, grid, threshold, seed, False), "key binary, probe boolean, node long, n long, vec binary")
    keys = nodes.mapInArrow(_deal(blocks, grid, threshold, seed, True), "key binary")
    large = shared_table(keys.groupBy("key").count().where(F.col("count") > chunk).select("key", F.ceil(F.col("count") / chunk).cast("int").alias("chunks")), "large_cells")
    rows = full.join(large, "key", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "probe", "node", "n", "vec")
    dealt = rows.repartition(shuffle_partitions(spark), "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(_join(blocks, threshold, seed), "node long, links long, root long")


def embedding_dedup(df: DataFrame, threshold: float = 0.98, blocks: int = 4, grid: int = 3, seed: int = 42, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label", chunk: int = CHUNK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors with equal labels (not null) and equal length link from a cosine of
    ``threshold`` up, in double precision. ``n_links`` counts the other vectors
    linked directly, equal ones too; ``component_id`` is the smallest id reachable, itself
    included; ``kept`` marks it. Vectors that are null, empty or zero, or hold null or
    non-finite components, and rows without a label, link with nothing. An id stands for one
    vector; a repeated row is one more copy. Rows without an id link and count, but never name
    a component, and aren't kept. An empty table gives no rows. Other columns are ignored.
    """
    vec = F.col("vec")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                     F.col(f"`{vector_col}`").cast("array<double>").alias("vec"))
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("usable", usable)
    good = rows.where("usable")
    distinct = good.groupBy("label", "vec").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))
    stand_in = F.lit(1 << 62) + F.pmod(F.xxhash64("label", "vec"), F.lit(1 << 61))
    distinct = shared_table(distinct.select("label", "vec", "n", F.coalesce("id", stand_in).alias("node")), "vectors")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs = [np.asarray(v, dtype=np.float64).tobytes() for v in b.column("vec").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("n"), b.column("label"), pa.array(vecs, pa.binary())],
                                             ["node", "n", "label", "vec"])

    nodes = distinct.mapInArrow(pack, "node long, n long, label long, vec binary")
    nodes = nodes.repartition(shuffle_partitions(df.sparkSession), "node")
    links = shared_table(vector_links(nodes, threshold, blocks, grid, seed, chunk), "links")
    comp = components(links.select(F.col("node").alias("u"), F.col("root").alias("v")))
    comp = comp.select("node", F.col("component").alias("c"))
    total = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = distinct.join(total, "node", "left").join(comp, "node", "left").select(
        "label", "vec", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("c", "node").alias("c"))
    linked = good.join(known, ["label", "vec"]).select("vec_id", "n_links", F.when(F.col("c") < (1 << 62), F.col("c")).alias("component_id"))
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
