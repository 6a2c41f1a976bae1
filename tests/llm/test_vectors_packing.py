"""Embedding dedup and packing."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabml.llm import embedding_dedup, packing
from tests.llm.conftest import union_find


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))


def vector_rows():
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((6, 24))
    rows = [(i, (centre[i % 6] + rng.standard_normal(24) * (0.03 if i % 2 else 0.12)).tolist(), i % 3) for i in range(220)]
    rows += [(300 + i, rows[5][1], 5 % 3) for i in range(4)] + [(310, [2 * x for x in rows[5][1]], 5 % 3), rows[7]]
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 24, 1), (403, [float("nan")] + [1.0] * 23, 1), (404, [None] + [1.0] * 23, 1),
             (405, [float("inf")] * 24, 1), (406, rows[5][1], None), (407, [1.0, 0.0], 1), (408, [1.0, 0.05], 1), (409, [-1.0, 0.0], 1), (410, [3.0], 1), (411, [7.0], 1)]
    return rows


@pytest.mark.parametrize("blocks,grid,chunk", [(4, 3, 4096), (1, 1, 4096), (6, 2, 16), (24, 1, 7)])
def test_embedding_dedup(spark, blocks, grid, chunk):
    rows = vector_rows()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, kept string").repartition(4)
    got = embedding_dedup.embedding_dedup(df, blocks=blocks, grid=grid, chunk=chunk).collect()
    fine = [r for r in rows if r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    pairs = [(i, j) for i in range(len(fine)) for j in range(i) if fine[i][2] == fine[j][2] and len(fine[i][1]) == len(fine[j][1])
             and cosine(fine[i][1], fine[j][1]) >= 0.98]
    links = Counter(fine[k][0] for p in pairs for k in p)
    copies = Counter(r[0] for r in rows)
    comp = union_find([(fine[i][0], fine[j][0]) for i, j in pairs], copies)
    assert Counter(r.vec_id for r in got) == copies
    for r in got:
        assert (r.n_links, r.component_id, r.kept) == (links[r.vec_id] // copies[r.vec_id], comp[r.vec_id], comp[r.vec_id] == r.vec_id)


def test_embedding_dedup_null_ids_and_empty(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (9, [1.0, 0.01], 1), (None, [0.0, 1.0], 1), (None, None, 1)],
                               "vec_id long, embedding array<float>, label int")
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.embedding_dedup(df).collect())
    assert got == Counter({(None, 2, 9, False): 2, (9, 2, 9, True): 1, (None, 0, None, False): 2})
    assert embedding_dedup.embedding_dedup(df.limit(0)).count() == 0


JSON, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))


@pytest.mark.parametrize("window", [1024, 64])
def test_packing_round_trip(docs, rows, window):
    tok = Tokenizer.from_file(JSON)
    got = packing.pack(docs, JSON, RANKS, window).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for s in sequences.values():
        s.sort()
        at = 0
        for offset, n in s:
            assert offset == at and n > 0
            at += n
        assert at <= window and at & (at - 1) == 0
    copies = Counter(r[0] for r in rows)
    for i, t, *_ in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4").tobytes()
        spans = Counter()
        for p in pieces[i]:
            assert p.doc_tokens == len(ids) // 4 and p.ids == ids[4 * p.start:4 * (p.start + p.length)]
            spans.update(range(p.start, p.start + p.length))
        assert set(spans.values()) == {copies[i]} and len(spans) == len(ids) // 4


def test_packing_null_ids_empty_and_bad_window(with_null_ids, empty):
    assert packing.pack(with_null_ids, JSON, RANKS).where("doc_id is null").count() > 0
    assert packing.pack(empty, JSON, RANKS).count() == 0
    with pytest.raises(ValueError):
        packing.pack(empty, JSON, RANKS, 1000)


def test_placing_minimises_the_sum_of_squares():
    rng = np.random.default_rng(4)
    closed = []
    packer = packing.Packer(16, closed.append)
    for k in rng.integers(1, 16, 400).tolist():
        before = packer.levels.copy()
        costs = {}
        for level in [0, *np.flatnonzero(before[1:16]) + 1]:
            if level + k <= 16:
                after = before.copy()
                after[level] -= level > 0
                after[level + k] += level + k < 16
                costs[level] = int((after[1:16] ** 2).sum())
        packer.place(("d", k), 0, np.zeros(k, dtype=np.uint32))
        assert int((packer.levels[1:16] ** 2).sum()) == min(costs.values())
    packer.finish()
    fills = [sum(len(p[2]) for p in s) for s in closed]
    assert all(f & (f - 1) == 0 for f in fills)


def test_crc_is_of_the_ids(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "hello world")], "doc_id long, text string")
    rows = packing.pack(df, JSON, RANKS, 4).withColumn("c", F.crc32("ids")).collect()
    assert all(r.c == zlib.crc32(bytes(r.ids)) for r in rows)
