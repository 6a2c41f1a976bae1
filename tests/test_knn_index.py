"""The leaf index of the neighbour search, and groups as the pruned join takes them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.operators import knn


def brute(x, q, k, p):
    d = knn._significant(np.concatenate([knn._minkowski(q[a:a + 8], x, p) for a in range(0, len(q), 8)]))
    c = np.stack([np.lexsort((np.arange(len(x)), row))[:k] for row in d])
    return c, np.take_along_axis(d, c, axis=1)


@pytest.mark.parametrize("p", [1, 2, 3])
@pytest.mark.parametrize("n,dim,kind", [(7, 2, "ties"), (4000, 2, "ties"), (4000, 3, "copies"), (18000, 24, "none"), (18000, 24, "far")])
def test_index_equals_brute_force(n, dim, kind, p):
    rng = np.random.default_rng(n + dim)
    if kind in ("none", "far"):
        x, q = (rng.normal(size=(m, dim)) + (1e4 if kind == "far" else 0) for m in (n, 20))
    else:
        x, q = (rng.integers(0, 9, (m, dim)).astype(float) for m in (n, 120))
        q[:80] = q[0]
        if kind == "copies":
            x[:3000] = x[0]
            q[80:90] = x[0]
    r, c, d = knn._Index(x).search(q, 9, p)
    k = min(9, n)
    want_c, want_d = brute(x, q, k, p)
    assert (r == np.repeat(np.arange(len(q)), k)).all()
    assert (c.reshape(-1, k) == want_c).all() and (d.reshape(-1, k) == want_d).all()


def test_index_meets_few_training_rows(monkeypatch):
    rng = np.random.default_rng(5)
    x = np.repeat(rng.uniform(0, 100, (20000, 3)), 2, axis=0)
    seen = []
    whole = knn._topk_chunk
    monkeypatch.setattr(knn, "_topk_chunk", lambda q, x, *a: seen.append(len(q) * len(x)) or whole(q, x, *a))
    knn._Index(x).search(x[::4], 5, 2)  # as many rows as an Arrow batch
    assert sum(seen) < 0.1 * len(x[::4]) * len(x)  # all pairs before


@pytest.mark.parametrize("block", [8, 4096])
def test_groups_with_their_own_columns_and_copies(spark, block):
    rng = np.random.default_rng(6)
    rows, tests = [], []
    for g, dim in ((0, 2), (1, 3), (7, 5)):
        x, q = np.round(rng.normal(size=(90, dim)), 1), np.round(rng.normal(size=(20, dim)), 1)
        x[:40] = x[0]
        rows += [(g, i, v.tolist(), i % 3) for i, v in enumerate(x)]
        tests += [(g, i, v.tolist()) for i, v in enumerate(q)]
    tr = spark.createDataFrame(rows, "g int, id long, x array<double>, y int")
    te = spark.createDataFrame(tests + [(9, 0, [1.0])], "g int, qid long, x array<double>")
    nb = knn.neighbors(tr, te, "id", "x", "y", 4, 2, block, test_key="qid", group="g")
    assert "Generate" not in nb._jdf.queryExecution().toString()  # every row went to all blocks of the other side before
    got = {(r["g"], r["qid"], r["nn_rank"]): (r["nn_key"], r["dist"], r["nn_label"]) for r in nb.collect()}
    want = {}
    for g in (0, 1, 7):
        x, q = (np.array([r[2] for r in z if r[0] == g]) for z in (rows, tests))
        for i, (c, d) in enumerate(zip(*brute(x, q, 4, 2))):
            want |= {(g, i, j + 1): (int(c[j]), float(d[j]), int(c[j]) % 3) for j in range(4)}
    assert got == want


def test_no_vector_is_passed_over(spark):
    tr = spark.createDataFrame([(i, [float(i)]) for i in range(5)] + [(9, [None])], "id long, x array<double>")
    with pytest.raises(Exception, match="nulls"):
        knn.neighbors(tr, tr.where(F.col("id") < 5), "id", "x", None, 2).collect()
