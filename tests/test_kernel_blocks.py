"""The kernel of a batch is made in blocks of bounded size, whatever the batch."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa

from tabml.functions import sums
from tabml.operators import svm


def test_blocks_cover_the_rows():
    assert [(s.start, s.stop) for s in sums.blocks(2500, 1000)] == [(0, 1048), (1048, 2096), (2096, 2500)]
    assert list(sums.blocks(0, 5)) == []


class Frame:
    """Stands for the rows: keeps the task's function."""

    def mapInArrow(self, run, schema):
        self.run = run
        raise StopIteration

    def withColumn(self, name, col):
        raise AssertionError


def test_a_batch_of_many_rows_and_landmarks_takes_little_memory(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(10_000, 8))
    m = svm.Nystroem(n_landmarks=500)
    m.gamma_, m.landmarks_, m.norm_ = 0.1, x[:500], np.eye(500)
    frame = Frame()
    try:
        m._residuals(frame, 8, 32)
    except StopIteration:
        pass
    h = [f"{i:08d}" for i in range(len(x))]
    batch = pa.RecordBatch.from_arrays([pa.array(h), pa.array(x.tolist(), pa.list_(pa.float64()))], ["h", "x"])
    tracemalloc.start()
    out = list(frame.run(iter([batch])))[0].to_pandas()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # the kernel of the batch alone has 40 MB, and is copied several times
    left = 1 - ((svm._kernel(x, m.landmarks_, "rbf", 0.1, 3, 0.0)) ** 2).sum(axis=1)
    assert np.isclose(out["rest"][0], np.maximum(left, 0).sum())
    assert out["h"][1:].tolist() == [h[i] for i in np.argsort(-left, kind="stable")[:64]]


def test_mapped_rows_come_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 3))
    m = svm.Nystroem()
    m.gamma_, m.landmarks_ = 0.3, x[:900]
    m.norm_ = np.eye(900)[:, :40]
    df = spark.createDataFrame([(i, [float(v) for v in a]) for i, a in enumerate(x)], "id long, features array<double>").coalesce(1)
    got = pd.DataFrame(m.transform(df, out_col="z").collect(), columns=["id", "features", "z"]).sort_values("id")
    want = svm._kernel(x, m.landmarks_, "rbf", 0.3, 3, 0.0) @ m.norm_
    assert np.allclose(np.array(got["z"].tolist()), want, atol=1e-12)
