"""The pipeline and its stages on awkward inputs."""

from collections import Counter

import pytest

import corpus_pipeline
from tabml.llm import exact_dedup, mixing, simhash, toxicity

CLASHING = ("_kept_id", "_kept_hash", "_row_hash", "_n", "_stay", "_rate", "_source", "_target", "row", "id", "hash", "copy", "draw", "row_hash",
            "component", "fp", "label", "score", "held_out", "size", "a.b", "draw text")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def with_clashes(spark, rows):
    fields = DOCUMENTS + ", " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *CLASHING) for r in rows], fields).repartition(3)


def words(seed, n=60):
    return " ".join(f"w{(seed * 7919 + k * k * 31) % 9973}" for k in range(n))


ROWS = [(1, words(1), "en", "a", 1), (2, words(1) + " ", "en", "b", 2), (3, words(2), "en", None, 3), (None, words(3), None, "a", None), (None, words(3), None, "a", None),
        (5, words(5), "en", "a", 5), (5, words(6), "en", "a", 5), (6, None, "en", "a", 6), (7, "", "en", "b", 7), (8, words(2), "en", "b", 8), (8, words(2), "en", "b", 8)]


def kept(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_stages_keep_any_columns(spark):
    df = with_clashes(spark, ROWS)
    for out in (exact_dedup.drop_copies(df), simhash.drop_near_copies(df, words=3, distance=3), mixing.mix(df),
                toxicity.drop_toxic(df, toxicity.fit(df.select("doc_id", "text"), spark.createDataFrame([], "doc_id long, label int")))):
        assert out.schema.names == df.schema.names
        assert all(r[c] == c for r in out.collect() for c in CLASHING)


def test_copies_and_ids_with_unlike_texts(spark):
    df = with_clashes(spark, ROWS)
    assert kept(exact_dedup.drop_copies(df)) == Counter([(2, words(1) + " "), (3, words(2)), (None, words(3)), (5, words(5)), (5, words(6)), (6, None)])
    near = kept(simhash.drop_near_copies(df, words=3, distance=3))
    # rows without an id stay; both texts of id 5 stay, each alone in its component
    assert near == Counter({(1, words(1)): 1, (3, words(2)): 1, (None, words(3)): 2, (5, words(5)): 1, (5, words(6)): 1, (6, None): 1})


def test_unlike_labels_of_one_id_have_a_rule(spark):
    docs = spark.createDataFrame([(i, words(i)) for i in range(1, 60)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(1, 60)] + [(i, 1 - i % 2) for i in range(1, 60, 3)]
    df = spark.createDataFrame(labels, "doc_id long, label int")
    got = [{(r.text, r.label) for r in toxicity.labelled_sample(docs, df.repartition(n), 30).collect()} for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 30
    assert all(label == 1 for text, label in got[0] if text in {words(i) for i in range(1, 60, 3)})


@pytest.fixture
def folder(spark, tmp_path):
    def write(rows, labels):
        out = str(tmp_path / f"sf{len(list(tmp_path.iterdir()))}")
        spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{out}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
        return out
    return write


def test_pipeline_on_awkward_documents(spark, folder):
    got = corpus_pipeline.run(spark, folder(ROWS, [(1, 1, 0), (None, 1, 1), (3, None, None)])).collect()
    assert {r.doc_id for r in got} <= {2, 3, 5, 6, None}
    assert {3, 5, 6} & {r.doc_id for r in got}
    assert all(r.length >= 1 and r.offset >= 0 for r in got)


def test_pipeline_on_no_documents(spark, folder):
    assert corpus_pipeline.run(spark, folder([], [])).count() == 0
    assert corpus_pipeline.run(spark, folder([], [(1, 1, 1), (2, 1, 0)])).count() == 0
