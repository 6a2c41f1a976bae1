"""Queries against their SQL, and the pipeline stage by stage."""

import os
import re
from collections import Counter

import pytest

import corpus_pipeline
from tabml.llm import oracles, queries, simhash, toxicity
from tabml.llm.common import read
from tests import oracle_check

SF = "/root/testdata/sf0.001"
SF_STAGES = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracles.ORACLE))
def test_query_equals_its_sql(spark, name):
    got = queries.QUERIES[name](spark, SF)
    con = oracle_check.duck(SF)
    want = con.execute(oracles.ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    mine = oracle_check.rows_of(got.columns, [tuple(r) for r in got.collect()])[0]
    theirs = oracle_check.rows_of(columns, want.fetchall())[0]
    assert Counter(mine) == Counter(theirs)


def test_stages_follow_each_other(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "mixing", "packing"]
    docs = read(spark, SF_STAGES, "documents")
    labels = read(spark, SF_STAGES, "labels").selectExpr("doc_id", "toxic as label")
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    rows = {r.doc_id: r for r in docs.collect()}
    clean = [i for i, r in rows.items() if toxicity.score_text(r.text, model) < 0.5]
    assert 0 < len(clean) < len(rows)

    stage = {n: f for n, f in corpus_pipeline.STAGES}
    one = stage["toxicity"](spark, docs, SF_STAGES).persist()
    assert sorted(r.doc_id for r in one.collect()) == sorted(clean) and one.columns == docs.columns

    best = {}
    for i in clean:
        norm = re.sub("[\x20\x09-\x0d]", "", rows[i].text)
        best[norm] = min(best.get(norm, (0, 1 << 62)), (-len(rows[i].text), i))
    two = stage["exact_dedup"](spark, one, SF_STAGES).persist()
    assert sorted(r.doc_id for r in two.collect()) == sorted(i for _, i in best.values())

    fp = {i: simhash.fingerprint(rows[i].text.encode(), 3) for _, i in best.values()}
    component = {i: min(j for j in fp if (fp[i] ^ fp[j]).bit_count() <= 3) for i in fp}
    three = stage["simhash_dedup"](spark, two, SF_STAGES).persist()
    kept = sorted(r.doc_id for r in three.collect())
    assert set(kept) <= {i for i, c in component.items() if c == i} and three.columns == docs.columns

    four = stage["mixing"](spark, three, SF_STAGES).persist()
    words = sum(len(rows[i].text.split()) for i in kept)
    taken = sum(len(r.text.split()) for r in four.collect())
    assert four.columns == docs.columns and 1.0 * words < taken <= 2 * words
    five = stage["packing"](spark, four, SF_STAGES).collect()
    assert {r.doc_id for r in five} == {r.doc_id for r in four.collect()}


def test_entry_stands_without_the_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(f"{root}/tabml", f"{tmp_path}/tabml", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sorted(k for k in e.queries() if k[:2] == 'op' or k == 'pipeline'), len(e.queries()) > 80)"],
                         cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip() == "[] True", out.stderr
