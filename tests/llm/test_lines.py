"""Line dedup against brute force, and its minimal perfect hash."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tabml.llm import line_dedup
from tabml.llm.common import shared_table
from tabml.llm.minimal_hash import MinimalHash, build

SCHEMA = "doc_id long, text string, kept string, n_lines string, row_id string, lost string, uid string"
EDGES = re.compile("^[\x20\x09-\x0d]+|[\x20\x09-\x0d]+$")
NO_ID = 1 << 63


def key_of(line):
    line = EDGES.sub("", line)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)


def brute(rows, chars=10):
    first = {}
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            k = key_of(line)
            first[k] = min(first.get(k, NO_ID), NO_ID if i is None else i)
    out = Counter()
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key_of(x)) < chars or first[key_of(x)] >= (NO_ID if i is None else i)]
        out[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


@pytest.fixture(scope="module")
def lined():
    rng = random.Random(7)
    pool = ["".join(rng.choice("abcÄß é") for _ in range(rng.randint(1, 30))) for _ in range(60)]
    hot = "a line that a third of all rows have"
    rows = []
    for i in range(150):
        lines = [rng.choice(pool) for _ in range(rng.randint(1, 12))] + ([hot] if i % 3 == 0 else [])
        rng.shuffle(lines)
        lines = [rng.choice(["{}", " {}\t", "\x0b{}", "{}\r"]).format(x.upper() if x.isascii() and rng.random() < 0.2 else x) for x in lines]
        rows.append((rng.choice([i, i, i - 5, None]), "\n".join(lines)))
    rows += [(1, None), (2, ""), (3, "\n\n"), (4, " \t\n"), (5, hot), (None, hot), (None, hot), (None, None), (6, hot.upper() + "\r\n" + hot),
             (7, " " + hot), (8, "ÀÀÀÀÀÀÀÀÀÀ"), (9, "àààààààààà"), (10, "ÀÀÀÀÀÀÀÀÀ"), (11, "ÀÀÀÀÀÀÀÀÀ"), (12, "ÀÀÀÀÀÀÀÀÀÀ"),
             (500, "x" * 400000), (400, "x" * 400000), (700, "\n".join(f"{k} of very many lines" for k in range(3000))),
             (701, "\n".join(f"{k} of very many lines" for k in range(2999, 0, -2)))]
    rows += [rows[3], rows[3], (rows[4][0], rows[5][1])]
    return [(i, t, "k", "n", "r", "l", "u") for i, t in rows]


@pytest.mark.parametrize("slice_lines,shard_lines,partitions", [(1 << 19, 1 << 18, 4), (50, 3, 7), (1, 1, 2)])
def test_line_dedup(spark, lined, slice_lines, shard_lines, partitions):
    df = spark.createDataFrame(lined, SCHEMA).repartition(partitions)
    if slice_lines == 1:
        df = df.where("length(text) < 2000 or text is null")
    got = line_dedup.line_dedup(df, slice_lines=slice_lines, shard_lines=shard_lines)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    want = brute([r for r in lined if slice_lines > 1 or r[1] is None or len(r[1]) < 2000])
    assert Counter(tuple(r) for r in got.collect()) == want
    assert sum(n for (_, _, n, _), c in want.items() for _ in range(c)) > 100


def test_line_dedup_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert line_dedup.line_dedup(empty).count() == 0
    blank = spark.createDataFrame([(None, None), (1, ""), (2, None)], "doc_id long, text string")
    assert Counter(tuple(r) for r in line_dedup.line_dedup(blank).collect()) == Counter([(None, 1, 0, ""), (1, 1, 0, ""), (2, 1, 0, "")])


def test_other_columns_and_lengths(spark):
    df = spark.createDataFrame([(3, "abc\nd"), (1, "Abc \nd")], "`my id` long, `a.text` string")
    got = line_dedup.line_dedup(df, "my id", "a.text", chars=2).collect()
    assert sorted(tuple(r) for r in got) == [(1, 2, 0, "Abc \nd"), (3, 2, 1, "d")]


def test_a_slice_has_a_line_once(spark):
    hot = "one very common line of all documents"
    df = spark.createDataFrame([(i, 0, f"{hot}\nand one of {i} alone") for i in range(3000)], "row_id long, row_salt long, text string").coalesce(2)
    found = shared_table(line_dedup.slices(df, 10), "slices")
    assert [r.n for r in found.select("n").collect()] == [1501, 1501]
    layout = line_dedup.Layout(3002, 4)
    index = line_dedup.line_index(found, layout)
    assert [r.n for r in index.collect()] == [1]  # lines of one document aren't in it
    replies = line_dedup.probe(found, index, layout).collect()
    assert len(replies) == 2 and all(len(r["at"]) == 4 for r in replies)
    lost = line_dedup.verdicts(found, line_dedup.probe(found, index, layout)).collect()
    assert sorted(r.row_id for r in lost) == list(range(1, 3000)) and {len(r.dropped) for r in lost} == {16}


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50000])
def test_minimal_hash_numbers_its_keys(n):
    rng = np.random.default_rng(n)
    hi, lo = rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.integers(0, 1 << 63, n, dtype=np.uint64)
    hi[: n // 2] = 5  # half of the keys differ in one word only
    sizes, words = build(hi, lo)
    assert sorted(MinimalHash(sizes, words).numbers(hi, lo).tolist()) == list(range(n))
    assert 64 * len(words) <= 4.5 * n + 64 * 40
    other = MinimalHash(sizes, words).numbers(lo + np.uint64(1), hi)
    assert ((other >= -1) & (other < max(n, 1))).all()


def test_minimal_hash_refuses_equal_keys():
    one = np.ones(2, dtype=np.uint64)
    with pytest.raises(ValueError):
        build(one, one)
