"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabml.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_counts(rows, chars=7, count=2, every=31):
    n = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= chars and k >= count}


def brute_groups(n, ratio=10):
    near = {w: [v for v in n if abs(len(w) - len(v)) <= 1 and v != w and distance(w, v) == 1] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if n[v] >= ratio * n[w]}
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def vocabulary(seed, size):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcdeé") for _ in range(rng.randint(4, 9))) for _ in range(size)}
    for w in sorted(words)[:: 2]:
        i = rng.randrange(len(w))
        words |= {w[:i] + w[i + 1:], w[:i] + "ß" + w[i:], w[:i] + "þ" + w[i + 1:]}
    words |= {"x" * 300, "x" * 299 + "y", "x" * 301, "z" * 47, "z" * 48, "z" * 49, "z" * 50, "é", "éa", "ê"}
    return {w: rng.choice([1, 2, 9, 10, 20, 99, 100, 101, 1000, 10000]) for w in words if w}


@pytest.mark.parametrize("bound,ratio", [(None, 10), (40, 2), (3, 10)])
def test_groups(spark, bound, ratio):
    n = vocabulary(3, 250)
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    got = spelling.group_variants(df, ratio, bound).collect()
    assert len(got) == len(n) and {tuple(r) for r in got} == brute_groups(n, ratio)


def test_chain_of_forms(spark):
    n = {"abcdefgh"[:k]: 10 ** k for k in range(1, 9)}
    got = spelling.group_variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()
    assert {r.word: r.root for r in got} == dict.fromkeys(n, "abcdefgh")


def test_variants_of_texts(spark):
    rng = random.Random(1)
    words = [w for w in vocabulary(5, 60) if len(w) >= 6]
    rows = [(rng.choice([None, k]), rng.choice([" ", "1", "\n—", "×"]).join(rng.choice([str.upper, str])(w) for w in rng.choices(words, k=rng.randint(0, 30))))
            for k in range(120)]
    rows += [(-5, None), (7, ""), rows[0], rows[0], (9, "straightforwardly " * 5000), (1 << 62, "Straightforwardl straightforwardl")]
    df = spark.createDataFrame([(*r, "w", 1, 2) for r in rows], "doc_id long, text string, word string, n long, sub int").repartition(4)
    want = brute_groups(brute_counts(rows))
    got = spelling.spelling_variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == want and any(f for _, f, *_ in want)


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(empty).count() == 0
    short = spark.createDataFrame([(1, None), (2, "a bc def"), (None, "")], "doc_id long, text string")
    assert spelling.spelling_variants(short).count() == 0


def test_leaf_of_many_equal_vectors():
    # letters p and q + 16 = 0x80.. aren't words; a and q share a group, as do b and r
    rng = random.Random(2)
    words = sorted({"".join(rng.choice(x) for x in ("aq", "br") * 6).encode() for _ in range(900)})
    assert len({tuple(v) for v in spelling.vectors(words).tolist()}) == 1
    want = {(a, b) for a in words for b in words if a > b and sum(x != y for x, y in zip(a, b)) == 1}
    got = [(words[i], words[j]) for x, y in spelling.pairs(words, len(words)) for i, j in zip(x.tolist(), y.tolist())]
    assert len(got) == len(want) > 500 and {(max(p), min(p)) for p in got} == want


def test_top_trie_holds_every_word_once(spark):
    words = sorted(vocabulary(9, 400))
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    subtries = spelling.top_trie(df, 20)
    assert sum(subtries.values()) == len(words)
    assert max(n for p, n in subtries.items() if len(p) < spelling.GROUPS) <= 20
    top = spelling.TopTrie(list(subtries))
    vec = spelling.vectors([w.encode("latin-1") for w in words])
    home = top.home(vec)
    assert np.bincount(home, minlength=len(subtries)).tolist() == list(subtries.values())
    assert all(tuple(v[:len(p)]) == p for v, p in ((vec[k].tolist(), top.rows[h]) for k, h in enumerate(home.tolist())))


@settings(max_examples=300, deadline=None)
@given(st.text("abé", max_size=6), st.text("abé", max_size=6))
def test_one_edit(a, b):
    x, y = a.encode("latin-1"), b.encode("latin-1")
    assert spelling.one_edit(x, y) == (distance(a, b) == 1)
    if x and y:
        near = spelling.Words([x, y, b"q" * 20]).near(np.array([0]), np.array([1]))
        assert near.tolist() == [distance(a, b) == 1]
