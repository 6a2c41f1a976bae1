"""Small inputs with the awkward cases: null ids, texts and sources, empty and
very long texts, ties, repeated rows, clashing column names."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, group_size string, text_sha256 string, taken string, label string, size string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    rng = random.Random(5)
    passage = words(rng, 60)
    texts = [words(rng, rng.randint(1, 120)) for _ in range(60)]
    texts += [f"{words(rng, 30)} {passage} {words(rng, 25)}" for _ in range(12)]
    texts += [passage, passage, f"{passage} {passage}", f"  {passage}\n", passage.replace(" ", "\t"), passage.upper()]
    texts += [texts[0]] * 5 + [texts[1].replace(" ", "\n\n"), texts[1] + " "]
    texts += [None, None, "", " \t\n", "a", "a b", "x" * 300000, words(rng, 40000), "ab " * 5000, "\x1c odd\x85 \u3000 white\u2581 space", "<|endoftext|> <s> tail"]
    texts += [" ".join([w, *t.split()[1:]]) for t in texts[:20] if t for w in ("zz",)]
    sources = ["a", "a", "a", "b", "c", None, "é", "Z"]
    order = list(range(1, len(texts) + 1))
    rng.shuffle(order)
    out = [(i, t, "en", sources[i % len(sources)], len(t or ""), "x", "y", "z", "t", "l", "s") for i, t in zip(order, texts)]
    return out + [out[3], out[3], out[70]]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def with_null_ids(spark, rows):
    return spark.createDataFrame([(None if i % 9 == 0 else i, *r) for i, *r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def union_find(pairs, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
