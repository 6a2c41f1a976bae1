"""The conversation prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tabml.llm import conversation_trie
from tabml.llm.common import shared_table

SCHEMA = "conv_id long, turn long, role string, text string, depth string, path string, base string, kind string, key string"


def rebuilt(rows, share):
    turns = defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), r or "", x or ""))
    turns = {c: [(r, x) for _, r, x in sorted(ts, key=lambda v: v[0])] for c, ts in turns.items()}
    if not share:
        return {c: tuple(ts) for c, ts in turns.items()}
    group, most = share
    out = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        out[c] = tuple(turns.get(base, [])[:h] + ts[h:])
    return out


def brute(sequences):
    members = defaultdict(list)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
    out = Counter()
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if sequences[c] == p)
        out[min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def talk(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 3 * n), n):
        depth = rng.choice([1, 2, 3, 5, 9, 14])
        for t in range(depth):
            text = rng.choice(["hi", "hi", "hi", "yes é", "no", "", None]) if t < 4 else f"word {rng.randint(0, 3)}"
            rows.append((c, None if t == 0 and c % 7 == 0 else 3 * t, rng.choice(["user", None]) if t == 1 else "user", text))
    rows += [(900, t, "user", f"turn {t // 2}") for t in range(300)] + [(901, t, "user", f"turn {t // 2}") for t in range(200)]
    rows += [(c, 0, "user", "the same first turn") for c in range(2000, 2100)] + [(c, 1, "bot", "the same answer") for c in range(2000, 2070)]
    rows += [(None, 1, "user", "nobody's"), (None, None, None, None), (5000, None, None, None), (5001, 1, "", ""), (5002, 7, "user", "x" * 300000)]
    rows += [(6000, 1, "a", "b"), (6000, 1, "a", "b"), (6001, 1, "a", "b"), (6001, 2, "a", "b")]
    rng.shuffle(rows)
    return [(*r, "d", "p", "b", "k", "y") for r in rows]


@pytest.mark.parametrize("share", [None, (5, 9)])
def test_trie_equals_brute_force(spark, share):
    rows = talk(4, 150)
    got = conversation_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), share=share)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == brute(rebuilt(rows, share))


@pytest.mark.parametrize("chunk,chunk_paths,last", [(1, 2, 6), (2000, 4, 40), (1, 1, 10)])
def test_many_chunks_and_rounds(spark, chunk, chunk_paths, last):
    rows = talk(8, 120)
    paths = shared_table(conversation_trie.sequences(spark.createDataFrame(rows, SCHEMA).repartition(3)), "paths")
    got = conversation_trie.trie(paths, chunk, chunk_paths, last).collect()
    assert Counter(tuple(r) for r in got) == brute(rebuilt(rows, None))


def test_open_nodes_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "_BROADCAST", 0)
    rows = talk(9, 40)
    got = conversation_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert Counter(tuple(r) for r in got) == brute(rebuilt(rows, None))


def test_absent_base_leaves_conversations_without_turns(spark):
    rows = [(c, t, "user", f"{t}") for c in range(1, 60) for t in range(2) if c % 5]
    got = conversation_trie.conversation_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), share=(5, 9)).collect()
    want = brute(rebuilt(rows, (5, 9)))
    assert Counter(tuple(r) for r in got) == want
    root = next(r for r in got if r.depth == 0)
    assert root.n_convs == 48 and root.parent_conv_id is None and root.ends_sha256 != hashlib.sha256(b"").hexdigest()


def test_no_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert conversation_trie.conversation_trie(spark.createDataFrame([], schema)).count() == 0
    assert conversation_trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], schema), share=(5, 9)).count() == 0
