"""Exact, SimHash and substring dedup against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tabml.llm import components, exact_dedup, simhash, substring_dedup
from tests.llm.conftest import union_find

GAPS = re.compile("[\x20\x09-\x0d]")
WORD = re.compile("[^\x20\x09-\x0d]+")


def expected_groups(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[GAPS.sub("", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = Counter()
    for norm, members in groups.items():
        keep = min(members)[3]
        for *_, i in members:
            out[i, keep, len(members), hashlib.sha256(norm.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("bits,flush,bucket", [(64, 32 << 20, 64 << 20), (3, 2000, 20000), (0, 50, 1)])
def test_exact_dedup(docs, rows, bits, flush, bucket):
    got = exact_dedup.exact_dedup(docs, hash_bits=bits, flush_bytes=flush, bucket_bytes=bucket).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected_groups(rows)
    per_group = Counter(r.text_sha256 for r in got if r.kept)
    assert set(per_group.values()) == {1} and len(per_group) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize("text", ["one text", "", None])
def test_entries_of_a_hot_text_stay_small(spark, text):
    rows = [(i, text) for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    log = exact_dedup.entry_log(df, flush_bytes=100 * exact_dedup._MEMBER).select("n").collect()
    assert sum(r.n for r in log) == 5000 and max(r.n for r in log) <= 101
    got = exact_dedup.exact_dedup(df, flush_bytes=100 * exact_dedup._MEMBER).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected_groups(rows)
    assert [r.doc_id for r in got if r.kept] == [0]


def test_exact_dedup_null_ids_and_empty(with_null_ids, rows, empty):
    got = exact_dedup.exact_dedup(with_null_ids).collect()
    null_rows = [(None if r[0] % 9 == 0 else r[0], *r[1:]) for r in rows]
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected_groups(null_rows)
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.drop_copies(empty).count() == 0


def test_drop_copies_keeps_one_row_of_each_group(docs, with_null_ids):
    for df in (docs, with_null_ids):
        back = exact_dedup.drop_copies(df).collect()
        want = exact_dedup.exact_dedup(df).where("kept").collect()
        assert Counter(r.doc_id for r in back) == Counter(r.doc_id for r in want)
        assert back[0].asDict().keys() == set(df.columns)


def test_directory_doubles_only_where_a_deep_bucket_splits(spark):
    keys = [(-(1 << 63) + k, 10) for k in range(64)] + [((1 << 62) + k, 1) for k in range(3)]
    df = spark.createDataFrame(keys, "key long, bytes long")
    directory, total = exact_dedup.grow_directory(df, bucket_bytes=5, max_depth=8)
    assert directory.depth == 8 and len(directory.slots) == 256
    assert sum(total) == 643 and set(directory.slots.tolist()) == set(range(len(total)))
    # the overfull keys share their first 8 bits: the directory is as deep as it may be, other buckets are shallow
    assert sorted(directory.local)[0] == 1
    owner = exact_dedup.owners(directory, total, 4)
    assert (np.diff(owner) >= 0).all()


def brute_fingerprint(text, k):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash(docs, rows, empty):
    fp = {i: brute_fingerprint(t, 3) for i, t, *_ in rows}
    ids = sorted(fp)
    want = union_find([(a, b) for a in ids for b in ids if a < b and (fp[a] ^ fp[b]).bit_count() <= 3], ids)
    got = simhash.simhash(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all(int(r.fingerprint, 16) == fp[r.doc_id] and len(r.fingerprint) == 16 and r.component_id == want[r.doc_id] for r in got)
    kept = simhash.drop_near_copies(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == docs.columns
    assert simhash.simhash(empty).count() == 0


def test_simhash_null_ids(with_null_ids):
    got = simhash.simhash(with_null_ids).collect()
    assert any(r.doc_id is None for r in got)
    by = defaultdict(set)
    for r in got:
        by[r.component_id].add(r.doc_id)
    assert all(c is None or c in ids for c, ids in by.items()) and by.get(None, {None}) == {None}
    back = simhash.drop_near_copies(with_null_ids).collect()
    assert sum(r.doc_id is None for r in back) == sum(r.doc_id is None for r in got)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_multi_index_links_dense_balls(spark, distance):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 6).tolist()
    fps = sorted({b ^ sum(1 << int(x) for x in set(rng.integers(0, 64, k).tolist())) for b in base for k in range(7) for _ in range(40)})
    nodes = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "node long, fp long")
    edges = [(r.u, r.v) for r in simhash.link(nodes, distance).collect()]
    pairs = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= distance]
    assert union_find(edges, range(len(fps))) == union_find(pairs, range(len(fps)))


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (300, 299), (299, 300)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = union_find(edges, {x for e in edges for x in e})
    assert got == want
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_substring(rows, window):
    texts = {i: WORD.findall(t or "") for i, t, *_ in rows if i is not None}
    first, out = {}, {}
    for i in sorted(texts):
        for p in range(len(texts[i]) - window + 1):
            first.setdefault(tuple(texts[i][p:p + window]), (i, p))
    for i, w in texts.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] != (i, p):
                gone.update(range(p, p + window))
        out[i] = len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)
    return out


@pytest.mark.parametrize("window", [20, 7])
def test_substring_dedup(docs, rows, window):
    want = brute_substring(rows, window)
    got = substring_dedup.substring_dedup(docs, window).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert [r.doc_id for r in got if want[r.doc_id] != (r.n_words, r.n_removed, r.kept)] == []
    assert sum(r.n_removed for r in got) > 1000


def test_substring_dedup_shared_boundaries(spark):
    # stretches of one sequence that begin and end anywhere, over a small vocabulary, in many slices
    rng = np.random.default_rng(3)
    line = [f"w{x}" for x in rng.integers(0, 50, 400)]
    rows = []
    for i in range(150):
        a, n = int(rng.integers(0, 350)), int(rng.integers(5, 120))
        rows.append((i, " ".join([f"l{i}"] * int(rng.integers(0, 3)) + line[a:a + n] + ["w1", "w2"] * int(rng.integers(0, 12)))))
    got = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    want = brute_substring(rows, 20)
    assert all(want[r.doc_id] == (r.n_words, r.n_removed, r.kept) for r in got)


def test_substring_dedup_null_ids_and_empty(with_null_ids, rows, empty):
    known = [(r[0], *r[1:]) for r in rows if r[0] % 9]
    want = brute_substring(known, 20)
    for r in substring_dedup.substring_dedup(with_null_ids).collect():
        assert want[r.doc_id] == (r.n_words, r.n_removed, r.kept) if r.doc_id else r.n_removed == 0
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_simhash_cuts_large_buckets_into_chunk_pairs(spark):
    values = sorted({int(x) << 32 | 77 for x in np.random.default_rng(3).integers(0, 1 << 11, 600)})
    nodes = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "node long, fp long")
    probes = nodes.mapInArrow(simhash._probe, "bucket long, probe boolean, fp long, node long")
    whole, pairs = probes.groupBy("bucket").count(), simhash._pairs(probes, 64).groupBy("bucket", "i", "j").count()
    assert whole.agg({"count": "max"}).first()[0] >= len(values) and pairs.agg({"count": "max"}).first()[0] <= 64 * 4
    close = [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 3]
    want = union_find(close, range(len(values)))
    got = union_find([(r.u, r.v) for r in simhash.link(nodes, 3, chunk=64).collect()], range(len(values)))
    assert got == want
