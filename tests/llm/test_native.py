"""URL filter and mixing: plans, edge cases, brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tabml.llm import mixing, queries, url_filter

URLS = [None, "", "no scheme", "http://", "https://Example.ORG/es/1", "https://example.org/en/12?x=1", "https://example.org/en/2#a", "ftp://a.b.example.org/",
        "https://example.org", "https://example.org?x/es/", "http://x.com/fr/a", "http://com/de/", "http://xcom/de/", "http://y.com/de", "http://y.com/it/",
        "http://É.org/ü", "http://a://b.com/fr/", "//x.com/fr/", "http://.com/fr/", "http://org./x", "http://x.com/fr/" + "p" * 100000, "http://" + "a." * 3000 + "org/x"]


def judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, verdict in rules.items():
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(rule[len(h):]):
            fits.append((len(rule), len(h), rule, verdict))
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("rules", [queries.RULES, {}, {"org/": "block"}, {"com/fr/": "allow", "x.com/f": "block", "x.com/fr/a": "allow", "a.org/x": "block"}])
def test_url_filter(spark, rules):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[4], "x"), (4, URLS[4], "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = url_filter.judge(df, rules).collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *judge(u, rules)) for i, u, _ in rows)
    assert url_filter.judge(df.limit(0), rules).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("crc32(cast(key as binary)) % 97 = 0")
    cascade = url_filter.Cascade(listed, universe)
    assert len(cascade.levels) > 2
    wrong = universe.join(listed.withColumn("l", F.lit(True)), "key", "left").where(cascade.lists(F.col("key")) != F.coalesce("l", F.lit(False)))
    assert wrong.count() == 0


def plan(df):
    return df._jdf.queryExecution().toString()


def test_native_plans_hold_no_python(spark, docs):
    pages = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    for df in (url_filter.judge(pages, queries.RULES), mixing.mix_sizes(docs), mixing.mix(docs)):
        assert not re.search("Python|Pandas|Arrow", plan(df))


def water_fill(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * level > cap * sizes[s]}
        if not over:
            return target | {s: w[s] * level for s in open_}
        target |= {s: cap * sizes[s] for s in over}
        left -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return target


def test_mixing(docs, rows, empty):
    size = {i: len(re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t, *_ in rows}
    source = {r[0]: r[3] for r in rows}
    total = defaultdict(int)
    for r in rows:
        total[r[3]] += size[r[0]]
    target = water_fill(total)
    got = mixing.mix_sizes(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    for r in got:
        s = source[r.doc_id]
        rate = target[s] / total[s] if total[s] else 0
        draw = int(hashlib.md5(f"42:{r.doc_id}".encode()).hexdigest()[:13], 16) / (1 << 52)
        copies = int(rate + 1e-12) + (draw < rate - int(rate + 1e-12))
        assert (r.size, r.source_size, r.taken) == (size[r.doc_id], total[s], size[r.doc_id] * copies)
        assert r.target == pytest.approx(target[s]) and r.taken <= 2 * r.size
    again = mixing.mix_sizes(docs.repartition(2)).collect()
    assert Counter(again) == Counter(got)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = Counter(r.doc_id for r in mixed.collect())
    for r in got:
        if r.size:
            assert taken[r.doc_id] == r.taken // r.size * Counter(x[0] for x in rows)[r.doc_id]
    assert mixing.mix_sizes(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mixing_of_null_ids_and_wordless_tables(spark, with_null_ids):
    assert mixing.mix_sizes(with_null_ids).count() == with_null_ids.count()
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.mix_sizes(blank).collect()] == [(0, 0.0, 0)] * 2


def test_mix_comes_near_its_targets(spark):
    rows = [(i, "w " * (1 + i * 7919 % 50), "abcdefg"[min(i % 13, 6)]) for i in range(6000)]
    got = mixing.mix_sizes(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for r in got.groupBy("source_size").agg(F.sum("taken").alias("t"), F.max("target").alias("target")).collect():
        assert abs(r.t - r.target) < 0.08 * r.target
