"""URL rules through a Bloom filter cascade, with DataFrame functions only.

A rule's key is its host and path. A url's candidate keys are the suffixes of
its host joined to the prefixes of its path, of the shapes that rules have. The
universe is every candidate key of the corpus. Level 0 of a cascade encodes the
listed keys; level 1 the universe's keys that level 0 wrongly holds; level 2 the
listed keys that level 1 wrongly holds, and so on until none is left. For keys of
that universe the first level that doesn't hold a key tells whether it is listed:
exact, and without a join per url. There is one cascade for each verdict.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import shared_table

#: filters are literals of the plan; more listed keys than fit are refused
MAX_FILTER_BYTES = 32 << 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What lies after the first ``://`` up to /, ?, # or the end, A-Z lower-cased;
    then up to ? or #. Both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, ascii_uppercase, ascii_lowercase), path


def shape(key: str) -> tuple[int, int]:
    """The number of a rule's host labels, and the length of its path."""
    host, slash, path = key.partition("/")
    return host.count(".") + 1, len(slash + path)


def candidates(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """The url's keys of these shapes, longest first (then the longer host)."""
    labels = F.split(host, r"\.", -1)
    keys = []
    for n, size in sorted(set(shapes)):
        suffix = F.array_join(F.slice(labels, F.greatest(F.size(labels) - (n - 1), F.lit(1)), F.lit(n)), ".")
        fits = (F.size(labels) >= n) & (F.length(path) >= size) & (host != "")
        keys.append(F.when(fits, F.struct((F.length(suffix) + size).alias("chars"), F.length(suffix).alias("host"),
                                          F.concat(suffix, F.substring(path, 1, size)).alias("key"))))
    found = F.sort_array(F.array_compact(F.array(*keys)), asc=False)
    return F.transform(found, lambda k: k["key"])


class Bloom:
    """A Bloom filter over string keys: built by one aggregate, held as a literal."""

    def __init__(self, keys: DataFrame, n: int, rate: float, level: int) -> None:
        self.hashes = max(1, round(math.log2(1 / rate)))
        self.bits = max(64, 64 * math.ceil(n * self.hashes / math.log(2) / 64))
        self.level = level
        if self.bits // 8 > MAX_FILTER_BYTES:
            raise ValueError(f"a filter of {n} keys takes {self.bits // 8} bytes, over {MAX_FILTER_BYTES}")
        at = keys.select(F.explode(F.array(*self._positions(F.col("key")))).alias("at"))
        rows = at.groupBy(F.floor(F.col("at") / 64).cast("int").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits")).collect()
        words = [0] * (self.bits // 64)
        for r in rows:
            words[r["word"]] = r["bits"]
        self.words = ",".join(map(str, words))

    def _positions(self, key: Column) -> list[Column]:
        first, step = (F.pmod(F.xxhash64(key, F.lit(2 * self.level + i)), F.lit(self.bits)) for i in range(2))
        return [(first + i * step) % self.bits for i in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        words = F.split(F.lit(self.words), ",").cast("array<long>")
        tests = [F.getbit(F.get(words, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1 for p in self._positions(key)]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out


class Cascade:
    """Alternating filters over ``listed`` and the false positives in ``universe``
    (both: distinct ``key``). The first level's rate leaves about as many false
    positives as there are listed keys, so the size is in proportion to these and
    to the logarithm of the universe."""

    def __init__(self, listed: DataFrame, universe: DataFrame) -> None:
        self.levels: list[Bloom] = []
        mine = listed
        others = universe.join(listed, "key", "left_anti")
        n, m = mine.count(), others.count()
        while n:
            rate = min(0.5, n / max(m, 1)) if not self.levels else 0.5
            bloom = Bloom(mine, n, rate, len(self.levels))
            self.levels.append(bloom)
            wrong = shared_table(others.where(bloom.holds(F.col("key"))), "false_positives")
            mine, others = wrong, mine
            n, m = wrong.count(), n

    def lists(self, key: Column) -> Column:
        """Whether a key of the universe is listed: the first level that doesn't hold it decides."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(~self.levels[i].holds(key), F.lit(i % 2 == 1)).otherwise(out)
        return out


def judge(df: DataFrame, rules: dict[str, str], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict.

    ``rules`` maps a host with a path (``net/``, ``example.org/es/``) to ``allow`` or
    ``block``. A rule fits its host and all subdomains if the url's path starts with
    the rule's; the longest wins, of equally long ones that with the longer host.
    Where no rule fits, rule is null and the verdict is ``default``. A null url, or
    one without ``://``, has an empty host and path, which nothing fits. Repeated rows
    get equal verdicts, an empty table gives no rows, and other columns are ignored.
    """
    spark = df.sparkSession
    verdicts = sorted(set(rules.values()))
    host, path = host_and_path(F.col(f"`{url_col}`"))
    pages = df.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    keys = candidates(F.col("host"), F.col("path"), [shape(k) for k in rules])
    pages = pages.withColumn("keys", keys if rules else F.array().cast("array<string>"))
    universe = shared_table(pages.select(F.explode("keys").alias("key")).distinct(), "universe")
    hit = F.lit(None).cast("struct<rule: string, verdict: string>")
    cascades = {v: Cascade(spark.createDataFrame([(k,) for k in sorted(rules) if rules[k] == v], "key string"), universe) for v in verdicts}

    def verdict(key: Column) -> Column:
        out = F.lit(None).cast("string")
        for v, cascade in cascades.items():
            out = F.when(cascade.lists(key), F.lit(v)).otherwise(out)
        return out

    if rules:
        judged = F.transform("keys", lambda k: F.struct(k.alias("rule"), verdict(k).alias("verdict")))
        hit = F.get(F.filter(judged, lambda j: j["verdict"].isNotNull()), F.lit(0))
    return pages.withColumn("hit", hit).select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
