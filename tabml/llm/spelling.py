"""Spelling variant grouping with a trie of letter-group counts.

A word's frequency vector is how often it has a letter of each group. One
inserted, deleted or replaced letter gives a word at most one letter more in one
group (surplus) and one less in one other (deficit), so near words lie close
together in a trie whose levels are the counts of one group after the other.

1. ``word_counts``: how often each word occurs, summed in the scan tasks first.
2. ``top_trie``: the upper levels, refined until each leaf, a subtrie, holds a bounded
   number of words. Only counts per prefix of overfull nodes come to the driver.
3. ``near``: every word descends the upper levels depth first, spending a surplus
   and a deficit of one each, and is sent to the subtries it reaches, in
   order, so that a pair meets once. There the search goes on down to the leaf words,
   and what the budget leaves is verified letter by letter. A pair doesn't leave its task:
   each word's number of near words and its most frequent one do.
4. ``roots``: forms are followed by pointer jumping; a form is so much more
   frequent than its word that chains are short.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import LOWER, arrow, only, shared_table, shuffle_partitions, sorted_groups, texts_of

#: letter groups, the levels of the trie
GROUPS = 16
#: words below which a node isn't divided further
LEAF = 24
#: subtries that the upper levels have at most, about
_SUBTRIES = 20_000
#: pairs verified at once, and compared at once in a leaf
_PAIRS, _BLOCK = 1 << 17, 1 << 20
#: letters of a word up to which verification is vectorised
_WIDTH = 48
_DEALT = "owner int, sub int, foreign boolean, word string, n long"
_FOUND = "word string, n_near long, best_n long, best string"


def damaged(doc_prefix_crc: int, run: bytes, every: int) -> bytes:
    """The run (Latin-1) without one letter, for one in ``every`` pairs of document and run."""
    h = zlib.crc32(run.decode("latin-1").encode(), doc_prefix_crc)
    at = h % len(run)
    return run if h % every else run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, chars: int = 7, count: int = 2, every: int | None = 31, flush: int = 1 << 18) -> DataFrame:
    """(word, n) of all words with at least ``chars`` letters and ``count`` occurrences in
    (doc_id, text): runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased. With
    ``every``, that share of documents' runs first loses a letter, by checksum."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % chars)
    schema = arrow("word string, n long")

    def batch(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(counts.values(), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for i, text in zip(b.column("doc_id").to_pylist(), texts_of(b.column("text"))):
                prefix = zlib.crc32(b":" if i is None else b"%d:" % i)
                for word, n in Counter(runs.findall(text.translate(LOWER).decode("utf-8", "replace"))).items():
                    word = word.encode("latin-1")
                    if every:
                        word = damaged(prefix, word, every)
                    if len(word) >= chars:
                        counts[word] += n
                if len(counts) >= flush:
                    yield batch(counts)
                    counts = Counter()
        yield batch(counts)

    words = docs.mapInArrow(run, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def vectors(words: list[bytes]) -> np.ndarray:
    """The frequency vectors of Latin-1 words: a letter's group is its code's remainder."""
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    codes = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64) % GROUPS
    cell = np.repeat(np.arange(len(words)), length) * GROUPS + codes
    return np.bincount(cell, minlength=len(words) * GROUPS).reshape(-1, GROUPS)


def latin(column: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


def top_trie(words: DataFrame, bound: int) -> dict[tuple[int, ...], int]:
    """The subtries: the shortest count prefixes that at most ``bound`` words
    share (or whole vectors), with their numbers of words, in order."""
    total = words.count()
    if total <= bound:
        return {(): total}
    leaves, overfull, depth = {}, {()}, 0
    while overfull:
        below = min(GROUPS, depth + (4 if not depth else 2))

        def count(batches: Iterator[pa.RecordBatch], depth=depth, below=below, overfull=frozenset(overfull)) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    prefix, n = np.unique(vectors(latin(b.column("word")))[:, :below], axis=0, return_counts=True)
                    keep = [(p, k) for p, k in zip(prefix.tolist(), n.tolist()) if tuple(p[:depth]) in overfull]
                    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in keep], pa.list_(pa.int64())), pa.array([k for _, k in keep], pa.int64())], ["p", "n"])

        found = words.select("word").mapInArrow(count, "p array<long>, n long").groupBy("p").agg(F.sum("n").alias("n")).collect()
        at = Counter()
        for p, n in found:
            for d in range(depth + 1, below + 1):
                at[tuple(p[:d])] += n
        for p, n in at.items():  # the shortest that fit; those that don't go on from the longest
            if len(p) - 1 > depth and at[p[:-1]] <= bound:
                continue
            if n <= bound or len(p) == GROUPS:
                leaves[p] = n
        overfull = {p for p, n in at.items() if len(p) == below and n > bound and below < GROUPS}
        depth = below
    return dict(sorted(leaves.items()))


class Trie:
    """The trie of some vectors, all of one length or prefixes of it. Sorted, a node
    is a range of them."""

    def __init__(self, rows: list[tuple[int, ...]] | np.ndarray, leaf: int) -> None:
        self.rows, self.leaf = rows, leaf

    def search(self, queries: np.ndarray):
        """Depth first: (a, b, depth, which, surplus, deficit) of each leaf range
        that queries reach, and what they have spent by then."""
        n = len(queries)
        stack = [(0, len(self.rows), 0, np.arange(n), np.zeros(n, dtype=np.int8), np.zeros(n, dtype=np.int8))]
        while stack:
            a, b, depth, which, surplus, deficit = stack.pop()
            if self.done(a, b, depth):
                yield a, b, depth, which, surplus, deficit
                continue
            asked = queries[which, depth]
            for count, x, y in self.children(a, b, depth):
                more = asked - count
                keep = (more == 0) | ((more == 1) & (surplus == 0)) | ((more == -1) & (deficit == 0))
                if keep.any():
                    more = more[keep].astype(np.int8)
                    stack.append((x, y, depth + 1, which[keep], surplus[keep] + (more > 0), deficit[keep] + (more < 0)))

    def done(self, a: int, b: int, depth: int) -> bool:
        return b - a <= self.leaf or depth == GROUPS

    def children(self, a: int, b: int, depth: int):
        column = self.rows[a:b, depth]
        at = np.r_[0, np.flatnonzero(column[1:] != column[:-1]) + 1, b - a]
        return [(int(column[x]), a + int(x), a + int(y)) for x, y in zip(at[:-1], at[1:])]


class TopTrie(Trie):
    """The upper levels: a range ends where a subtrie's whole prefix is consumed."""

    def __init__(self, subtries: list[tuple[int, ...]]) -> None:
        super().__init__(subtries, 1)

    def done(self, a: int, b: int, depth: int) -> bool:
        return b - a == 1 and len(self.rows[a]) == depth

    def children(self, a: int, b: int, depth: int):
        out = []
        for i in range(a, b):
            if not out or out[-1][0] != self.rows[i][depth]:
                out.append([self.rows[i][depth], i, i + 1])
            out[-1][2] = i + 1
        return out

    def home(self, queries: np.ndarray) -> np.ndarray:
        """The subtrie that each word belongs to."""
        out = np.zeros(len(queries), dtype=np.int64)
        for a, _, _, which, surplus, deficit in self.search(queries):
            out[which[(surplus == 0) & (deficit == 0)]] = a
        return out


def one_edit(a: bytes, b: bytes) -> bool:
    """The words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    same, differ = 0, len(a) + 1  # bisect for the common prefix
    while differ - same > 1:
        middle = (same + differ) // 2
        same, differ = (middle, differ) if a[:middle] == b[:middle] else (same, middle)
    return a[same + (len(a) == len(b)):] == b[same + 1:]


class Words:
    """Latin-1 words as a matrix, to verify many pairs at once."""

    def __init__(self, words: list[bytes]) -> None:
        self.words = words
        self.length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        width = min(_WIDTH, int(self.length.max(initial=0))) + 1
        self.codes = np.frombuffer(b"".join(w[:width].ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(-1, width)

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the pairs are one edit apart."""
        i, j = np.where(self.length[i] <= self.length[j], i, j), np.where(self.length[i] <= self.length[j], j, i)
        out = np.zeros(len(i), dtype=bool)
        step = self.length[j] - self.length[i]
        long = self.length[j] >= self.codes.shape[1]
        for k in np.flatnonzero(long & (step <= 1)).tolist():
            out[k] = one_edit(self.words[i[k]], self.words[j[k]])
        k = np.flatnonzero(~long & (step == 0))
        out[k] = (self.codes[i[k]] != self.codes[j[k]]).sum(axis=1) == 1
        k = np.flatnonzero(~long & (step == 1))
        if len(k):
            a, b = self.codes[i[k]], self.codes[j[k]]
            prefix = (a != b).argmax(axis=1)  # they differ at the end of the shorter one at the latest
            shifted = a[:, :-1] != b[:, 1:]
            suffix = np.where(shifted.any(axis=1), shifted.shape[1] - shifted[:, ::-1].argmax(axis=1), 0)
            out[k] = suffix <= prefix
        return out


def _halves(words: list[bytes], queries: np.ndarray, a: int, b: int):
    """Of a leaf of very many equal vectors (words a to b) and its queries, the
    pairs that share the first or the second half of their letters: one edit
    leaves one of the halves as it is."""
    by_length: dict[int, list[int]] = {}
    for q in queries.tolist():
        by_length.setdefault(min(len(words[q]), len(words[a])), []).append(q)
    for shorter, asked in by_length.items():
        half, rest = shorter // 2, shorter - shorter // 2
        first, second = {}, {}
        for w in range(a, b):
            first.setdefault(words[w][:half], []).append(w)
            second.setdefault(words[w][-rest:], []).append(w)
        for q in asked:
            found = np.unique(first.get(words[q][:half], []) + second.get(words[q][-rest:], [])).astype(np.int64)
            yield np.full(len(found), q), found


def pairs(words: list[bytes], home: int, leaf: int = LEAF):
    """Near pairs (i, j), each once, of the first ``home`` words, sorted by vector,
    among themselves and with the others."""
    table, vec = Words(words), vectors(words)
    trie = Trie(vec[:home], leaf)
    held, size = [], 0
    for a, b, depth, which, surplus, deficit in trie.search(vec):
        which, keep = which[which > a], which > a  # a pair is found from its later word
        surplus, deficit = surplus[keep], deficit[keep]
        if depth == GROUPS and len(which) * (b - a) > _PAIRS:
            found = _halves(words, which, a, b)
        else:
            found = (x for x in _within(vec, trie.rows, a, b, depth, which, surplus, deficit))
        for q, w in found:
            later = q > w
            held.append((q[later], w[later]))
            size += int(later.sum())
            if size >= _PAIRS:
                yield _verified(table, held)
                held, size = [], 0
    if held:
        yield _verified(table, held)


def _within(vec, rows, a, b, depth, which, surplus, deficit):
    """The pairs of queries and words a to b that the rest of the vectors allows."""
    step = max(1, _BLOCK // ((b - a) * max(1, GROUPS - depth)))
    for x in range(0, len(which), step):
        q = which[x:x + step]
        more = vec[q, None, depth:] - rows[None, a:b, depth:]
        up = np.maximum(more, 0).sum(axis=2) + surplus[x:x + step, None]
        down = np.maximum(-more, 0).sum(axis=2) + deficit[x:x + step, None]
        i, j = np.nonzero((up <= 1) & (down <= 1))
        yield q[i], j + a


def _verified(table: Words, held) -> tuple[np.ndarray, np.ndarray]:
    i, j = (np.concatenate(x) for x in zip(*held))
    ok = table.near(i, j)
    return i[ok], j[ok]


def best_near(words: list[bytes], n: np.ndarray, home: int) -> pa.RecordBatch:
    """Per word the number of its near words here and the most frequent one of them."""
    order = sorted(range(len(words)), key=lambda k: (-n[k], words[k]))
    rank = np.empty(len(words), dtype=np.int64)
    rank[order] = np.arange(len(words))
    number, best = np.zeros(len(words), dtype=np.int64), np.full(len(words), len(words), dtype=np.int64)
    for i, j in pairs(words, home):
        for x, y in ((i, j), (j, i)):
            number += np.bincount(x, minlength=len(words))
            np.minimum.at(best, x, rank[y])
    found = np.flatnonzero(number)
    with_ = [order[k] for k in best[found].tolist()]
    return pa.RecordBatch.from_arrays(
        [pa.array([words[k].decode("latin-1") for k in found.tolist()], pa.string()), pa.array(number[found]), pa.array(n[with_], pa.int64()),
         pa.array([words[k].decode("latin-1") for k in with_], pa.string())], ["word", "n_near", "best_n", "best"])


def _reached(top: TopTrie, vec: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The own subtrie of each word, and for subtries the words that go there."""
    home = top.home(vec)
    return home, [(a, which[home[which] <= a]) for a, _, _, which, _, _ in top.search(vec)]


def traffic(words: DataFrame, top: TopTrie) -> np.ndarray:
    """How many words go to each subtrie, its own and foreign ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(top.rows), dtype=np.int64)
        for b in batches:
            if b.num_rows:
                for sub, which in _reached(top, vectors(latin(b.column("word"))))[1]:
                    n[sub] += len(which)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n), pa.int32()), pa.array(n[n > 0])], ["sub", "n"])

    out = np.zeros(len(top.rows))
    for sub, n in words.select("word").mapInArrow(run, "sub int, n long").groupBy("sub").agg(F.sum("n")).collect():
        out[sub] = n
    return out


def deal(words: DataFrame, subtries: dict[tuple[int, ...], int], tasks: int) -> DataFrame:
    """Every word in its own subtrie and, as foreign, in the later ones it reaches.
    Owner tasks have neighbouring subtries and about as many words each."""
    top = TopTrie(list(subtries))
    size = traffic(words, top)
    owner = np.minimum(((np.cumsum(size) - size / 2) / max(size.sum(), 1) * tasks).astype(np.int64), tasks - 1)
    schema = arrow(_DEALT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            home, reached = _reached(top, vectors(latin(b.column("word"))))
            which = np.concatenate([w for _, w in reached])
            sub = np.concatenate([np.full(len(w), a) for a, w in reached])
            rows = pa.array(which)
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner[sub], pa.int32()), pa.array(sub, pa.int32()), pa.array(home[which] != sub), b.column("word").take(rows), b.column("n").take(rows)],
                schema=schema)

    return words.select("word", "n").mapInArrow(run, _DEALT)


def near(words: DataFrame, bound: int | None = None) -> DataFrame:
    """(word, n_near, best_n, best) of the words of (word, n) that have near ones."""
    total = words.count()
    # a word with its copies in other subtries takes some 400 bytes
    tasks = max(shuffle_partitions(words.sparkSession), total * 400 // (32 << 20))
    subtries = top_trie(words, bound or max(min(total // (4 * tasks), 1 << 15), 512, total // _SUBTRIES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["sub"]):
            words, foreign = latin(group.column("word")), group.column("foreign").to_numpy()
            n, vec = group.column("n").to_numpy(), vectors(words)
            order = np.lexsort((*vec.T[::-1], foreign)).tolist()
            yield best_near([words[k] for k in order], n[order], int((~foreign).sum()))

    dealt = deal(words, subtries, tasks).repartitionById(tasks, "owner").sortWithinPartitions("sub")
    found = dealt.select("sub", "foreign", "word", "n").mapInArrow(run, _FOUND)
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b"))
    return best.select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) of (word, form): the last of at most ``steps`` forms in turn,
    by pointer jumping."""
    at = shared_table(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(max(0, steps - 1).bit_length()):
        up = at.select(F.col("word").alias("root"), F.col("root").alias("up"))
        at = shared_table(at.join(up, "root", "left").select("word", F.coalesce("up", "root").alias("root")), "roots")
    return at


def group_variants(words: DataFrame, ratio: int = 10, bound: int | None = None) -> DataFrame:
    """One row per row of (word, n): word, form, root, n, n_near, form_n.

    Near words differ by exactly one inserted, deleted or replaced code point. A
    word's form is the most frequent near word (ties: the smallest by code points)
    if it occurs at least ``ratio`` times as often; its root is the end of its
    chain of forms, itself without one. Words are distinct, of code points up to
    U+00FF and at least one of them; n is at least 1. No words give no rows.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words")
    words = shared_table(words.select("word", "n"), "words")
    most, least = words.agg(F.max("n"), F.min("n")).first()
    is_form = F.col("best_n") >= ratio * F.col("n")
    found = words.join(near(words, bound), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"))
    found = shared_table(found, "near")
    steps = math.ceil(math.log(max(1, (most or 1) / (least or 1)), ratio) + 1e-9)
    ends = roots(found.where("form is not null").select("word", "form"), steps)
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars: int = 7, count: int = 2,
                      every: int | None = 31, ratio: int = 10) -> DataFrame:
    """``group_variants`` of the words of whole texts, counted by ``word_counts``.

    A null text has no words. Repeated rows count again. A row without an id
    takes the empty string for it in the checksum. Very long runs are words like
    others. Other columns are ignored; a table without such words gives no rows.
    """
    docs = only(df, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return group_variants(word_counts(docs, chars, count, every), ratio)
