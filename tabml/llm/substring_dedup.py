"""Substring dedup by anchor-cut chunks and window lookup.

This stands in for a dealt relative Lempel-Ziv parse: no longest match is taken
against a reference block. What is called a factor here is a chunk of a document,
cut without any reference, and equal chunks and windows are grouped by hash.

Every window of consecutive words has an
anchor, its smallest k-word hash, and a document is cut greedily, left to right,
into factors: runs of windows, as long as they can be, that share one anchor.
Equal word sequences are cut alike, whatever surrounds them, as far as their
windows go. The index deals the factors into blocks by the hash of their
anchor, and each factor meets, in one block, all that could repeat it:

* a factor whose whole content also starts earlier is a duplicate span;
* a first factor whose anchor stands in no other content repeats nothing;
* at the boundaries, where an anchor is known with different words around
  it, the factor's windows are looked up one by one (in a second index, of windows).

Equal factors of one Arrow slice are settled before the shuffle, so what
very many documents share reaches its block once per slice, and the rest is settled by
streams over sorted blocks that hold one row of the open group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm import pretokens
from tabml.llm.common import mix, only, shared_table, shuffle_partitions, signed, texts_of

_FACTORS = "route long, settled boolean, h1 long, h2 long, doc_id long, start int, n int"
_SPANS = "doc_id long, start int, n int, boundary boolean"


def _step(acc: np.ndarray, word: np.ndarray) -> np.ndarray:
    acc = (acc ^ word) * np.uint64(0x9E3779B97F4A7C15)
    return acc ^ (acc >> np.uint64(29))


def run_hash(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A 64-bit hash of ``size`` words from each word on."""
    n = max(len(words) - size + 1, 0)
    acc = np.full(n, seed, dtype=np.uint64)
    for i in range(size):
        acc = _step(acc, words[i:i + n])
    return mix(acc)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of all words of a slice's texts, end to end, and the
    bounds of each text's words."""
    lists = pc.ascii_split_whitespace(texts)
    flat, bounds = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    bounds -= bounds[0]
    coded = flat.dictionary_encode()
    distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
    h = np.array([xxhash.xxh64_intdigest(w, 11) for w in distinct], dtype=np.uint64)
    empty = np.array([not w for w in distinct], dtype=bool)
    numbers = coded.indices.to_numpy()
    if empty.any():  # white space at either end of a text
        real = ~empty[numbers]
        bounds = np.r_[0, np.cumsum(real)][bounds]
        numbers = numbers[real]
    return (h[numbers] if len(h) else np.zeros(0, np.uint64)), bounds


def anchor_length(window: int) -> int:
    """Words in an anchor: the window less the power of two of places where it may stand, and one."""
    return window - _places(window) + 1


def _places(window: int) -> int:
    return 1 << ((window * 4 // 5).bit_length() - 1)


def factors(words: np.ndarray, bounds: np.ndarray, window: int):
    """(text, first window, windows, anchor hash, content hash) of every factor."""
    empty = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    n = len(words) - window + 1
    if n <= 0:
        return empty
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    starts = np.flatnonzero(np.arange(n) + window <= bounds[text + 1])
    if not len(starts):
        return empty
    least = run_hash(words, anchor_length(window), 1)
    at = np.arange(len(least), dtype=np.int64)
    anchor_hash, reach, places = least, 1, _places(window)
    while reach < places:  # the leftmost smallest of twice as many places
        better = least[reach:] < least[:-reach]
        at = np.where(better, at[reach:], at[:-reach])
        least = np.where(better, least[reach:], least[:-reach])
        reach *= 2
    at = at[starts]
    new = np.r_[True, (np.diff(starts) != 1) | (np.diff(at) != 0) | (np.diff(text[starts]) != 0)]
    first = np.flatnonzero(new)
    size = np.diff(np.r_[first, len(starts)])
    begin, anchor = starts[first], at[first]
    acc = mix((size << 8 | (anchor - begin)).astype(np.uint64) + np.uint64(1))
    length = size + window - 1
    for i in range(int(length.max())):
        open_ = np.flatnonzero(length > i)
        acc[open_] = _step(acc[open_], words[begin[open_] + i])
    return text[begin], begin - bounds[text[begin]], size, anchor_hash[anchor], mix(acc)


def _settle(doc_id, start, n, h1, h2) -> pa.RecordBatch:
    """Rows of one slice: of those with equal hashes the earliest goes to its
    block, and those behind it are settled and only pass through some block."""
    order = np.lexsort((start, doc_id, h2, h1))
    doc_id, start, n, h1, h2 = (x[order] for x in (doc_id, start, n, h1, h2))
    same = np.r_[False, (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])] if len(h1) else np.zeros(0, bool)
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(h1)))) if len(h1) else np.zeros(0, np.int64)
    settled = same & ((doc_id != doc_id[lead]) | (start != start[lead]))
    route = np.where(settled, mix(doc_id.astype(np.uint64) + start.astype(np.uint64)), h1)
    zero = np.uint64(0)
    return pa.RecordBatch.from_arrays(
        [pa.array(signed(route)), pa.array(settled), pa.array(signed(np.where(settled, zero, h1))), pa.array(signed(np.where(settled, zero, h2))),
         pa.array(doc_id), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
        ["route", "settled", "h1", "h2", "doc_id", "start", "n"])


def _parse(window: int):
    """Factors of (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, at = b.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64), 0
            for texts in pretokens.slices(b.column("text")):
                own, at = ids[at:at + len(texts)], at + len(texts)
                text, start, n, h1, h2 = factors(*word_hashes(texts), window)
                yield _settle(own[text], start, n, h1, h2)

    return run


def _boundary_windows(window: int):
    """The windows of (doc_id, text, spans), each under two hashes of its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, spans, at = b.column("doc_id").to_numpy(zero_copy_only=False), b.column("spans").to_pylist(), 0
            for texts in pretokens.slices(b.column("text")):
                words, bounds = word_hashes(texts)
                pick, doc = [], []
                for i, (a, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    for s in spans[at + i]:
                        p = np.arange(a + s["start"], min(a + s["start"] + s["n"], e - window + 1))
                        pick.append(p)
                        doc.append(np.full(len(p), i))
                pick, doc = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (pick, doc))
                h1, h2 = (run_hash(words, window, seed)[pick] for seed in (2, 3))
                yield _settle(ids[at:at + len(texts)][doc], pick - bounds[doc], np.ones(len(pick), np.int64), h1, h2)
                at += len(texts)

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of a block's rows, ordered by (settled, h1, h2, doc_id, start). Of a
    group with equal hashes all but the earliest are duplicates; the earliest is a
    boundary if its anchor (h1) has several groups."""
    last = lead = None  # the last row, and the earliest of its group
    waiting = None  # the only first row of the open anchor so far
    for b in batches:
        if not b.num_rows:
            continue
        settled, h1, h2, doc, start, n = (b.column(c).to_numpy(zero_copy_only=False) for c in ("settled", "h1", "h2", "doc_id", "start", "n"))
        new1 = np.r_[last is None or (last[0], last[1]) != (bool(settled[0]), int(h1[0])), (h1[1:] != h1[:-1]) | (settled[1:] != settled[:-1])]
        new2 = new1 | np.r_[last is None or last[2] != int(h2[0]), h2[1:] != h2[:-1]]
        at = np.maximum.accumulate(np.where(new2, np.arange(len(h1)), -1))
        lead_doc = np.where(at < 0, lead[0] if lead else 0, doc[at])
        lead_start = np.where(at < 0, lead[1] if lead else 0, start[at])
        repeat = settled | (~new2 & ((doc != lead_doc) | (start != lead_start)))
        # first rows by anchor: an anchor's number in this batch, 0 for the one left open before
        anchor = np.cumsum(new1)
        first = np.flatnonzero(new2 & ~settled)
        per = np.bincount(anchor[first], minlength=int(anchor[-1]) + 1)
        if last is not None and not last[0] and not new1[0]:
            before = 1 if waiting is not None else 2
            if per[0] and before == 1:
                yield _spans(*[np.array([x]) for x in waiting], True)
                waiting = None
            per[0] += before
        keep = first[(per[anchor[first]] > 1)]
        alone = first[(per[anchor[first]] == 1) & (anchor[first] == anchor[-1])]
        if anchor[-1] > 0:
            waiting = (int(doc[alone[0]]), int(start[alone[0]]), int(n[alone[0]])) if len(alone) else None
        yield _spans(doc[repeat], start[repeat], n[repeat], False)
        yield _spans(doc[keep], start[keep], n[keep], True)
        last = bool(settled[-1]), int(h1[-1]), int(h2[-1])
        lead = int(lead_doc[-1]), int(lead_start[-1])


def _spans(doc, start, n, boundary: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start, pa.int32()), pa.array(n, pa.int32()),
                                       pa.array(np.full(len(doc), boundary))], ["doc_id", "start", "n", "boundary"])


def _resolve(rows: DataFrame) -> DataFrame:
    dealt = rows.repartition(shuffle_partitions(rows.sparkSession), "route").drop("route")
    return dealt.sortWithinPartitions("settled", "h1", "h2", "doc_id", "start").mapInArrow(_blocks, _SPANS)


def _per_document(spans: DataFrame) -> DataFrame:
    """A document's spans in one array, at most as many as it has words."""
    return spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def duplicate_spans(docs: DataFrame, window: int = 20) -> DataFrame:
    """(doc_id, start, n): runs of ``n`` windows from word ``start`` on, whose word
    sequences all also start earlier (smaller doc_id, or earlier in the same
    document). Of (doc_id, text)."""
    known = docs.where("doc_id is not null and text is not null")
    found = shared_table(_resolve(known.mapInArrow(_parse(window), _FACTORS)), "spans")
    border = shared_table(_per_document(found.where("boundary")), "boundaries")
    singles = known.join(border, "doc_id").mapInArrow(_boundary_windows(window), _FACTORS)
    more = shared_table(_resolve(singles).where("not boundary"), "windows")
    return found.where("not boundary").unionAll(more).drop("boundary")


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, removed, kept = [], [], []
            for text, spans in zip(texts_of(b.column("text")), b.column("spans").to_pylist()):
                words = text.split()
                covered = np.zeros(len(words) + 1, dtype=np.int64)
                for s in spans or ():
                    covered[min(s["start"], len(words))] += 1
                    covered[min(s["start"] + s["n"] + window - 1, len(words))] -= 1
                gone = np.cumsum(covered[:-1]) > 0
                total.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if removed[-1] else b" ".join(words))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return run


def substring_dedup(df: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept (the words that
    stay, joined by one space).

    A word goes if a window of ``window`` consecutive words that covers it also
    starts earlier: in a document with a smaller id, or before it in the same
    one. Words are what lies between spaces and U+0009 to U+000D; windows are judged on the
    input. Null has no words; texts shorter than a window stay. Rows that share an
    id must share their text and don't count as earlier than each other. A row
    without an id stays whole and removes nothing. An empty table gives no rows.
    Other columns are ignored.
    """
    docs = only(df, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    spans = _per_document(duplicate_spans(docs, window))
    return docs.join(spans, "doc_id", "left").mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, kept string")
