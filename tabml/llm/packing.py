"""Packing token ids into sequences by the sum-of-squares rule.

Every scan task packs its own rows online. A document's full windows go out as
they are. What remains goes into an open sequence of the fill level at which
the sum, over all levels, of the squared number of open sequences at that level becomes
smallest; a level array holds these numbers. What is still open at the end is
filled up by cutting pieces of the emptiest sequences, and the last remainder
is cut into powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm import pretokens
from tabml.llm.common import arrow, only

_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


@cache
def _tokenizers(json_path: str, ranks_path: str):
    """The tokenizer, the same vocabulary for long strings of words, the byte
    size of each id, and the strings that the tokenizer takes for special tokens."""
    import base64
    import json

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, i in ranks.items():
        size[i] = len(token)
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    with open(json_path) as f:
        added = [t["content"] for t in json.load(f)["added_tokens"]]
    return Tokenizer.from_file(json_path), fast, size, added


def encode(texts: pa.Array, json_path: str, ranks_path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a slice's texts end to end, and the number of each text's.

    Equal to ``Tokenizer.encode(text, add_special_tokens=False)``; texts with the
    string of a special token or unusual white space are given to it."""
    import re

    slow, fast, size, added = _tokenizers(json_path, ranks_path)
    plain = pretokens.plain(texts, "|".join(re.escape(t) for t in added))
    counts = np.zeros(len(texts), dtype=np.int64)
    ids = np.zeros(0, dtype=np.uint32)
    if plain.any():
        # a line break in front makes the first word one that follows a line break
        bounds, numbers, distinct = pretokens.words(pc.replace_substring_regex(texts.filter(pa.array(plain)), "^", "\n", max_replacements=1))
        bounds, numbers = _without_lead(bounds, numbers)
        values, per_word = [], []
        for text, lengths in pretokens.joined(distinct.to_pylist()):
            found = np.array(fast.encode_ordinary(text), dtype=np.uint32)
            values.append(found)
            per_word.append(np.diff(np.r_[0, pretokens.split_tokens(size[found], lengths)]))
        each = np.concatenate(per_word)
        starts = np.cumsum(each) - each
        ids = pretokens.gather(np.concatenate(values), starts, each, numbers)
        ids, counts[plain] = _drop_first(ids, np.diff(np.r_[0, np.cumsum(each[numbers])][bounds]))
    if plain.all():
        return ids, counts
    # weave the others in
    rest = [np.array(e.ids, dtype=np.uint32) for e in slow.encode_batch(texts.filter(pa.array(~plain)).to_pylist(), add_special_tokens=False)]
    counts[~plain] = [len(r) for r in rest]
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]), dtype=np.uint32)
    out[np.repeat(plain, counts)] = ids
    for at, r in zip((ends - counts)[~plain], rest):
        out[at:at + len(r)] = r
    return out, counts


def _without_lead(bounds: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaves out the empty word before each text's first line break."""
    keep = np.ones(len(numbers), dtype=bool)
    keep[bounds[:-1]] = False
    return bounds - np.arange(len(bounds)), numbers[keep]


def _drop_first(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the first id, the line break in front, of each text."""
    keep = np.ones(len(ids), dtype=bool)
    keep[np.cumsum(counts) - counts] = False
    return ids[keep], counts - 1


class Packer:
    """Open sequences by fill level. A piece is (row, start, ids); a sequence is a
    list of pieces. ``close`` gets every finished sequence."""

    def __init__(self, window: int, close) -> None:
        self.window, self.close = window, close
        self.levels = np.zeros(window + 1, dtype=np.int64)  # the number of open sequences at each fill
        self.open: list[list] = [[] for _ in range(window + 1)]

    def place(self, row, start: int, ids: np.ndarray) -> None:
        """Put a piece shorter than the window where the squares' sum grows least."""
        n, levels = len(ids), self.levels
        top = self.window - n  # the highest fill it fits on, which closes the sequence
        change = 2 * (levels[n:self.window + 1] - levels[:top + 1]) + 2
        change[0] = 2 * levels[n] + 1  # a new sequence leaves no level
        change[top] = 1 - 2 * levels[top]  # a closed one joins none
        change[1:][levels[1:top + 1] == 0] = np.iinfo(np.int64).max
        at = int(change.argmin())
        pieces = self.open[at].pop() if at else []
        if at:
            levels[at] -= 1
        pieces.append((row, start, ids))
        if at == top:
            self.close(pieces)
        else:
            levels[at + n] += 1
            self.open[at + n].append(pieces)

    def finish(self) -> None:
        """Close everything: the emptiest sequences' pieces are cut to fill the
        fullest, and the last remainder goes out in powers of two."""
        rest = [s for level in self.open for s in level]  # by fill
        self.open = [[] for _ in range(self.window + 1)]
        self.levels[:] = 0
        spare: list = []  # pieces to hand out
        while rest or spare:
            if not rest:
                self._powers(spare)
                return
            full = rest.pop()
            gap = self.window - sum(len(p[2]) for p in full)
            while gap and (spare or rest):
                if not spare:
                    spare = rest.pop(0)
                row, start, ids = spare.pop()
                take = min(gap, len(ids))
                full.append((row, start, ids[:take]))
                if take < len(ids):
                    spare.append((row, start + take, ids[take:]))
                gap -= take
            if gap:
                self._powers(full)
            else:
                self.close(full)

    def _powers(self, pieces: list) -> None:
        left = sum(len(p[2]) for p in pieces)
        pieces = pieces[::-1]
        while left:
            size = 1 << (left.bit_length() - 1)
            out, need = [], size
            while need:
                row, start, ids = pieces.pop()
                out.append((row, start, ids[:need]))
                if len(ids) > need:
                    pieces.append((row, start + need, ids[need:]))
                need -= len(out[-1][2])
            self.close(out)
            left -= size


def pack(df: DataFrame, json_path: str, ranks_path: str, window: int = 1024, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset.

    A document is the ids of its whole text and ``end_id``; null counts as empty
    and so is one id. Each id lies in exactly one piece, each sequence has at most
    ``window`` ids (a power of two) and pieces without gaps, and those shorter than the window
    have a power of two. Repeated rows are packed like any others. Sequence ids are unique over
    the table. An empty table gives no rows. Other columns are ignored. There is no
    shuffle; a task holds one Arrow batch and its open sequences.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("window must be a power of two")
    schema = arrow(_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, out = TaskContext.get().partitionId() << 33, []

        def close(pieces):
            nonlocal sequence
            at = 0
            for (doc, total), start, ids in pieces:
                out.append((doc, start, len(ids), ids.tobytes(), total, sequence, at))
                at += len(ids)
            sequence += 1

        def flush():
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out), schema)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        packer = Packer(window, close)
        for b in batches:
            docs, at = b.column("doc_id").to_pylist(), 0
            for texts in pretokens.slices(b.column("text")):
                ids, counts = encode(texts, json_path, ranks_path)
                ends = np.cumsum(counts)
                for e, n in zip(ends.tolist(), counts.tolist()):
                    own = np.append(ids[e - n:e], np.uint32(end_id))
                    row, at = (docs[at], n + 1), at + 1
                    whole = (n + 1) // window * window
                    for a in range(0, whole, window):
                        close([(row, a, own[a:a + window])])
                    if whole < n + 1:
                        packer.place(row, whole, own[whole:])
                if out:
                    yield flush()
        packer.finish()
        if out:
            yield flush()

    docs = only(df, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.mapInArrow(run, _SCHEMA)
