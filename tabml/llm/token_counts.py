"""Token counts with a whole-token shortcut.

``whole_tokens`` proves, before the job, which vocabulary strings the
tokenizer encodes alone as one token. In the job the texts' pre-tokens that
are such strings are counted directly; only the rest is merged, each distinct one
once per slice (see ``pretokens``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm import pretokens
from tabml.llm.common import only


@cache
def _model(path: str):
    """The tokenizer and the byte size of each piece's text."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    sizes = [1 if sp.is_byte(i) else len(sp.id_to_piece(i).replace("▁", " ").encode()) for i in ids]
    return sp, np.array(sizes, dtype=np.int64)


def whole_tokens(path: str) -> list[str]:
    """The pre-tokens, as they stand after a space, that are proven to be one
    token: vocabulary strings whose own encoding is that piece alone. Their
    number is at most the vocabulary's.

    Also proves what cutting at spaces and line breaks needs: no piece has a space
    behind another character, or a line break in it.
    """
    sp, _ = _model(path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
        raise ValueError("tokens of this vocabulary reach across words; texts can't be cut into words")
    after_space = [p[1:] for p in pieces if p[0] == "▁" and len(p) > 1 and p[1] != "▁"]
    return [w for w, ids in zip(after_space, sp.encode(after_space)) if len(ids) == 1]


def merge_counts(distinct: list[str], path: str) -> np.ndarray:
    """Tokens of each word behind its space, or of a line break and the word."""
    sp, size = _model(path)
    out = []
    for text, lengths in pretokens.joined(distinct):
        # the tokenizer puts a space before the first character: give it a word of one token to hold it
        ids = np.array(sp.encode("a" + text), dtype=np.int64)
        upto = pretokens.split_tokens(size[ids], np.r_[2, lengths])
        out.append(np.diff(upto))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def count_texts(texts: pa.Array, path: str, whole: pa.Array) -> np.ndarray:
    """The number of tokens of each text of a slice."""
    sp, _ = _model(path)
    plain = pretokens.plain(texts)
    counts = np.zeros(len(texts), dtype=np.int64)
    if plain.any():
        bounds, numbers, distinct = pretokens.words(texts.filter(pa.array(plain)))
        one = pc.is_in(distinct, value_set=whole).to_numpy(zero_copy_only=False)
        each = np.ones(len(distinct), dtype=np.int64)
        each[~one] = merge_counts(distinct.filter(pa.array(~one)).to_pylist(), path)
        upto = np.r_[0, np.cumsum(each[numbers])]
        counts[plain] = np.diff(upto[bounds])
    rest = texts.filter(pa.array(~plain)).to_pylist()
    counts[~plain] = [len(sp.encode(t)) for t in rest]
    return counts


def token_counts(df: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the SentencePiece BPE model at ``path`` over whole texts,
    without begin or end tokens; strings of special tokens are ordinary text. Null
    counts as empty, with no tokens. Repeated rows get equal counts. An empty table
    gives no rows. Other columns are ignored.
    """
    whole = whole_tokens(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(whole, pa.large_string())
        for b in batches:
            parts = [count_texts(t, path, known) for t in pretokens.slices(b.column("text"))]
            n = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
            size = pc.fill_null(pc.binary_length(b.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), size, pa.array(n), pa.array(n > limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    docs = only(df, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
