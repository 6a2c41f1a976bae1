"""Token ids of whole texts by way of their distinct words.

Inside one slice of an Arrow batch the texts are cut where a word follows a
space or a line break, which is where neither tokenizer's tokens can reach across.
The words are dictionary-encoded in C++, each distinct word is tokenized once, all
of them in a few long strings, and ids or counts are gathered back. Texts in
which a cut isn't proven safe (runs or other kinds of white space, special strings) are
given to the tokenizer whole. Nothing is kept between slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text that are worked on at once; a longer text is a slice of its own
SLICE_BYTES = 12 << 20
#: words of one long string
_JOIN = 1 << 15

_BREAKS = "[ \\n]{2}|^[ \\n]|[ \\n]$|[\\x00-\\x09\\x0b-\\x1f\\x7f-\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200f}\\x{2028}-\\x{202f}\\x{205f}-\\x{206f}\\x{2581}\\x{3000}\\x{feff}\\x{fff0}-\\x{ffff}]"


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive slices of a string column of about SLICE_BYTES."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE_BYTES, side="right")))
        yield texts.slice(a, b - a)
        a = b


def plain(texts: pa.Array, special: str = "") -> np.ndarray:
    """Whether a text can be cut into words: non-empty, single spaces and line
    breaks between words, no other white space, none of the ``special`` strings (a regular expression)."""
    odd = pc.match_substring_regex(texts, _BREAKS + (f"|{special}" if special else ""))
    return ~pc.or_(odd, pc.equal(pc.binary_length(texts), 0)).to_numpy(zero_copy_only=False)


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of plain texts: the bounds of each text's words, the words as numbers, and
    the distinct words. A word after a line break carries it in front."""
    lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
    bounds = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    return bounds - bounds[0], coded.indices.to_numpy(), coded.dictionary


def joined(distinct: list[str]) -> Iterator[tuple[str, np.ndarray]]:
    """The words, each behind its space or line break, as long strings, with
    the byte lengths of the words in them."""
    for a in range(0, len(distinct), _JOIN):
        part = [w if w[:1] == "\n" else f" {w}" for w in distinct[a:a + _JOIN]]
        yield "".join(part), np.array([len(w.encode()) for w in part], dtype=np.int64)


def split_tokens(sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For tokens of these byte sizes in a string of words of these byte
    lengths: how many tokens begin before each word's end."""
    return np.searchsorted(np.cumsum(sizes), np.cumsum(lengths), side="right")


def gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """The runs ``values[starts[p]:starts[p] + counts[p]]`` of all picks, end to end."""
    n = counts[picks]
    ends = np.cumsum(n)
    at = np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
    at += np.repeat(starts[picks] - (ends - n), n)
    return values[at]
