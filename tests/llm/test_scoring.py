"""Secrets, toxicity, token counts."""

import base64
import bz2
import gzip
import hashlib
import lzma
import re
import tracemalloc
import urllib.parse
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zstandard

from tabml.llm import queries, secrets, token_counts, toxicity

SECRET = "password=hunter2hunter2"


def escaped(text, form):
    return "".join(form(ord(c)) for c in text)


WRAPS = {
    "percent": lambda s: escaped(s, lambda c: f"%{c:02X}"),
    "percent twice": lambda s: urllib.parse.quote(escaped(s, lambda c: f"%{c:02x}")),
    "unicode": lambda s: escaped(s, lambda c: f"\\u{c:04x}"),
    "html": lambda s: escaped(s, lambda c: f"&#{c};"),
    "base64": lambda s: base64.b64encode(s.encode()).decode(),
    "base64 url, no padding": lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
    "base64 thrice": lambda s: base64.b64encode(base64.b64encode(base64.b64encode(s.encode()))).decode(),
    "gzip": lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
    "zlib": lambda s: base64.b64encode(zlib.compress(s.encode())).decode(),
    "bz2": lambda s: base64.b64encode(bz2.compress(s.encode())).decode(),
    "xz": lambda s: base64.b64encode(lzma.compress(s.encode())).decode(),
    "zstd": lambda s: base64.b64encode(zstandard.compress(s.encode())).decode(),
    "gzip in gzip": lambda s: base64.b64encode(gzip.compress(gzip.compress(s.encode()))).decode(),
    "percent gzip": lambda s: urllib.parse.quote_from_bytes(gzip.compress(s.encode())),
    "all": lambda s: urllib.parse.quote(escaped(base64.b64encode(zlib.compress(base64.b64encode(s.encode()))).decode(), lambda c: f"\\u{c:04x}")),
}


@pytest.mark.parametrize("name", WRAPS)
def test_layers_are_unwrapped_and_mapped(name):
    wrapped = WRAPS[name](SECRET)
    base, decoded, layers, _ = secrets.scan(f"é {wrapped} é", 1 << 20)
    assert base == [] and layers > 0
    spans = [(a, b) for a, kind, b, _ in decoded if kind == 0]
    assert len(spans) == 1 and 2 <= spans[0][0] and spans[0][1] <= 2 + len(wrapped) and spans[0][1] - spans[0][0] >= 0.9 * len(wrapped)


def test_partly_encoded_secret_maps_to_its_own_characters():
    text = "x password%3Dabcdef12 y"
    assert secrets.scan(text, 1 << 20)[1] == [(2, 0, 21, 1)]


def test_oversize_data_is_counted_not_dropped_silently():
    bomb = base64.b64encode(gzip.compress(b"a" * 3_000_000)).decode()
    assert secrets.scan(bomb, 1 << 20)[3] == 1


def b64(data):
    return base64.b64encode(data).decode()


def wrapped_at(text, n, end="\n"):
    return end.join(text[a:a + n] for a in range(0, len(text), n))


LONG = b"".join(hashlib.sha512(b"%d" % i).digest() for i in range(64)) + SECRET.encode()


@pytest.mark.parametrize("front", ["https://example.com/x/", "key_", "auth/", "a-", "ab+", "abc_d/", "x\nword\n"])
@pytest.mark.parametrize("inner", [SECRET.encode(), gzip.compress(SECRET.encode()), zlib.compress(SECRET.encode())], ids=["plain", "gzip", "zlib"])
def test_base64_behind_a_prefix(front, inner):
    text = f"é {front}{b64(inner)} é"
    spans = [(a, b) for a, kind, b, _ in secrets.scan(text, 1 << 20)[1] if kind == 0]
    at, size = 2 + len(front), len(b64(inner))
    assert len(spans) == 1 and at <= spans[0][0] <= at + 1 and at + 0.9 * size <= spans[0][1] <= at + size


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("width", [20, 64, 76])
@pytest.mark.parametrize("inner", [b"x" * 45 + SECRET.encode() + b"y" * 50, gzip.compress(LONG), zlib.compress(LONG)], ids=["plain", "gzip", "zlib"])
def test_base64_in_lines(inner, width, end):
    text = f"é {wrapped_at(b64(inner), width, end)} é"
    spans = [(a, b) for a, kind, b, _ in secrets.scan(text, 1 << 20)[1] if kind == 0]
    assert len(spans) == 1 and 2 <= spans[0][0] < spans[0][1] <= len(text) - 2


def test_base64_span_is_that_of_its_own_characters():
    text = b64(b"." * 30 + SECRET.encode() + b"," * 30)
    assert secrets.scan(text, 1 << 20)[1] == [(40, 0, 71, 1)]


CUT = zlib.compressobj()
CUT_OFF = CUT.compress(LONG + "é".encode()[:1]) + CUT.flush(zlib.Z_SYNC_FLUSH)

RAW = {
    "binary": b"\xff\x01" + SECRET.encode() + b"\x00",
    "NUL fields": b"user\0" + SECRET.encode() + b"\0x",
    "Latin-1": "é ".encode("latin-1") + SECRET.encode() + "é".encode("latin-1"),
    "UTF-16": SECRET.encode("utf-16"),
    "UTF-16 LE": SECRET.encode("utf-16-le"),
    "UTF-16 BE": SECRET.encode("utf-16-be"),
    "UTF-16 in binary": b"\x90\x01\x07" + SECRET.encode("utf-16-be") + b"\x91",
    "UTF-16 holding base64": b64(SECRET.encode()).encode("utf-16-le"),
    "base64 in binary": b"\x01\xfe" + b64(SECRET.encode()).encode() + b"\x00",
    "gzip in binary": b"\x01\xfe" + gzip.compress(b"\xfe" + SECRET.encode() + b"\x02") + b"\x00",
    "cut off inside a character": CUT_OFF,
}


@pytest.mark.parametrize("name", RAW)
@pytest.mark.parametrize("wrap", [b64, urllib.parse.quote_from_bytes, lambda d: b64(bz2.compress(d))], ids=["base64", "percent", "bz2"])
def test_decoded_data_need_not_be_text(name, wrap):
    text = f"é {wrap(RAW[name])} é"
    base, decoded, *_ = secrets.scan(text, 1 << 20)
    spans = {(a, b) for a, kind, b, _ in decoded if kind == 0}
    assert spans and all(2 <= a < b <= len(text) - 2 for a, b in spans)


PACKS = [gzip.compress, bz2.compress, lzma.compress, zstandard.compress, zlib.compress]


@pytest.mark.parametrize("pack", PACKS)
@pytest.mark.parametrize("between", [b"", b"\0" * 8])
def test_every_member_is_searched(pack, between):
    for data in (pack(b"first") + between + pack(SECRET.encode()), pack(b"pass") + between + pack(SECRET.encode()[4:]),
                 pack(b"a") + between + gzip.compress(b"b") + bz2.compress(SECRET.encode()), pack(b"first") + between + b"junk " + SECRET.encode()):
        assert {k for _, k, *_ in secrets.scan(f"é {b64(data)} é", 1 << 20)[1]} == {0}


@pytest.mark.parametrize("pack", PACKS)
@pytest.mark.parametrize("place", ["front", "end"])
def test_large_compressed_data_is_searched(pack, place):
    fill = b"line of a log, nothing else\n" * 300_000
    data = pack(SECRET.encode() + b"\n" + fill if place == "front" else fill + SECRET.encode())
    text = f"é {b64(data)} é"
    _, decoded, _, oversize = secrets.scan(text, 1 << 20)
    assert [(k, d) for _, k, _, d in decoded] == [(0, 2)] and oversize >= 1
    assert 2 <= decoded[0][0] < decoded[0][2] <= len(text) - 2


INSIDE = {name: wrap(SECRET).encode() for name, wrap in WRAPS.items()} | RAW | {
    "plain": SECRET.encode(), "blanks": b"password" + b" " * 900 + b"=" + b" " * 900 + b"abcdef", "long value": b"token=" + b"a" * 3000,
    "hex": b"f" * 2000, "access": b"AKIA" + b"B" * 900, "lines": wrapped_at(b64(LONG), 76).encode(), "lines of gzip": wrapped_at(b64(gzip.compress(LONG)), 76, "\r\n").encode(),
    "large in large": gzip.compress(LONG * 3), "members": gzip.compress(b"x" * 3000 + b"pass") + gzip.compress(SECRET.encode()[4:]),
    "run": b64(b"x" * 7000 + SECRET.encode() + b"y" * 3000).encode(), "prefix": b"a/b_" + b64(gzip.compress(LONG)).encode(),
    "dropped": b"password=token:abcdefgh", "short": b"token=abcde", "23": b"f" * 23}


@pytest.mark.parametrize("name", INSIDE)
def test_piece_by_piece_finds_what_the_whole_has(name, monkeypatch):
    for lead in (0, 1, 37, 63, 200):
        text = b64(gzip.compress(b"," * lead + b" " + INSIDE[name] + b" " + b"," * 2000))
        whole = {(a, k, b) for a, k, b, _ in secrets.scan(text, 1 << 30)[1]}
        with monkeypatch.context() as m:
            m.setattr(secrets, "_WHOLE", 256)
            m.setattr(secrets, "_STEP", 64)
            m.setattr(secrets, "_OUT", 100)
            assert {(a, k, b) for a, k, b, _ in secrets.scan(text, 1 << 30)[1]} == whole
    assert bool(whole) == (name not in ("dropped", "short", "23"))


NOISE = b"".join(hashlib.sha512(b"%d" % i).digest() for i in range(40))


@pytest.mark.parametrize("late", [
    b64(NOISE + gzip.compress(NOISE + SECRET.encode())).replace("+", "%2B"),
    "&#112;assword=hunter2hunter2", b64(b"z" * 2000 + b"password%3Dhunter2hunter2"),
    urllib.parse.quote(urllib.parse.quote("password=" + "h" * 30)), b64(b"q" * 900 + b64(b"r" * 900 + b"token%3Dabcdefgh").encode()),
    "\\u0070assword=" + "x" * 30, "AKIA%42" + "B" * 20, "f" * 20 + "%66" * 9,
], ids=["gzip", "html", "base64", "percent twice", "base64 twice", "unicode", "access", "hex"])
def test_an_escape_that_comes_late_is_undone_from_the_start(late, monkeypatch):
    for lead in (0, 65, 700, 3001):
        text = b64(gzip.compress(b"," * lead + b" " + late.encode() + b" " + b"," * 900))
        whole = {(a, k, b) for a, k, b, _ in secrets.scan(text, 1 << 30)[1]}
        assert whole
        with monkeypatch.context() as m:
            m.setattr(secrets, "_WHOLE", 256)
            m.setattr(secrets, "_STEP", 64)
            m.setattr(secrets, "_OUT", 100)
            assert {(a, k, b) for a, k, b, _ in secrets.scan(text, 1 << 30)[1]} == whole


def test_a_layer_over_the_whole_size_keeps_its_late_escapes():
    noise = np.random.default_rng(5).bytes(500_000)
    inner = base64.b64encode(gzip.compress(noise + SECRET.encode()))
    plus = inner.index(b"+", 400_000)
    inner = inner[:plus] + b"%2B" + inner[plus + 1:]
    for pad in (0, 5_000_000):
        found = secrets.scan(b64(gzip.compress(inner + b" " + b"," * pad)), 64 << 20)[1]
        assert {k for _, k, *_ in found} == {0}


def test_memory_of_long_encoded_texts():
    text = b64(np.random.default_rng(6).bytes(1_500_000) + b"\n" + SECRET.encode())
    tracemalloc.start()
    try:
        found = secrets.scan(text, 64 << 20)[1]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert 0 in {k for _, k, *_ in found} and peak < 75 * len(text)


def brute_base(text):
    kinds = [(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 6),
             (r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20), (r"[0-9a-f]+", lambda m: len(m.group()) >= 24)]
    spans = sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(kinds) for m in re.finditer(p, text or "") if ok(m))
    return spans, ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


TEXTS = [None, "", "PassWd : 'abcdef'", "token=abc", "api_key=\"abcdefg\" APIKEY:zzzzzz", "password=token:abcdefgh", "ſecret=abcdefgh", "toKen=abcdefgh",
         "AKIA" + "A" * 16 + " AKIA" + "B" * 15, "f" * 23 + "g" + "a" * 24, "é" * 50 + "secret=0123456789abcdef0123456789abcdef", "x " * 100000 + SECRET, f"{SECRET} {SECRET}",
         "\n".join(w(SECRET) for w in WRAPS.values())]


def test_secrets_query_columns(spark, tmp_path, empty):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, SECRET, "x"), (3, TEXTS[3], "x")], "doc_id long, text string, spans string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op2_secrets(spark, str(tmp_path)).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = TEXTS[r.doc_id] if r.doc_id is not None else SECRET
        spans, listed = brute_base(text)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, x, _ in spans) for k in range(3))
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
    assert secrets.secrets(empty).count() == 0


@pytest.fixture(scope="module")
def tokens():
    return public_tokenizers.path("piece_bpe_32k.model")


def test_token_counts(docs, rows, empty, tokens):
    sp, _ = token_counts._model(tokens)
    want = Counter((i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 100) for i, t, *_ in rows)
    assert Counter(tuple(r) for r in token_counts.token_counts(docs, tokens, 100).collect()) == want
    assert token_counts.token_counts(empty, tokens, 100).count() == 0


def test_whole_tokens_are_proven_one_by_one(tokens):
    sp, _ = token_counts._model(tokens)
    whole = token_counts.whole_tokens(tokens)
    assert len(whole) > 10000 and all(len(sp.encode(w)) == 1 for w in whole[::97])


def labelled(spark, n=400):
    stem = ["lowei", "lostra"]
    docs = [(i, f"die und{' gut' * (i % 7)} {stem[i % 2]}{i % 13} haus {i}" if i % 8 == 0 else f"die und{' gut' * (i % 9)} haus baum {i}") for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "baum " * 200000), (n + 3, "baum " * 20000 + " loweiab"), (None, "haus")]
    return spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string"), \
        spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(n)] + [(5, None), (None, 1), (n + 999, 0)], "doc_id long, label int")


def test_toxicity(spark, empty):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == 405
    assert all(r.held_out == (i is None or zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    right = [got[i].predicted == (i % 8 == 0) for i in range(400) if got[i].held_out]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert [got[i].predicted for i in (400, 401, 402, 403)] == [0, 0, 0, 1]
    clean = toxicity.drop_toxic(docs, model)
    assert clean.columns == docs.columns and clean.count() == sum(1 - r.predicted for r in got.values())
    assert toxicity.score(empty, model).count() == 0


def test_toxicity_never_learns_from_held_out_labels(spark):
    docs, labels = labelled(spark)
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - label else label end as label")
    a, b = (toxicity.fit(docs.select("doc_id", "text"), x) for x in (labels, flipped))
    assert a.hashes.tolist() == b.hashes.tolist() and abs(a.weights - b.weights).max() < 1e-6


def test_toxicity_without_both_classes(spark):
    docs, labels = labelled(spark)
    for rows, low in (("label = 0", True), ("label = 1", False), ("false", True)):
        model = toxicity.fit(docs.select("doc_id", "text"), labels.where(rows))
        assert (toxicity.score_text("haus", model) < 0.5) == low
