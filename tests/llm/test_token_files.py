"""Wavelet matrices and token files, against plain arrays and the tokenizers library."""

from __future__ import annotations

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

from cases import WORDS, awkward, documents, empty  # noqa: E402

from emberline.llm import token_files  # noqa: E402
from emberline.llm.common import shared_path  # noqa: E402
from emberline.llm.wavelet import WaveletMatrix, encode  # noqa: E402
from emberline.llm.word_ids import WordIds  # noqa: E402

WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 40_000, 100_001])
@pytest.mark.parametrize("kind", ["zipf", "one"])
def test_wavelet_matrix(n, kind):
    draw = np.random.default_rng(n)
    tokens = (draw.zipf(1.3, n) % 49408 if kind == "zipf" else np.full(n, 5)).astype("<u2")
    starts = np.array([0, n // 3, n])
    matrix = WaveletMatrix(encode(tokens, np.array([9, 0]), np.array([False, True]), starts, 3, 4) + b"\n")
    assert (matrix.group, matrix.number, matrix.size) == (3, 4, n)
    assert matrix.doc_ids.tolist() == [9, 0] and matrix.missing.tolist() == [False, True] and (matrix.starts == starts).all()
    assert (matrix.tokens() == tokens).all()
    if not n:
        return
    places = draw.integers(0, n, 300)
    assert (matrix.access(places) == tokens[places]).all()
    with pytest.raises(IndexError):
        matrix.access([n])
    for token in {*tokens[:20].tolist(), 0, 49407, 65535}:
        found = np.flatnonzero(tokens == token)
        assert (matrix.occurrences(token) == found).all() and matrix.count(token) == len(found)
        assert matrix.count(token, n // 4, n // 2) == ((found >= n // 4) & (found < n // 2)).sum()
        if len(found):
            assert matrix.select(token, len(found) // 2) == found[len(found) // 2]
            assert matrix.rank(token, int(found[-1])) == len(found) - 1


def encoded(own, texts):
    ids, borders = own.encode(pa.array([t.encode() for t in texts], pa.binary()), 2)
    return [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:], strict=True)]


def test_identifiers_are_those_of_the_library():
    own, library, draw = WordIds(WORD), Tokenizer.from_file(WORD), random.Random(4)
    parts = ["a", "B", "s", "'s", "'T", "'re", "don", "'", "12", "é", "É", "ß", "×", "ÿ", "-", "--", "<|endoftext|>", "<|EndOfText|>", "Ünder", "größe).", "d.),", "<|", "日", "Σ", "ﬁ",
             "́", "Ł", "ª", "²", " ", "  ", "\n", "\x85", "\xa0", "\x1c", "e" * 40, "xy" * 90, "ing", "tion", "the"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(3000)]
    for text, ids in zip(texts, encoded(own, texts), strict=True):
        assert ids == [*library.encode(text, add_special_tokens=False).ids, 2], repr(text)


def test_the_cache_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr("emberline.llm.word_ids.CACHED_WORDS", 5)
    own, library = WordIds(WORD), Tokenizer.from_file(WORD)
    for text in ("one two three four", "five six seven", "one two", "eight nine ten", "one three five"):
        assert encoded(own, [text]) == [[*library.encode(text).ids, 2]]


def rows_of(docs):
    library = Tokenizer.from_file(WORD)
    return [(r["doc_id"], [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2]) for r in docs.collect()]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(6)
    rows = awkward(WORDS) + [(None, "another row without an id")] + [(50, "hot " * (i % 7)) for i in range(200)]
    rows += [(draw.randint(-9, 10**12), " ".join(draw.choice(WORDS) for _ in range(draw.randint(0, 60)))) for _ in range(300)]
    return documents(spark, rows).repartition(5).cache()


@pytest.mark.parametrize("shard", [100, 1 << 22])
def test_token_documents(docs, shard):
    want = rows_of(docs)
    found = token_files.token_documents(docs, WORD, shard_tokens=shard).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found), key=key) == sorted(
        ((i, len(ids), crc(ids)) for i, ids in want), key=key)
    at, last = 0, None
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == at and (last is None or r["doc_id"] >= last)
        at, last = at + r["n_tokens"], r["doc_id"]
    assert at == sum(len(ids) for _, ids in want)


def test_a_hot_identifier_shares_out(spark, docs):
    token_files.write_token_files(docs, path := shared_path(spark, "t"), WORD)
    hot = token_files.stored_documents(token_files.token_files(spark, path)).where("doc_id = 50")
    assert hot.select("group").distinct().count() > 1


def test_lookups_from_files(spark, docs):
    token_files.write_token_files(docs, path := shared_path(spark, "t"), WORD, shard_tokens=500)
    files = token_files.token_files(spark, path)
    want = rows_of(docs)
    token = Tokenizer.from_file(WORD).encode("have").ids[0]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    found = [(r["doc_id"], r["at"]) for r in token_files.token_occurrences(files, token).collect()]
    assert sorted(found, key=key) == sorted(((i, p) for i, ids in want for p, x in enumerate(ids) if x == token), key=key)
    counts = {r["token"]: r["n"] for r in token_files.token_frequencies(files, [2, token, 49405]).collect()}
    assert counts == {t: sum(ids.count(t) for _, ids in want) for t in (2, token, 49405)}


def test_no_documents(spark):
    assert token_files.token_documents(empty(spark), WORD).collect() == []
