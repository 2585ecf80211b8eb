"""Operators on documents, each against a plain Python version."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

from cases import WORDS, awkward, documents, empty  # noqa: E402

from emberline.llm import contamination, language_model, packing, repeats, simhash, token_counts  # noqa: E402

BYTES, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(5)
    passage = " ".join(draw.choice(WORDS) + draw.choice("abcdef") for _ in range(60))
    rows = awkward(WORDS)
    for i in range(100, 160):
        words = [draw.choice(WORDS) + draw.choice("xyzuvw") + draw.choice("klmno") for _ in range(draw.randint(1, 120))]
        if i % 4 == 0:
            words[len(words) // 2:len(words) // 2] = passage.split()
        rows.append((i, " ".join(words)))
    rows += [(200 + i, rows[-1 - i % 3][1] + (" tail" if i % 2 else "")) for i in range(12)]
    return documents(spark, rows).cache()


def collected(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def plain(docs):
    return [(r["doc_id"], (r["text"] or "").encode()) for r in docs.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


# ---- token counts


def test_token_counts(docs):
    library = Tokenizer.from_file(BYTES)
    want = [(i, len(t), n := len(library.encode(t.decode(), add_special_tokens=False).ids), n > 512) for i, t in plain(docs)]
    assert collected(token_counts.token_counts(docs, BYTES), "doc_id", "n_bytes", "n_tokens", "over_limit") == ordered(want)


def test_token_counts_of_any_white_space():
    own, library, draw = token_counts.counter(BYTES), Tokenizer.from_file(BYTES), random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "'s", "don't", "12", "é", "<|endoftext|>", "%$", "the", "\xa0", "　", "日本", "\r\n", "\x1c", "\x85"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))
        assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


# ---- packing


def test_packing_holds_every_token_once(docs):
    library = Tokenizer.from_file(WORD)
    want = ordered((i, tuple(library.encode(t.decode(), add_special_tokens=False).ids + [2])) for i, t in plain(docs))
    rows = packing.pack_documents(docs, WORD).collect()
    by_sequence, sizes = {}, Counter()
    pieces = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        sizes[r["doc_id"], r["doc_tokens"]] += r["length"]
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"], r["ids_crc32"]))
    for members in by_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
    totals = Counter((i, len(ids)) for i, ids in want)
    assert sizes == {k: k[1] * n for k, n in totals.items()}
    for i, ids in want:
        found = sorted(set(pieces[i, len(ids)]))
        assert [s for s, _, _ in found] == list(np.cumsum([0, *(n for _, n, _ in found)])[:-1])
        for start, length, crc in found:
            assert crc == zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())


def test_packing_wastes_little():
    draw = random.Random(2)
    pieces = [(d, 0, draw.randint(1, 512)) for d in range(4000)]
    sequences = list(packing.pack(pieces, 4096))
    assert sorted(p for s in sequences for p in s)[0][0] == 0
    assert sum(p[2] for s in sequences for p in s) == sum(p[2] for p in pieces)
    sizes = [sum(p[2] for p in s) for s in sequences]
    assert max(sizes) <= 4096
    assert sum(4096 - n for n in sizes if n & (n - 1)) < 0.01 * sum(sizes)


def test_differencing_is_near_equal():
    draw = random.Random(3)
    sizes = [draw.randint(1, 300) for _ in range(500)]
    windows = packing.difference(sizes, 20)
    assert sorted(i for w in windows for i in w) == list(range(500))
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert max(sums) - min(sums) <= 3
    assert packing.difference([], 4) == [] and packing.difference([5], 1) == [[0]]


# ---- decontamination


def test_decontamination(spark, docs):
    texts = dict(plain(docs))
    items = [("a", " ".join(texts[104].decode().split()[3:20])), ("b", "two words"), ("c", None), ("d", "..."), ("b2", "Two, words!"),
             (None, "only"), ("e", texts[6].decode()[1000:1200]), ("long", " ".join(texts[100].decode().split()[:14]) + " zz")]
    items = spark.createDataFrame(items, "item_id string, text string")
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for r in items.collect():
        words = word.findall((r["text"] or "").encode().lower())
        for k in range(max(1, len(words) - 9)) if words else ():
            windows.setdefault(tuple(words[k:k + 10]), set()).add(r["item_id"])
    want = []
    for i, t in plain(docs):
        words, hit, found = word.findall(t.lower()), set(), set()
        for k in range(len(words)):
            for n in {len(w) for w in windows}:
                owners = windows.get(tuple(words[k:k + n]))
                if owners and k + n <= len(words):
                    hit.update(range(k, k + n))
                    found |= owners
        found = sorted(found - {None})
        want.append((i, len(words), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert collected(contamination.report(docs, items), *names) == ordered(want)
    assert sum(w[5] for w in want) > 5


def test_repeated_items_stay_in_one_block(spark, docs, monkeypatch):
    read = []
    parts_for = contamination.parts_for
    monkeypatch.setattr(contamination, "parts_for", lambda size, most: read.append(size) or parts_for(size, most))
    items = spark.createDataFrame([("a", "seven words of a test item here"), (None, "two words"), ("n", None), ("e", "")], "item_id string, text string")
    many = items.crossJoin(spark.range(50)).drop("id")
    first, second = (collected(contamination.report(docs, i), "doc_id", "n_hit", "items_sha256") for i in (items, many))
    assert first == second and read == [40, 40]


def test_decontamination_in_blocks_and_cutting(spark, docs, monkeypatch):
    items = docs.where("doc_id in (104, 108, 112)").select(F.col("doc_id").cast("string").alias("item_id"), "text")
    whole = collected(contamination.report(docs, items), "doc_id", "n_hit", "items_sha256")
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 400)
    assert collected(contamination.report(docs, items), "doc_id", "n_hit", "items_sha256") == whole
    small = documents(spark, [(1, "One two, three four. FIVE six - seven!"), (2, "three FOUR five"), (3, None), (4, "nothing")])
    tests = spark.createDataFrame([(1, "Three four five")], "item_id long, text string")
    cut = contamination.decontaminate(small, tests)
    assert collected(cut, "doc_id", "text") == [(1, "One two,  six - seven!"), (3, None), (4, "nothing")]
    assert cut.columns == small.columns


# ---- SimHash


def components(ids, near):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in near:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def reference_print(text: bytes, n: int) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.lower())
    shingles = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def test_simhash(docs):
    rows = [(i, reference_print(t, 3)) for i, t in plain(docs)]
    known = [r for r in rows if r[0] is not None]
    root = components([i for i, _ in known], [(a, b) for a, x in known for b, y in known if (x ^ y).bit_count() <= 2])
    got = collected(simhash.near_duplicates(docs, words=3, budget=2).withColumn("fp", F.lower(F.hex("fp"))), "doc_id", "fp", "component_id")
    assert got == ordered((i, f"{x:016x}", root.get(i)) for i, x in rows)
    assert root[9] == 8 and root[2] == root[3] == 1


def test_crowded_bundles_lose_no_link(docs, monkeypatch):
    want = collected(simhash.near_duplicates(docs, words=3, budget=2), "doc_id", "component_id")
    monkeypatch.setattr(simhash, "CROWDED_ROWS", 8)
    assert collected(simhash.near_duplicates(docs, words=3, budget=2), "doc_id", "component_id") == want


@pytest.mark.parametrize("frontier", [64, 1 << 20])
def test_trie_join_is_complete(frontier, monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", frontier)
    draw = np.random.default_rng(1)
    flips = np.uint64(1) << draw.integers(0, 64, (2, 1500)).astype(np.uint64)
    prints = np.unique(draw.integers(0, 2**63, 25, dtype=np.uint64)[draw.integers(0, 25, 1500)] ^ flips[0] ^ flips[1])
    keys = prints.astype(">u8").view(np.uint8).reshape(-1, 8)
    orders, prefix = simhash.exact_plan(64, 2)
    got = set()
    for order in orders:
        turned = np.packbits(np.unpackbits(keys, axis=1)[:, order], axis=1)
        by = np.argsort(np.ascontiguousarray(turned).view("S8").ravel(), kind="stable")
        for a, b in zip(*simhash.trie_pairs(turned[by], prefix, 2), strict=True):
            got.add((min(by[a], by[b]), max(by[a], by[b])))
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= 2
    assert got == {(a, b) for a, b in zip(*np.nonzero(near), strict=True) if a < b}


def test_one_of_each_group_is_kept(spark):
    """Groups of copies that differ in a word or two of many, chains included, and one of several hundred copies."""
    draw = random.Random(9)
    word = lambda: draw.choice(WORDS) + draw.choice("abcde") + draw.choice("fghij")
    rows = []
    for g in range(20):
        words = [word() for _ in range(draw.choice([40, 400, 1500]))]
        rows.append((1000 * g, " ".join(words)))
        for c in range(1, 400 if g == 7 else 8):
            own = list(words)
            own[draw.randrange(len(own))] = word()
            rows.append((1000 * g + c, " ".join(own)))
            words = own if g % 2 else words
    rows += [(50_000, None), (50_001, ""), (None, ""), (None, rows[0][1])]
    prints = [(i, reference_print((t or "").encode(), 3)) for i, t in rows if i is not None]
    smallest = components([i for i, _ in prints], [(a, b) for a, x in prints for b, y in prints if (x ^ y).bit_count() <= 2])
    kept = simhash.deduplicated(documents(spark, rows)).select("doc_id").collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(i for i, root in smallest.items() if i == root)
    assert sum(r["doc_id"] is None for r in kept) == 2
    assert len(set(smallest.values())) < len(smallest) - 100


# ---- repeated strings


def reference_repeats(rows, length=50):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for p in range(len(t) - length + 1):
            first.setdefault(t[p:p + length], i)
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        if i is not None:
            for p in range(len(t) - length + 1):
                if first[t[p:p + length]] < i:
                    gone[p:p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return ordered(out)


@pytest.mark.parametrize("part_bytes", [8 << 20, 5000])
def test_repeats(docs, part_bytes, monkeypatch):
    monkeypatch.setattr(repeats, "PART_BYTES", part_bytes)
    want = reference_repeats(plain(docs))
    assert collected(repeats.report(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert sum(w[2] > 0 for w in want) > 10


def test_repeats_with_many_sources_for_a_place(spark):
    draw = random.Random(4)
    base = "".join(draw.choice("ab") for _ in range(400))
    rows = [(i, base[draw.randint(0, 200):][:draw.randint(40, 200)] + draw.choice("xyz") * draw.randint(0, 90)) for i in range(80)]
    rows += [(i + 7, t) for i, t in rows[:20]]
    want = reference_repeats([(i, t.encode()) for i, t in rows])
    assert collected(repeats.report(documents(spark, rows)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_passages_are_cut(spark):
    passage = "é" * 150
    docs = documents(spark, [(1, "first " + passage + " end"), (2, "second " + passage + " other"), (3, None), (4, "x" * 60), (5, "x" * 60)])
    cut = repeats.deduplicated(docs)
    assert cut.columns == docs.columns
    got = dict(collected(cut, "doc_id", "text"))
    assert got[1] == "first " + passage + " end" and got[2] == "secondother" and got[3] is None and got[5] == "x" * 60


# ---- language model


def test_language_model(docs):
    rows = plain(docs)
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    words = {t: [*t.lower().split(), b""] for _, t in rows}
    counts = Counter(w for i, t in rows if not held[i] for w in words[t])
    n, v = sum(counts.values()), len(counts)
    got = language_model.score(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2).collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["n_tokens"]): r for r in got}
    for i, t in rows:
        r, own = by[i, len(words[t])], words[t]
        assert (r["held_out"], r["n_known"], r["train_tokens"]) == (held[i], sum(counts[w] > 0 for w in own), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
        assert r["score"] < 0 and math.isfinite(r["score"])


def test_language_model_is_a_distribution():
    """Over all words and one unseen word of each rare class, the next-word probabilities sum to one."""
    draw = random.Random(6)
    counts = Counter({(draw.choice(WORDS) + str(i)).encode(): 1 + 4000 // (i + 1) for i in range(900)})
    kept = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    total, number = np.zeros(language_model.RARE_CLASSES), np.zeros(language_model.RARE_CLASSES)
    for w, n in kept[language_model.FREQUENT:]:
        total[language_model.rare_class(w)] += n
        number[language_model.rare_class(w)] += 1
    trainer = language_model.Trainer(language_model.starting_weights(kept, total))
    words = language_model.Words(kept)
    text = [draw.choice(kept)[0] for _ in range(500)]
    trainer.learn(words.numbers([text])[1], [500])
    ids = words.id[:len(kept)].tolist() + list(range(language_model.FREQUENT, language_model.BEFORE))
    before = words.numbers([text[:2]])[1].tolist()
    flat = np.array([x for i in ids for x in (*before, i)], np.int32)
    model = np.exp(language_model.log_probabilities(trainer.weights, flat, [3] * len(ids))[2::3])
    rare = np.array(ids) - language_model.FREQUENT
    count = np.array([n for _, n in kept] + [0] * language_model.RARE_CLASSES)
    share = np.where(rare < 0, 1.0, (count + 1) / (total + number + 1)[np.maximum(rare, 0)])
    assert (model * share).sum() == pytest.approx(1, abs=1e-4)


def test_language_model_learns_context(spark):
    draw = random.Random(8)
    rows = []
    for i in range(300):
        own = WORDS[:12] if i % 2 else WORDS[12:]
        rows.append((i, " ".join(draw.choice(own) for _ in range(80))))
    got = language_model.score(documents(spark, rows), F.col("doc_id") % 5 == 0).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.94 * got[1]


# ---- empty tables


def test_empty_tables(spark):
    none = empty(spark)
    items = spark.createDataFrame([], "item_id string, text string")
    one = documents(spark, [(1, "some words here")])
    for df in (
        token_counts.token_counts(none, BYTES), packing.pack_documents(none, WORD), contamination.report(none, items),
        simhash.near_duplicates(none), simhash.deduplicated(none), repeats.report(none),
        language_model.score(none, F.lit(False)),
    ):
        assert df.collect() == []
    assert contamination.report(one, items).first()["contaminated"] is False
    assert language_model.score(one, F.lit(True)).first()["train_tokens"] == 0
