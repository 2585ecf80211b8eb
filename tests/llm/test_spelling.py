"""Spelling variants against a plain comparison of all words."""

from __future__ import annotations

import random
import re
import sys
import zlib
from collections import Counter
from itertools import combinations
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from cases import WORDS, awkward, documents, empty  # noqa: E402

from emberline.llm import spelling  # noqa: E402


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows, letters=6, least=5, ratio=5):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= letters and c >= least}
    near = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def found(df, **how):
    rows = [tuple(r) for r in spelling.variants(df, **how).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def variant(word, draw, letters):
    i, kind = draw.randrange(len(word)), draw.choice("idr")
    return word[:i] + ("" if kind == "d" else draw.choice(letters)) + word[i + (kind != "i"):]


@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnopqrstuvwxyzéßÿÉ"])
def test_variants(spark, letters):
    draw = random.Random(len(letters))
    rows = awkward(WORDS)
    stems = ["".join(draw.choice(letters) for _ in range(draw.randint(5, 9))) for _ in range(40)]
    pool = [w for s in stems for w in [s] * 130 + [variant(s, draw, letters)] * 20 + [variant(variant(s, draw, letters), draw, letters)] * 5 + [s.upper()] * 2]
    pool += ["aaaaaa"] * 6 + ["aaaaaaa"] * 40 + ["aaaaaaaaaaaaaaaaaaaaaaaa"] * 9 + ["aaaaaaaaaaaaaaaaaaaaaaab"] * 50 + ["abababab"] * 5 + ["babababa"] * 5
    draw.shuffle(pool)
    rows += [(500 + i, " ".join(pool[i::60])) for i in range(60)]
    rows += [(None, "garbled garbling"), (77, "x×y÷zzzz " * 6), (77, "x×y÷zzzz " * 6)]
    want = plain(rows)
    got = found(documents(spark, rows).repartition(6))
    assert got == want
    assert any(n_near > 1 for *_, n_near, _ in got)


def test_every_single_edit_is_found(spark):
    base = "spelling"
    edits = {base[:i] + c + base[i + k:] for i in range(len(base) + 1) for c in ("", "x", "l") for k in (0, 1)} - {base}
    words = spark.createDataFrame([(w,) for w in sorted(edits | {base})], "word string")
    pairs = {(r["a"], r["b"]) for r in spelling.near_words(words).collect()}
    assert pairs == {(a, b) for a, b in combinations(sorted(edits | {base}), 2) if one_edit(a, b)}


def test_pivots_are_the_cheapest_disjoint_pair():
    draw = random.Random(1)
    for _ in range(500):
        places = draw.sample(range(12), 3)
        costs = [draw.randint(1, 9) for _ in places]
        chosen = spelling.pivots(places, costs)
        cost = dict(zip(places, costs, strict=True))
        pairs = [(cost[a] + cost[b]) for a, b in combinations(places, 2) if abs(a - b) >= 2]
        assert len(chosen) == 2 and abs(chosen[0] - chosen[1]) >= 2 and sum(cost[p] for p in chosen) == min(pairs)


def test_long_chains(spark):
    chain = ["abcdefgh", "abcdefg", "xabcdefg", "xabcdef", "xyabcdef"]
    rows = [(i, (w + " ") * 5**(k + 1)) for i, (k, w) in enumerate(enumerate(chain))]
    got = found(documents(spark, rows))
    assert got == plain(rows)


def test_no_words(spark):
    assert found(empty(spark)) == set()
    assert found(documents(spark, [(1, None), (2, "a b c"), (3, "12345 !!")])) == set()
