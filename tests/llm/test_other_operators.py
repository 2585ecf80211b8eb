"""Search, licences, archives, quality and the whole pipeline, each against a plain Python version."""

from __future__ import annotations

import base64
import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import oracle
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from cases import WORDS, awkward, documents, empty  # noqa: E402

import corpus_pipeline  # noqa: E402
from emberline.llm import archives, licenses, neighbours, quality, queries  # noqa: E402

VECTORS = "vec_id long, embedding array<float>, label int, block string, v string"


# ---- neighbours


def exact_neighbours(rows, asked, k):
    out = {}
    for q, x in rows:
        if asked(q):
            near = sorted((float(np.sqrt(((np.array(y, np.float64) - np.array(x, np.float64))**2).sum())), i)
                          for i, y in rows if i != q and len(y) == len(x))
            out[q] = near[:k]
    return out


def test_neighbours_find_nine_in_ten(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 400)
    draw = np.random.default_rng(2)
    centres = draw.standard_normal((12, 16))
    rows = [(i, (centres[i % 12] + 0.4 * draw.standard_normal(16)).astype(np.float32).tolist()) for i in range(1500)]
    df = spark.createDataFrame([(i, v, 0, "b", "v") for i, v in rows], VECTORS)
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["score"], r["vec_id"])
    want = exact_neighbours(rows, lambda i: i % 50 == 0, 10)
    assert set(got) == set(want)
    hits = sum(len({x for _, x in got[q].values()} & {x for _, x in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q, found in got.items():
        assert sorted(found) == list(range(1, 11)) and [found[r] for r in sorted(found)] == sorted(found.values())
        own = dict(rows)
        assert all(s == pytest.approx(float(np.linalg.norm(np.array(own[q], np.float32).astype(float) - np.array(own[i], np.float32).astype(float)))) for s, i in found.values())


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.0]), (200, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (300, [5.0, 5.0, 5.0]), (9, [])]
    df = spark.createDataFrame([(i, v, 0, "b", "v") for i, v in rows], VECTORS)
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0, 3).collect())
    assert got == [(100, 1, 1), (100, 2, 1), (100, 3, 200), (200, 1, 1), (200, 2, 1), (200, 3, 100), (300, 1, 8)]  # every row is a candidate
    assert neighbours.nearest(df.limit(0), F.lit(True)).collect() == []
    assert neighbours.nearest(df.where("vec_id = 100"), F.lit(True)).collect() == []


def test_neighbours_of_rows_that_repeat_an_id(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 4)
    rows = [(1, [1.1, 0.0]), (1, [9.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (100, [1.0, 0.0]), (100, [1.0, 0.0]), (100, [8.0, 0.0]), (200, [3.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0, "b", "v") for i, v in rows], VECTORS)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 4)) for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0, 3).collect())
    want = []
    for n, (q, x) in enumerate(rows):
        if q % 100 == 0:
            near = sorted((round(abs(x[0] - y[0]), 4), i) for m, (i, y) in enumerate(rows) if m != n)[:3]
            want += [(q, rank, i, d) for rank, (d, i) in enumerate(near, 1)]
    assert got == sorted(want)


def test_a_vector_that_is_a_third_of_all(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    draw = np.random.default_rng(5)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else draw.standard_normal(3).astype(np.float32).tolist()) for i in range(300)]
    df = spark.createDataFrame([(i, v, 0, "b", "v") for i, v in rows], VECTORS)
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 30 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q, found in got.items():
        assert [x[1] for x in sorted(found)] == [i for i in range(0, 33, 3) if i != q][:10] and all(x[2] == 0 for x in found)


# ---- licences


def test_licences_against_sql(spark, small):
    sql = queries.ORACLES["op6_licenses"]
    assert oracle.difference(oracle.spark_rows(queries.op6_licenses(spark, small)), oracle.duck_rows(oracle.connect(small), sql)) is None


def test_licence_of_the_nearest_directory(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [("LICENSE", mit), ("a/x.py", "code"), ("a/b/COPYING", "preface\n" + gpl), ("a/b/c/y.py", "code"), ("a/bb/z.py", None),
            ("a/b/own.py", "# Licensed under CC BY-NC 4.0."), ("a/b/c/d/", ""), (None, "words"), ("a/notes", "the mit license of released works under review here")]
    files = spark.createDataFrame([(i, p, t, "x", 0) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string, licence string, n_notices int")
    got = {r["doc_id"]: (r["licence"], r["origin"]) for r in licenses.scan(files, F.col("path")).collect()}
    assert got == {0: ("MIT", "LICENSE"), 1: ("MIT", "LICENSE"), 2: ("GPL-3.0", "a/b/COPYING"), 3: ("GPL-3.0", "a/b/COPYING"), 4: ("MIT", "LICENSE"),
                   5: ("CC-BY-NC-4.0", "a/b/own.py"), 6: ("GPL-3.0", "a/b/COPYING"), 7: (None, None), 8: ("MIT", "LICENSE")}
    assert licenses.scan(files.limit(0), F.col("path")).collect() == []


MIT_FILE = """MIT License

Copyright (c) 2024 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.
"""
APACHE_HEADER = """#!/bin/sh
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
echo done
"""


def test_licence_files_headers_and_tags(spark):
    rows = [("m/LICENSE", MIT_FILE), ("m/a.py", "x = 1"), ("p/run.sh", APACHE_HEADER), ("q/a.c", "// SPDX-License-Identifier: GPL-2.0\nint x;"),
            ("r/readme", "This project is released under the MIT License."), ("r/b", "This file is licensed under the Apache License, Version 2.0.\n" + "word " * 30000),
            ("s/LICENSE", f"{licenses.BSD_TERMS}\n\n{licenses.BSD_REST}"), ("s/t/LICENSE", f"{licenses.BSD_TERMS}\n3. {licenses.BSD_NAMES}\n\n{licenses.BSD_REST}"),
            ("r/c", "You need a license to drive.\nNo permission is given here."), ("r/d", "word " * 30000 + "\n \n* Licensed under the MIT License.\n\nend")]
    files = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string")
    got = {r["doc_id"]: r for r in licenses.scan(files, F.col("path")).collect()}
    assert [got[i]["licence"] for i in range(10)] == ["MIT", "MIT", "Apache-2.0", "GPL-2.0", "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", None, "MIT"]
    assert got[1]["origin"] == "m/LICENSE" and got[0]["n_notices"] == 3  # heading, terms, whole file
    # the same answers among many more texts
    many = files.union(spark.range(10, 400).selectExpr("id", "'z/' || id", "'This license is the license of version ' || id"))
    assert {r["doc_id"]: r for r in licenses.scan(many, F.col("path")).collect() if r["doc_id"] < 10} == got


def test_documents_speak_from_header_and_footer(spark, small):
    rows = queries.op6_licenses(spark, small).collect()
    own = {r["path"]: r["licence"] for r in rows if r["origin"] == r["path"] and r["origin"] is not None}
    heirs = [r for r in rows if r["origin"] not in (None, r["path"])]
    assert own and heirs and all(r["licence"] == own[r["origin"]] and r["n_notices"] == 0 for r in heirs)


def test_licence_scan_is_native(spark, small):
    plan = queries.op6_licenses(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# ---- archives


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(archives, "ARCHIVE_BYTES", 2000)
    draw = random.Random(3)
    rows = [(i, f"http://h{i % 3}.example/p q/{i}\n", draw.choice(["", "same", "WARC/1.1\r\n\r\nx", "é" * draw.randint(1, 400), f"page {i}\n\n"])) for i in range(60)]
    rows += [(60, None, None), (None, "http://x", "same"), (61, "ftp://y", "same"), (3, rows[3][1], rows[3][2])]
    pages = spark.createDataFrame([(*r, "k", 1) for r in rows], "page_id long, url string, html string, key string, size int")
    best = {}
    for i, _, h in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)

    def want(i, h):
        data = (h or "").encode()
        whole = i is not None and best[h or ""] == i
        return (i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if whole else "revisit", None if whole else best[h or ""])

    got = [tuple(r) for r in archives.convert_pages(pages).select("key", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(map(str, got)) == sorted(str(want(i, h)) for i, _, h in rows)
    long = [tuple(r) for r in archives.convert_pages(pages, least_bytes=5).select("key", "payload_bytes", "record_type").collect()]
    assert all(kind == "response" for _, n, kind in long if n < 5)
    assert archives.convert_pages(pages.limit(0)).collect() == []


def test_arc_versions_and_broken_archives():
    for version in (b"1", b"2"):
        body = b"HTTP/1.1 200 OK\r\nX-Record-Key: 7\r\n\r\n" + bytes(range(256))
        data = archives.arc_version_block(version, b"a.arc", b"20010203040506") + archives.arc_record(
            version, b"a.arc", 9, b"http://e/ x", b"1.2.3.4", b"20010203040506", b"text/html", body) + archives.arc_record(
            version, b"a.arc", 9, b"dns:e", b"1.2.3.4", b"20010203", b"text/dns", b"20010203 e")
        records = list(archives.read_arc(data))
        assert [r["url"] for r in records] == [b"http://e/ x", b"dns:e"] and records[0]["body"] == body
        warc = list(archives.read_warc(b"".join(archives.converted(r, None) for r in records)))
        assert [r["warc-type"] for r in warc] == [b"response", b"resource"]
        assert warc[0]["warc-date"] == b"2001-02-03T04:05:06Z" and warc[1]["warc-date"] == b"2001-02-03T00:00:00Z"
        assert warc[0]["body"] == body and warc[0]["warc-record-key"] == b"7" and warc[0]["warc-ip-address"] == b"1.2.3.4"
        assert archives.converted(records[0], None) == archives.converted(records[0], None)
        revisit = next(archives.read_warc(archives.converted(records[0], 9)))
        assert revisit["warc-type"] == b"revisit" and revisit["body"].endswith(b"\r\n\r\n") and revisit["warc-refers-to-key"] == b"9"
        with pytest.raises(ValueError):
            list(archives.read_arc(data[:-9]))
    with pytest.raises(ValueError):
        list(archives.read_arc(b"http://no/version 1 2 3 0\n"))


# ---- quality


def labelled(spark):
    draw = random.Random(7)
    rows, labels = awkward(WORDS), []
    for i in range(1000, 1900):
        words = [draw.choice(WORDS) + draw.choice(WORDS) for _ in range(draw.randint(30, 90))]
        kind = i % 6
        if kind == 0:
            words = [w.upper() + "!!" for w in words]
        if kind == 1:
            for _ in range(5):
                words[draw.randrange(len(words))] = draw.choice(["vile", "nasty", "awful", "horrid"])
        rows.append((i, " ".join(words)))
        if i % 2 == 0 or kind < 2:
            labels.append((i, int(kind != 0), int(kind == 1), "x"))
    labels += [(None, 0, 1, "x"), (1000, None, None, "x"), (1006, 1, 0, "x"), (77, 1, 1, "x")]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


def test_quality(spark):
    docs, labels = labelled(spark)
    rows = quality.classify(docs, labels, F.col("source"), F.col("lang")).collect()
    assert len(rows) == docs.count()
    judged = [r for r in rows if r["doc_id"] is not None and r["doc_id"] >= 1000]
    right = sum(r["rejected"] == (r["doc_id"] % 6 in (0, 1)) for r in judged)
    assert right >= 0.98 * len(judged)
    good = {r["doc_id"] for r in judged if r["doc_id"] % 6 > 1}
    kept = quality.accepted(docs, labels, F.col("source"), F.col("lang"))
    assert kept.columns == docs.columns
    assert len(good & {r["doc_id"] for r in kept.select("doc_id").collect()}) >= 0.99 * len(good)


def test_quality_without_labels_rejects_nothing(spark):
    docs, labels = labelled(spark)
    found = quality.classify(docs, labels.limit(0), F.col("source"), F.lit(None).cast("string"))
    assert found.where("rejected").count() == 0 and found.count() == docs.count()
    assert quality.classify(docs.limit(0), labels, F.col("source"), F.col("lang")).collect() == []


def test_sparse_sites_stay_near_what_is_above_them(spark):
    rows = [("h1", "p1", 20.0)] * 40 + [("h1", "p2", -20.0)] + [("h2", "p1", -20.0)] * 400 + [(None, None, 0.0)]
    scored = spark.createDataFrame([(h, p, e, 0.0) for h, p, e in rows], "host string, path string, e_low double, e_toxic double")
    sites = {(r["host"], r["path"]): r for r in quality.site_rates(scored, {"low": 0.1, "toxic": 0.1}, 50.0).collect()}
    host = (40 + 5) / (41 + 50)
    assert sites["h1", "p1"]["host_low"] == pytest.approx(host, abs=1e-3)
    assert sites["h1", "p2"]["path_low"] == pytest.approx((0 + 50 * host) / 51, abs=1e-3)
    assert sites["h1", "p1"]["path_low"] == pytest.approx((40 + 50 * host) / 90, abs=1e-3)
    assert sites["h2", "p1"]["path_low"] < 0.03 and (None, None) in sites


def test_calibration_undoes_counting_twice():
    draw = np.random.default_rng(1)
    bad = (draw.random(4000) < 0.2).astype(float)
    ratio = np.where(bad, 2.0, -2.0) + 2 * draw.standard_normal(4000)  # its true log likelihood ratio is itself
    slope, shift = quality.calibration(3 * ratio + 1, bad)
    assert slope == pytest.approx(1 / 3, abs=0.05) and shift == pytest.approx(-1 / 3, abs=0.15)


# ---- pipeline


def test_pipeline(spark, small, tmp_path):
    rows = spark.read.parquet(f"{small}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "repeated_passages", "decontamination", "packing"]
    docs, kept = rows, [rows.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, small).write.parquet(path := str(tmp_path / name))
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == rows.columns and docs.where("n_chars <> length(text)").count() == 0
            kept.append(docs.count())
            last = docs
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0.5 * kept[0]
    want = {r["doc_id"] for r in last.select("doc_id").collect()}
    pieces = docs.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"] for r in pieces} == want and all(r["n"] == r["doc_tokens"] for r in pieces)


def test_pipeline_judges_passages_by_words_and_spares_short_items(spark, small, monkeypatch):
    run = " ".join("abcdefghij"[i % 10] + "klmnopq"[i % 7] * (i % 2) for i in range(60))  # 60 words, below 200 bytes
    few = run[:len(run) * 2 // 3]  # 40 words
    assert len(run) < 200 and len(few.split()) <= 50
    rows = [(1, f"first text {run} end"), (2, f"second one {run} other"), (3, f"third one {few} rest")]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.distinct_passages(spark, documents(spark, rows), small).collect()}
    assert got[1] == rows[0][1] and "a bl" not in got[2] and got[3] == rows[2][1]

    items = spark.createDataFrame([("1", "yes"), ("2", "New York"), ("3", "who was the first king of it")], "item_id string, text string")
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: items)
    rows = [(1, "we say yes in New York at all times"), (2, "Yes"), (3, "a quiz: who was the first king of it? no answer is here for you")]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.unseen_tests(spark, documents(spark, rows), small).collect()}
    assert got == {1: rows[0][1], 3: "a quiz: ? no answer is here for you"}


def test_pipeline_stages_take_awkward_and_empty_tables(spark, small, tmp_path):
    for name, docs in (("awkward", documents(spark, awkward(WORDS))), ("empty", empty(spark).withColumns({"source": F.lit("s"), "lang": F.lit("l")}))):
        for stage, f in corpus_pipeline.STAGES:
            f(spark, docs, small).write.parquet(path := str(tmp_path / f"{name}-{stage}"))
            docs = spark.read.parquet(path)
        assert "sequence_id" in docs.columns


def test_tokenizer_files_are_not_copied():
    assert "/repo/" not in public_tokenizers.path("word_bpe_49k.json")
