"""Removal of repeated byte strings, by prefix-free parsing and the sorted suffixes of the phrase dictionary.

A string of ``length`` bytes that occurs in two documents has, in both, the same rolling-hash trigger: the
smallest hash of ``TRIGGER`` bytes within it. The triggers cut every text into overlapping phrases, each a
trigger with ``length - TRIGGER`` bytes of context on either side, so each such string lies whole in some
phrase and the order of all strings to that depth follows from the phrases alone: the parse only says in
which document, and where, a phrase stands. Highly repetitive text has few distinct phrases. Phrases whose
trigger stands in one document only are dropped before their contexts are read. The suffixes of the rest are
sorted, one run for each distance from suffix start to trigger; suffixes that agree over ``length`` bytes
become neighbours, and all but those of the smallest document are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import parts_for

TRIGGER = 24
PART_BYTES = 4 << 20
NONE = np.iinfo(np.int64).max
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def rolling(text: bytes) -> np.ndarray:
    """A 64-bit hash of the ``TRIGGER`` bytes from each place on."""
    n = len(text) - TRIGGER + 1
    words = np.ascontiguousarray(np.ndarray((len(text) - 7,), "<u8", text, strides=(1,)))
    h = words[:n] * np.uint64(MULTIPLIERS[0])
    h ^= h >> np.uint64(29)
    h += words[8:n + 8] * np.uint64(MULTIPLIERS[1])
    h ^= h >> np.uint64(31)
    h += words[16:n + 16]
    h *= np.uint64(MULTIPLIERS[2])
    return mix(h)


def sliding(best, a: np.ndarray, width: int) -> np.ndarray:
    """``best`` (minimum or maximum) over every run of ``width`` values."""
    size = 1
    while 2 * size <= width:
        a = best(a[:-size], a[size:])
        size *= 2
    return best(a[:len(a) - width + size], a[width - size:]) if width > size else a


def triggers(text: bytes, barred: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the triggers: wherever a hash is the smallest of some ``length`` bytes.

    ``barred`` marks the places where no such string may begin. The text is worked through in steps that
    fit a processor's cache.
    """
    n, width, step = len(text) - length + 1, length - TRIGGER + 1, 1 << 16
    at, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    ends = np.zeros(width - 1, np.uint64)
    for start in range(0, n, step):  # all strings that begin in this step
        h = rolling(text[start:min(start + step, n) - 1 + length])
        low = sliding(np.minimum, h, width)
        low[barred[start:start + len(low)]] = 0
        found = np.flatnonzero(h == sliding(np.maximum, np.concatenate([ends, low, ends]), width))
        at.append(found + start)
        hashes.append(h[found])
    at, first = np.unique(np.concatenate(at), return_index=True)
    return at, np.concatenate(hashes)[first]


class Part:
    """The documents of one part in a fixed order, parsed as one text; strings never cross documents."""

    def __init__(self, rows: pa.Table, length: int, parse: bool = True):
        rows = rows.take(np.argsort(rows.column("rid").to_numpy(), kind="stable"))
        self.rows, self.rids, self.texts = rows, rows.column("rid").to_numpy(), rows.column("text").to_pylist()
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.text = b"".join(self.texts)
        if not parse:
            return
        docs = rows.column("doc").fill_null(NONE).to_numpy()
        barred = np.repeat(docs == NONE, sizes)
        for i in range(1, length):
            barred[np.maximum(self.starts[1:] - i, self.starts[:-1])[sizes > 0]] = True
        place, self.hash = triggers(self.text, barred, length)
        self.row = np.searchsorted(self.starts, place, "right") - 1
        self.at = place - self.starts[self.row]
        self.doc = docs[self.row]


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where sorted columns, taken together, change; with the end."""
    n = len(columns[0])
    if not n:
        return np.zeros(1, np.int64)
    change = np.zeros(n - 1, bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [n]])


def blobs(key: np.ndarray, **columns: np.ndarray) -> Iterator[dict]:
    """One row for each key with its rows of every column as bytes."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    edge = runs(key)
    columns = {n: c[order] for n, c in columns.items()}
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        yield {"key": int(key[a]), **{n: c[a:b].tobytes() for n, c in columns.items()}}


def joined(table: pa.Table, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in table.column(name).to_pylist() if x), dtype)


def short(h: np.ndarray) -> np.ndarray:
    """The lower 40 bits as items of five bytes; within a bucket they tell hashes apart well enough to choose candidates."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).view("V5").ravel()


def longer(packed: np.ndarray) -> np.ndarray:
    out = np.zeros((len(packed), 8), np.uint8)
    out[:, :5] = packed.view(np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h >> np.uint64(40)) % np.uint64(buckets)


def shared_triggers(buckets: int, length: int):
    """From a part to each bucket of trigger hashes: the hashes, and whether two documents of the part hold them."""

    def run(key, rows):
        part, number = Part(rows, length), key[0].as_py()
        order = np.lexsort((part.doc, part.hash))
        h, doc = part.hash[order], part.doc[order]
        edge = runs(h)
        many = doc[edge[:-1]] < doc[edge[1:] - 1] if len(h) else np.zeros(0, bool)
        h = h[edge[:-1]]
        out = [{"part": number, **r} for r in blobs(bucket_of(h, buckets), hash=short(h), many=many)]
        return pa.Table.from_pylist(out, pa.schema([("part", pa.int64()), ("key", pa.int64()), ("hash", pa.binary()), ("many", pa.binary())]))

    return run


def common_hashes(key, rows):
    """From a bucket back to each part: its hashes that stand in two documents at least.

    All rows of a document id are in one part, so a hash of two parts is one of two documents.
    """
    h, many = longer(joined(rows, "hash", "V5")), joined(rows, "many", bool)
    part = np.repeat(rows.column("part").to_numpy(), [len(x) // 5 for x in rows.column("hash").to_pylist()])
    order = np.argsort(h, kind="stable")
    h, many, part = h[order], many[order], part[order]
    edge = runs(h)
    if len(h):
        two = np.repeat(np.logical_or.reduceat(many, edge[:-1]) | (np.diff(edge) > 1), np.diff(edge))
        h, part = h[two], part[two]
    bucket = key[0].as_py()
    return pa.Table.from_pylist([{"part": r["key"], "bucket": bucket, "hash": r["hash"]} for r in blobs(part, hash=short(h))],
                                pa.schema([("part", pa.int64()), ("bucket", pa.int64()), ("hash", pa.binary())]))


def phrases(buckets: int, length: int):
    """From a part, with its common hashes, to buckets: the phrases of common triggers.

    A phrase that stands in several documents of the part is sent for the smallest only; in the others
    every string of it is a repeat, which is sent on under the part itself (key -1).
    """
    side = length - TRIGGER

    def run(key, rows, common):
        schema = pa.schema([("part", pa.int64()), ("key", pa.int64()), *((n, pa.binary()) for n in ("hash", "context", "left", "right", "doc", "row", "at", "bits"))])
        if not rows.num_rows or not common.num_rows:
            return schema.empty_table()
        part, number = Part(rows, length), key[0].as_py()
        known = longer(joined(common, "hash", "V5"))
        known = np.sort(known | np.repeat(common.column("bucket").to_numpy().astype(np.uint64), [len(x) // 5 for x in common.column("hash").to_pylist()]) << np.uint64(40))
        own = (bucket_of(part.hash, buckets) << np.uint64(40)) | (part.hash & np.uint64((1 << 40) - 1))
        place = np.minimum(np.searchsorted(known, own), len(known) - 1)
        take = np.flatnonzero(known[place] == own)
        h, doc, row, at = part.hash[take], part.doc[take], part.row[take], part.at[take]
        size = np.diff(part.starts)[row]
        left, right = np.minimum(at, side), np.minimum(size - at - TRIGGER, side)
        padded = np.concatenate([np.zeros(side, np.uint8), np.frombuffer(part.text, np.uint8), np.zeros(side, np.uint8)])
        out = []
        for i in range(0, len(take), 1 << 16):
            s = slice(i, i + (1 << 16))
            begin = part.starts[row[s]] + at[s] + side
            steps = np.arange(1, side + 1)
            before = np.where(steps <= left[s, None], padded[begin[:, None] - steps], 0)
            after = np.where(steps <= right[s, None], padded[begin[:, None] + TRIGGER - 1 + steps], 0)
            out.append(np.concatenate([before, after], 1).astype(np.uint8))
        context = np.concatenate(out) if out else np.zeros((0, 2 * side), np.uint8)
        whole = h.copy()
        for i in range(0, 2 * side, 8):
            block = np.zeros((len(h), 8), np.uint8)
            block[:, :min(8, 2 * side - i)] = context[:, i:i + 8]
            whole = mix(whole * np.uint64(MULTIPLIERS[1]) + block.view("<u8").ravel())
        whole = mix(whole + (left * 1000 + right).astype(np.uint64))
        order = np.lexsort((doc, whole))
        edge = runs(whole[order])
        first = np.zeros(len(h), np.int64)
        first[order] = np.repeat(doc[order[edge[:-1]]], np.diff(edge))
        again = doc > first
        bits = np.zeros(len(h), np.uint64)
        for o in range(side + 1):
            bits |= ((o <= left) & (side - o <= right)).astype(np.uint64) << np.uint64(o)
        row, at = row.astype(np.uint32), at.astype(np.uint32)
        own = [{"part": number, "key": -1, "row": row[again].tobytes(), "at": at[again].tobytes(), "bits": bits[again].tobytes()}] if again.any() else []
        one = ~again
        sent = [{"part": number, **r} for r in blobs(
            bucket_of(h[one], buckets), hash=h[one], context=context[one].view(f"V{2 * side}").ravel(),
            left=left[one].astype(np.uint8), right=right[one].astype(np.uint8), doc=doc[one], row=row[one], at=at[one])]
        return pa.Table.from_pylist(own + sent, schema)

    return run


def repeats(length: int):
    """From a bucket to each part: the strings of its phrases that stand in a smaller document, as bits by distance.

    For each distance the suffixes that begin so far before their trigger are put in order of what they
    have in common with it: the trigger, the bytes before and the bytes after, as a running hash of 64 bits.
    """
    side = length - TRIGGER

    def run(key, rows):
        schema = pa.schema([("part", pa.int64()), ("row", pa.binary()), ("at", pa.binary()), ("bits", pa.binary())])
        if key[0].as_py() < 0:
            return rows.select(["part", "row", "at", "bits"])
        h = joined(rows, "hash", np.uint64)
        context = joined(rows, "context", np.uint8).reshape(-1, 2 * side)
        left, right = joined(rows, "left", np.uint8).astype(np.int64), joined(rows, "right", np.uint8).astype(np.int64)
        doc, row, at = joined(rows, "doc", np.int64), joined(rows, "row", np.uint32), joined(rows, "at", np.uint32)
        part = np.repeat(rows.column("part").to_numpy(), [len(x) // 8 for x in rows.column("hash").to_pylist()])
        by = np.lexsort((doc, h))  # documents in order within equal suffixes, as sorting by suffix is stable
        bits = np.zeros(len(h), np.uint64)
        trunk = [np.full(len(h), 0x51ED270B, np.uint64)]
        for i in range(side):
            trunk.append(mix(trunk[-1] * np.uint64(MULTIPLIERS[0]) + context[:, side + i].astype(np.uint64)))
        before = h.copy()
        for o in range(side + 1):
            if o:
                before = mix(before * np.uint64(MULTIPLIERS[1]) + context[:, o - 1].astype(np.uint64))
            held = by[(left[by] >= o) & (right[by] >= side - o)]
            if not len(held):
                continue
            suffix = before[held] ^ trunk[side - o][held]
            order = np.argsort(suffix, kind="stable")
            edge = runs(suffix[order])
            d = doc[held][order]
            later = np.zeros(len(held), bool)
            later[order] = d > np.repeat(d[edge[:-1]], np.diff(edge))
            bits[held[later]] |= np.uint64(1 << o)
        hit = bits != 0
        return pa.Table.from_pylist([{"part": r["key"], "row": r["row"], "at": r["at"], "bits": r["bits"]}
                                     for r in blobs(part[hit], row=row[hit], at=at[hit], bits=bits[hit])], schema)

    return run


def whole_words(text: bytes, a: int, b: int) -> int:
    """The number of words of which no part is outside of [a, b)."""
    inside = text[max(a - 1, 0):b + 1].split()
    cut = (a > 0 and not text[a - 1:a].isspace()) + (b < len(text) and not text[b:b + 1].isspace())
    return max(0, len(inside) - cut)


def remaining(length: int, want_text: bool, least_span: int, least_words: int | None = None):
    """From a part, with its repeats, to its documents: the spans of bytes to remove, and what stays."""
    side = length - TRIGGER

    def run(rows, found):
        part = Part(rows, length, parse=False)
        row, at, bits = joined(found, "row", np.uint32), joined(found, "at", np.uint32), joined(found, "bits", np.uint64)
        change, begin = np.zeros(len(part.text) + 1, np.int32), part.starts[row] + at
        for o in range(side + 1):
            some = begin[(bits >> np.uint64(o) & np.uint64(1)).astype(bool)] - o
            np.add.at(change, some, 1)
            np.add.at(change, some + length, -1)
        gone = np.cumsum(change[:-1], dtype=np.int32) > 0
        spans, kept = [], []
        for i, text in enumerate(part.texts):
            own = gone[part.starts[i]:part.starts[i + 1]]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]]))).tolist() if own.any() else []
            if least_span:
                edge = [x for a, b in zip(edge[::2], edge[1::2], strict=True)
                        if b - a >= least_span or least_words is not None and whole_words(text, a, b) >= least_words for x in (a, b)]
            spans.append([{"a": a, "b": b} for a, b in zip(edge[::2], edge[1::2], strict=True)])
            stays = [0, *edge, len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(stays[::2], stays[1::2], strict=True)) if edge else text)
        return pa.table({
            "rest": part.rows.column("rest"), "absent": part.rows.column("absent"),
            "n_bytes": pa.array(np.diff(part.starts), pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            "kept": pa.array([k.decode("utf-8", "ignore") if want_text else None for k in kept], pa.string())})

    return run


def repeated_spans(docs: DataFrame, length: int = 50, least_span: int = 0, want_text: bool = False, id_col: str = "doc_id", text_col: str = "text",
                   least_words: int | None = None) -> DataFrame:
    """One row per document: ``rest`` (its other columns), absent, n_bytes, spans, kept_sha256 and kept.

    ``spans`` are the byte ranges covered by strings of ``length`` bytes that also start in a document with
    a smaller id, judged on the input, of at least ``least_span`` bytes or ``least_words`` whole words each; ``kept`` is the rest of the text,
    where it is asked for, less what is left of characters cut in two. Texts are shuffled once and read from there three times: to find triggers that stand in two documents, to send
    their phrases, and to cut. Parts hold about ``PART_BYTES`` of text, dealt by a hash of the id, and send
    a hash or phrase once however often it stands in them, so frequent strings and copies add little.

    Null texts are empty (``absent``). Rows with a null id lose nothing and count for no other row. Rows of
    one id never repeat each other. Empty tables give no rows; other columns may have any name.
    """
    if not TRIGGER < length <= TRIGGER + 63:
        raise ValueError(f"length must be from {TRIGGER + 1} to {TRIGGER + 63}")
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    parts = parts_for(size, PART_BYTES)
    others = [F.col(c) for c in docs.columns if c != text_col]
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = docs.select(
        F.pmod(F.xxhash64(id_col), F.lit(parts)).alias("part"), F.xxhash64(id_col, text_col).alias("rid"),
        F.col(id_col).cast("long").alias("doc"), text.alias("text"), F.col(text_col).isNull().alias("absent"), F.struct(*others).alias("rest"))
    by_part = base.groupBy("part")
    sent = by_part.applyInArrow(shared_triggers(parts, length), "part long, key long, hash binary, many binary")
    common = sent.groupBy("key").applyInArrow(common_hashes, "part long, bucket long, hash binary")
    met = by_part.cogroup(common.groupBy("part")).applyInArrow(
        phrases(parts, length),
        "part long, key long, hash binary, context binary, left binary, right binary, doc binary, row binary, at binary, bits binary")
    # what a part has settled itself goes straight back to it
    home = F.when(F.col("key") < 0, -1 - F.col("part")).otherwise(F.col("key"))
    found = met.withColumn("key", home).groupBy("key").applyInArrow(repeats(length), "part long, row binary, at binary, bits binary")
    kind = f"rest {base.schema['rest'].dataType.simpleString()}, absent boolean, n_bytes long, spans array<struct<a:long,b:long>>, kept_sha256 string, kept string"
    return by_part.cogroup(found.groupBy("part")).applyInArrow(remaining(length, want_text, least_span, least_words), kind)


def report(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256): what :func:`repeated_spans` found, as a digest."""
    found = repeated_spans(docs.select(id_col, text_col), length, id_col=id_col, text_col=text_col)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return found.select(F.col("rest")[id_col].alias(id_col), "n_bytes", removed.alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def deduplicated(docs: DataFrame, length: int = 50, least_span: int = 200, id_col: str = "doc_id", text_col: str = "text",
                 least_words: int | None = None) -> DataFrame:
    """The documents without their repeated spans of at least ``least_span`` bytes or ``least_words`` words; other texts are unchanged."""
    found = repeated_spans(docs, length, least_span, True, id_col, text_col, least_words)
    text = F.when(~F.col("absent"), F.col("kept"))
    return found.select(*(text.alias(c) if c == text_col else F.col("rest")[c].alias(c) for c in docs.columns))
