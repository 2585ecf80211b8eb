"""Benchmark decontamination with a generalised suffix automaton over the words of the test items."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline.llm.common import once, parts_for, shared_path, slices, text_bytes

RUN = re.compile(rb"[^ ]+")
# Lower-cases A-Z and turns every byte outside words into a space.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
BLOCK_BYTES = 8 << 20


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class Automaton:
    """Suffix automaton of all items, with the items that own each state.

    ``window`` consecutive words of an item are a match; an item of fewer words is one match as a whole.
    """

    def __init__(self, items: Iterable[tuple[str | None, bytes]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        parsed = [(item, words) for item, text in items if (words := words_of(text))]
        for _, words in parsed:
            last = 0
            for w in words:
                last = self._extend(last, w)
        n = len(self.link)
        self.owners: list[set] = [set() for _ in range(n)]
        self.short: list[list[tuple[int, str | None]]] = [[] for _ in range(n)]
        for item, words in parsed:
            state = 0
            for w in words:
                state = self.next[state][w]
                s = state
                while s > 0 and self.length[s] >= window and item not in self.owners[s]:
                    self.owners[s].add(item)
                    s = self.link[s]
            if len(words) < window:
                self.short[state].append((len(words), item))
        for s in sorted(range(1, n), key=self.length.__getitem__):  # links first
            self.short[s] = sorted({*self.short[s], *self.short[self.link[s]]}, key=lambda x: (x[0], str(x[1])))

    def _state(self, length: int, link: int, following: dict) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _extend(self, last: int, w: bytes) -> int:
        known = self.next[last].get(w)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, known, w)
        made = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = made
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[made] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return made

    def _split(self, p: int, q: int, w: bytes) -> int:
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Word spans [start, end) of all matches, merged, and the items they come from."""
        following, link, length, window, short = self.next, self.link, self.length, self.window, self.short
        state = matched = 0
        spans: list[tuple[int, int]] = []
        items: set = set()
        for i, w in enumerate(words):
            to = following[state].get(w)
            if to is None:
                while state:
                    state = link[state]
                    to = following[state].get(w)
                    if to is not None:
                        break
                matched = length[state]
                if to is None:
                    continue
            state = to
            matched += 1
            if matched >= window:
                s = state
                while length[link[s]] >= window:
                    s = link[s]
                items |= self.owners[s]
                spans.append((i + 1 - window, i + 1))
            if short[state]:
                for n, item in short[state]:
                    if n <= matched:
                        items.add(item)
                        spans.append((i + 1 - n, i + 1))
        return merged(spans), items - {None}


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the bytes from the first to the last word of each span."""
    if not spans:
        return text
    at = [m.span() for m in RUN.finditer(text.translate(NORMAL))]
    kept, done = [], 0
    for a, b in spans:
        kept.append(text[done:at[a][0]])
        done = at[b - 1][1]
    return b"".join([*kept, text[done:]])


def overlaps(docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text",
             item_id: str = "item_id", item_text: str = "text", cut: int | None = None) -> DataFrame:
    """One row per document: ``row`` (all its columns), n_words, spans of hit words [a, b) and items hit.

    With ``cut``, ``text`` is the text without its spans of more than ``cut`` words.

    Items that repeat an id with its text count once. Items are read in blocks of about ``BLOCK_BYTES``, each held
    as one automaton by every task; as long as one block holds them all the documents are read once and not
    shuffled, otherwise the spans found so far are written to the shared folder between blocks. Words are runs of ASCII letters (A-Z lowered),
    digits and non-ASCII characters. Null or empty texts have no words; an item without words never matches,
    one with a null id matches without being listed. Repeated documents and items, empty tables and extra
    columns of any name are fine.
    """
    spark = docs.sparkSession
    tests = items.select(F.col(item_id).cast("string").alias("id"), text_bytes(item_text).alias("text")).where(F.length("text") > 0).distinct()
    blocks = parts_for(tests.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0], BLOCK_BYTES)
    rows = docs.select(F.struct("*").alias("row"), text_bytes(text_col).alias("_text"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"),
                       F.array().cast("array<struct<a:int,b:int>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
    for block in range(blocks):
        own = tests if blocks == 1 else tests.where(F.expr(f"pmod(xxhash64(id, text), {blocks}) = {block}"))
        shared = spark.sparkContext.broadcast([tuple(r) for r in own.collect()])  # one block: its size is bounded

        last = block == blocks - 1

        def run(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            automaton = once(shared, lambda rows: Automaton([(i, bytes(t)) for i, t in rows], window))
            for batch in slices(batches, "_text"):
                counts, spans, found, kept = [], [], [], []
                for text, before, owners in zip(
                        batch.column("_text").to_pylist(), batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True):
                    words = words_of(text)
                    new, got = automaton.matches(words)
                    counts.append(len(words))
                    new = merged([*new, *((s["a"], s["b"]) for s in before)])
                    spans.append([{"a": a, "b": b} for a, b in new])
                    found.append(sorted({*got, *owners}))
                    cuts = [(a, b) for a, b in new if b - a > cut] if last and cut is not None else []
                    kept.append(without_spans(text, cuts).decode("utf-8", "replace") if cuts else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("_text"), pa.array(kept, pa.string()), pa.array(counts, pa.int64()),
                     pa.array(spans, batch.schema.field("spans").type), pa.array(found, batch.schema.field("items").type)],
                    batch.schema.names)

        rows = rows.mapInArrow(run, schema)
        if blocks > 1:
            rows.write.parquet(path := shared_path(spark, f"decontaminate-{block}"))
            rows = spark.read.parquet(path)
    return rows


def report(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", **names) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated): what :func:`overlaps` found, as a digest."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return overlaps(docs, items, window, **names).select(
        F.col("row")[id_col].alias(id_col), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, max_span: int = 0, max_coverage: float = 0.5,
                  text_col: str = "text", **names) -> DataFrame:
    """The documents without spans of more than ``max_span`` hit words; those covered beyond ``max_coverage`` go.

    A shorter span stays, unless it alone covers the document beyond ``max_coverage``, which then goes too. Items
    that follow each other without a word between are one span.
    Only documents with such spans are changed. A document without words is kept as it is.
    """
    found = overlaps(docs, items, window, text_col, cut=max_span, **names)
    spans = F.filter("spans", lambda s: s["b"] - s["a"] > max_span)
    hit = F.aggregate(spans, F.lit(0), lambda n, s: n + s["b"] - s["a"])
    most = F.aggregate("spans", F.lit(0), lambda n, s: F.greatest(n, s["b"] - s["a"]))
    kept = found.where(F.greatest(hit, most) <= max_coverage * F.col("n_words"))
    new = F.coalesce("text", F.col("row")[text_col])
    return kept.select(*(new.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
