"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are emitted."""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import slices, text_bytes

# Fixed value: the pre-tokenizer of byte-level vocabularies.
WORDS = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
CACHED_WORDS = 600_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


def merged_count(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> int:
    """Symbols that are left when the lowest-ranked adjacent pair is merged until none is mergeable.

    The heap holds (rank, place, left, right); an entry whose symbols have changed since is skipped.
    """
    n = count = len(symbols)
    if n < 2:
        return n
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        found = ranks.get((symbols[i], symbols[i + 1]))
        if found:
            heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
    heapq.heapify(heap)
    while heap:
        _, i, left, right, made = heapq.heappop(heap)
        j = following[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue
        symbols[i], symbols[j] = made, -1
        k = following[i] = following[j]
        count -= 1
        if k < n:
            before[k] = i
            found = ranks.get((made, symbols[k]))
            if found:
                heapq.heappush(heap, (found[0], i, made, symbols[k], found[1]))
        h = before[i]
        if h >= 0:
            found = ranks.get((symbols[h], made))
            if found:
                heapq.heappush(heap, (found[0], h, symbols[h], made, found[1]))
    return count


class Bounded(dict):
    """A cache that computes what it lacks and keeps at most ``limit`` results."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) < self.limit:
            self[key] = value
        return value


class Counter:
    """Counts the tokens of texts for one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.start = [vocab[c] for c in byte_characters()]
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.word = Bounded(self._word, CACHED_WORDS)
        self.first = Bounded(lambda s: sum(map(self.word.__getitem__, WORDS.findall(s))), CACHED_WORDS // 4)
        self.spaced = Bounded(lambda s: sum(map(self._word, WORDS.findall(" " + s))), CACHED_WORDS)

    def _word(self, word: str) -> int:
        return merged_count([self.start[b] for b in word.encode()], self.ranks)

    def plain(self, text: str) -> int:
        """The tokens of a text without special strings.

        Where white space is single spaces and line feeds between other characters, each begins a new word,
        so the text is counted by space-separated piece; other texts go through the pattern as a whole.
        """
        if text.split() != text.replace("\n", " ").split(" "):
            return sum(map(self.word.__getitem__, WORDS.findall(text)))
        lines = text.split("\n")
        total = (len(lines) - 1) * self.word["\n"]
        for line in lines:
            pieces = line.split(" ")
            total += self.first[pieces[0]] + sum(map(self.spaced.__getitem__, pieces[1:]))
        return total

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        parts = self.special.split(text)
        return sum(map(self.plain, parts)) + len(parts) - 1


@functools.cache
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row, in one pass without a shuffle.

    ``tokenizer_path`` is a byte-level BPE file that every executor can read. Null text counts as empty
    (no bytes, no tokens); an empty table gives an empty result; repeated rows give repeated results; other
    columns are ignored, whatever their names. A text of any length takes time in n log n: each word is
    merged with a heap over a linked list of its symbols.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer_path)
        for batch in slices(batches, "_text"):
            texts = batch.column("_text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([own.count(t.decode("utf-8", "replace")) for t in texts], pa.int64())],
                ["_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("_id"), text_bytes(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"_id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
