"""Packing of tokenised documents into training windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import slices, text_bytes
from emberline.llm.word_ids import word_ids

SLICE_BYTES = 8 << 20
GROUP_TOKENS = 1 << 20
LARGEST_PIECE = 512
FIRST_SLACK = 4


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Deals numbered items into ``k`` windows of near-equal sums.

    Each partial partition is a list of window sums, less its smallest. The two with the largest imbalance
    are merged again and again, the fullest window of one with the emptiest of the other, until one is left.
    """
    made: list[tuple[int, int]] = []  # node len(sizes) + i joins two nodes

    def padded(sums, nodes):
        return np.concatenate([sums, np.zeros(k - len(sums), np.int64)]), np.concatenate([nodes, np.full(k - len(nodes), -1)])

    heap = [(-size, i, np.array([size], np.int64), np.array([i], np.int64)) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    order = itertools.count(len(sizes))
    while len(heap) > 1:
        _, _, a, an = heapq.heappop(heap)
        _, _, b, bn = heapq.heappop(heap)
        if len(a) + len(b) <= k:  # still apart: no two windows meet
            sums, nodes = np.concatenate([a, b]), np.concatenate([an, bn])
        else:
            (a, an), (b, bn) = padded(a, an), padded(b, bn)
            b, bn = b[::-1], bn[::-1]
            sums, nodes = a + b, np.where(an >= 0, an, bn)
            both = np.flatnonzero((an >= 0) & (bn >= 0))
            nodes[both] = len(sizes) + len(made) + np.arange(len(both))
            made += zip(an[both].tolist(), bn[both].tolist())
            sums = sums - sums.min()
        by = np.argsort(-sums, kind="stable")
        sums, nodes = sums[by], nodes[by]
        spread = int(sums[0]) - (int(sums[-1]) if len(sums) == k else 0)
        heapq.heappush(heap, (-spread, next(order), sums, nodes))
    windows = []
    for node in heap[0][3].tolist() if heap else []:
        items, todo = [], [node]
        while todo:
            x = todo.pop()
            if x >= len(sizes):
                todo += made[x - len(sizes)]
            elif x >= 0:
                items.append(x)
        windows.append(sorted(items))
    return windows


def pack(pieces: list[tuple[int, int, int]], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that hold every token of ``pieces`` once.

    The windows are dealt by differencing, for a mean a little below their capacity. If one would exceed it
    the mean falls, the number of windows rises with it, and the items are dealt again. Tokens beyond a whole
    number of windows go to sequences of a power of two, which need no padding.
    """
    total, slack = sum(p[2] for p in pieces), FIRST_SLACK
    while True:
        k, kept, tail = total // (window - slack), [], []
        rest = total - k * (window - slack)
        for doc, start, length in reversed(pieces):
            cut = min(rest, length)
            if cut:
                tail.append((doc, start + length - cut, cut))
                rest -= cut
            if length > cut:
                kept.append((doc, start, length - cut))
        windows = difference([p[2] for p in kept], k)
        if all(sum(kept[i][2] for i in w) <= window for w in windows):
            break
        slack = min(2 * slack, window // 2)
        if slack == window // 2:  # as many windows as pieces always do
            windows = [[i] for i in range(len(kept))]
            break
    yield from ([kept[i] for i in w] for w in windows if w)
    left = sum(p[2] for p in tail)
    while left:
        room, sequence = 1 << (left.bit_length() - 1), []
        left -= room
        while room:
            doc, start, length = tail.pop()
            cut = min(room, length)
            sequence.append((doc, start, cut))
            if length > cut:
                tail.append((doc, start + cut, length - cut))
            room -= cut
        yield sequence


def pack_documents(
    docs: DataFrame, tokenizer_path: str, window: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Every document, with ``end_id`` appended, is cut into full windows and smaller pieces; each task packs
    the pieces of about ``GROUP_TOKENS`` tokens at a time, so memory is bounded and nothing is shuffled.
    ``tokenizer_path`` is a file of fewer than 65,536 ids, dropping white space, that every executor can read.
    Null or empty text is a document of the end token alone. Repeated rows are packed each for itself; an
    empty table gives no pieces; other columns are ignored. Sequence ids are unique and not consecutive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_ids(tokenizer_path)
        sequence = TaskContext.get().partitionId() << 40
        held: list[tuple[object, bytes]] = []
        pieces: list[tuple[int, int, int]] = []
        waiting = 0

        def rows(sequences):
            nonlocal sequence
            out = []
            for members in sequences:
                offset = 0
                for d, start, length in members:
                    doc_id, ids = held[d]
                    part = np.frombuffer(ids, "<u2", length, start * 2).astype("<u4").tobytes()
                    out.append((doc_id, start, length, zlib.crc32(part), len(ids) // 2, sequence, offset))
                    offset += length
                sequence += 1
            columns = list(zip(*out, strict=True)) or [()] * 7
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])],
                ["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        id_type = pa.int64()
        for batch in slices(batches, "_text", SLICE_BYTES):
            id_type = batch.schema.field("_id").type
            ids, borders = own.encode(batch.column("_text"), end_id)
            for doc_id, found in zip(batch.column("_id").to_pylist(), np.split(ids, borders[1:-1]), strict=True):
                n, found = len(found), found.tobytes()
                held.append((doc_id, found))
                d, full = len(held) - 1, n - n % window
                if full:
                    yield rows([(d, s, window)] for s in range(0, full, window))
                pieces += [(d, s, min(LARGEST_PIECE, n - s)) for s in range(full, n, LARGEST_PIECE)]
                waiting += n - full
                if waiting >= GROUP_TOKENS or len(held) >= 1 << 15:
                    yield rows(pack(pieces, window))
                    held, pieces, waiting = [], [], 0
        yield rows(pack(pieces, window))

    rows_in = docs.select(F.col(id_col).alias("_id"), text_bytes(text_col).alias("_text"))
    kind = rows_in.schema["_id"].dataType.simpleString()
    packed = rows_in.mapInArrow(
        run, f"_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return packed.withColumnRenamed("_id", id_col)
