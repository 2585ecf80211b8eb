"""SimHash near-duplicate detection by a self-join of a binary trie of fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import parts_for, shared_path, slices, text_bytes
from emberline.llm.components import connected_components

BUNDLE_ROWS = 4096
CROWDED_ROWS = 32768
BROADCAST_ROWS = 100_000
FRONTIER = 1 << 20


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``words`` lower-cased words; of the whole text where it has fewer."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([digest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate([[0], ends[:-words]]).tolist()
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts, (ends[words - 1:] - 1).tolist(), strict=True)], np.uint64)


def majority(hashes: np.ndarray, lanes: int) -> bytes:
    """``lanes`` times 64 bits, most significant first; a bit is set if over half of the hashes set it.

    The first lane is of the hashes themselves, the others of hashes mixed from them.
    """
    n = len(hashes)
    if not n:
        return bytes(8 * lanes)
    wide, h = [hashes], hashes
    for _ in range(lanes - 1):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        wide.append(h)
    bits = np.unpackbits(np.stack(wide, 1).astype(">u8").view(np.uint8), axis=1)
    sums = np.add.reduceat(bits.view(np.uint64), np.arange(0, n, 255), axis=0)  # eight counters to a number
    return np.packbits(sums.view(np.uint8).sum(0, np.int64) * 2 > n).tobytes()


def fingerprints(docs: DataFrame, words: int = 5, lanes: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row: a SimHash of ``64 * lanes`` bits as bytes; all zero where there are no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found = [majority(shingle_hashes(t, words), lanes) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())], ["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("_text"))
    return rows.mapInArrow(run, "id long, fp binary")


def exact_plan(bits: int, budget: int) -> tuple[list[list[int]], int]:
    """Bit orders and a prefix so that two fingerprints within ``budget`` agree on the prefix of some order."""
    cuts = [round(i * bits / (budget + 1)) for i in range(budget + 2)]
    orders = [[*range(a, b), *range(a), *range(b, bits)] for a, b in zip(cuts, cuts[1:], strict=False)]
    return orders, min(b - a for a, b in zip(cuts, cuts[1:], strict=False))


def products(alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs of two ranges, for each row; of a range with itself every pair once."""
    each = (ahi - alo) * (bhi - blo)
    row = np.repeat(np.arange(len(each)), each)
    i = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    x, y = alo[row] + i // (bhi - blo)[row], blo[row] + i % (bhi - blo)[row]
    keep = (alo != blo)[row] | (x < y)
    return x[keep], y[keep]


def trie_pairs(keys: np.ndarray, prefix: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of fingerprints that share ``prefix`` bits and differ in at most ``budget`` bits.

    ``keys`` are packed bits, one fingerprint to a row, in sorted order, so a node of the trie is a range of
    rows. Pairs of nodes descend together, one bit at a time, and count the bits in which they differ;
    a pair beyond the budget is dropped. Pairs of single fingerprints are settled by their remaining bits.
    """
    m, bits = len(keys), np.unpackbits(keys, axis=1)
    ones: dict[int, np.ndarray] = {}

    def split(d, lo, hi):
        if d not in ones:
            ones[d] = np.concatenate([[0], np.cumsum(bits[:, d], dtype=np.int64)])
        return hi - (ones[d][hi] - ones[d][lo])

    edge = np.flatnonzero(np.concatenate([[True], (bits[1:, :prefix] != bits[:-1, :prefix]).any(1), [True]]))
    lo, hi = edge[:-1], edge[1:]
    lo, hi = lo[hi - lo > 1], hi[hi - lo > 1]
    found = []

    def settle(a, b):
        for i in range(0, len(a), FRONTIER):
            x, y = a[i:i + FRONTIER], b[i:i + FRONTIER]
            near = np.bitwise_count(keys[x] ^ keys[y]).sum(1, np.int64) <= budget
            found.append((x[near].astype(np.int32), y[near].astype(np.int32)))

    stack = [(prefix, lo, hi, lo, hi, np.zeros(len(lo), np.int64))]
    while stack:
        d, alo, ahi, blo, bhi, err = stack.pop()
        if not len(alo):
            continue
        if len(alo) > FRONTIER:
            half = len(alo) // 2
            stack += [(d, *(x[half:] for x in (alo, ahi, blo, bhi, err))), (d, *(x[:half] for x in (alo, ahi, blo, bhi, err)))]
            continue
        amid, bmid = split(d, alo, ahi), split(d, blo, bhi)
        same = alo == blo
        apart = ~same
        out = [
            (alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err), (alo, amid, bmid, bhi, err + 1),
            tuple(x[apart] for x in (amid, ahi, blo, bmid, err + 1)),
        ]
        alo, ahi, blo, bhi, err = (np.concatenate(x) for x in zip(*out, strict=True))
        live = (ahi > alo) & (bhi > blo) & (err <= budget) & ((alo != blo) | (ahi - alo > 1))
        single = live & (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            settle(alo[single], blo[single])
        live &= ~single
        if d + 1 < bits.shape[1]:
            stack.append((d + 1, *(x[live] for x in (alo, ahi, blo, bhi, err))))
        elif live.any():
            settle(*products(*(x[live] for x in (alo, ahi, blo, bhi))))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def merged(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent``, the smallest member of each node's component, after the links (a, b) are added."""
    while len(a):
        pa_, pb = parent[a], parent[b]
        open_ = pa_ != pb
        if not open_.any():
            break
        a, b, pa_, pb = a[open_], b[open_], pa_[open_], pb[open_]
        np.minimum.at(parent, np.maximum(pa_, pb), np.minimum(pa_, pb))
        while (parent[parent] != parent).any():
            parent = parent[parent]
    return parent


def spanning(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links to the smallest id of each component of the pairs, instead of all pairs."""
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    parent = merged(np.arange(len(ids)), rank[a], rank[b])
    far = np.flatnonzero(parent != np.arange(len(ids)))
    return ids[order[far]], ids[order[parent[far]]]


def meetings(prints: DataFrame, bits: int, orders: list[list[int]], prefix: int, rows: int):
    """Fingerprints (id, fp) grouped so that those that agree on a prefix meet.

    For each bit order the fingerprints are dealt by a hash of their prefix to bundles of about
    ``BUNDLE_ROWS``; a bundle is a forest of sub-tries, joined with itself in one task. A bundle of more than
    ``CROWDED_ROWS`` is dealt on to chunks, and every two chunks meet in a task of their own, so no task
    holds more than two chunks and no pair is lost.
    """
    bundles = parts_for(rows, BUNDLE_ROWS)
    table = np.array(orders)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                fps = np.frombuffer(b"".join(part.column("fp").to_pylist()), np.uint8).reshape(-1, bits // 8)
                loose = np.unpackbits(fps, axis=1)
                for t, order in enumerate(table):
                    keys = np.packbits(loose[:, order], axis=1)
                    head = np.zeros((len(keys), 8), np.uint8)
                    head[:, :min(8, bits // 8)] = keys[:, :8]
                    mixed = (head.view(">u8").ravel().astype(np.uint64) >> np.uint64(64 - prefix)) * np.uint64(0x9E3779B97F4A7C15)
                    bundle = (mixed >> np.uint64(33)) % np.uint64(bundles)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), t, np.int32)), pa.array(bundle.astype(np.int32)),
                         pa.array([k.tobytes() for k in keys], pa.binary()), part.column("id")],
                        ["order", "bundle", "key", "id"])

    dealt = prints.where("id IS NOT NULL").select("id", "fp").mapInArrow(deal, "order int, bundle int, key binary, id long")
    crowded = (dealt.groupBy("order", "bundle").count().where(F.col("count") > CROWDED_ROWS)
               .select("order", "bundle", F.ceil(F.col("count") / CROWDED_ROWS).cast("int").alias("chunks"))).checkpoint()
    if crowded.count() <= BROADCAST_ROWS:
        crowded = F.broadcast(crowded)
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    met = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.struct(F.least(chunk, j).alias("i"), F.greatest(chunk, j).alias("j")))
    alone = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    cells = (dealt.join(crowded, ["order", "bundle"], "left")
             .withColumn("cell", F.explode(F.when(F.col("chunks").isNull(), alone).otherwise(met))))
    return cells.groupBy("order", "bundle", "cell.i", "cell.j")


def in_order(group: pa.Table, bits: int, *columns: str) -> tuple[np.ndarray, ...]:
    """The keys of a group in sorted order, and its columns in the same order."""
    keys = np.frombuffer(b"".join(group.column("key").to_pylist()), np.uint8).reshape(-1, bits // 8)
    by = np.argsort(np.ascontiguousarray(keys).view(f"S{bits // 8}").ravel(), kind="stable")
    return keys[by], *(group.column(c).to_numpy()[by] for c in columns)


def links(prints: DataFrame, bits: int, budget: int, orders: list[list[int]], prefix: int, rows: int) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (id, fp) found within ``budget`` differing bits."""

    def join(group: pa.Table) -> pa.Table:
        keys, ids = in_order(group, bits, "id")
        a, b = spanning(ids, *trie_pairs(keys, prefix, budget))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return meetings(prints, bits, orders, prefix, rows).applyInArrow(join, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 3, budget: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) of every row; the component is the smallest id linked directly or through others.

    Fingerprints have 64 bits, of shingles of ``words`` words, and all pairs within ``budget`` differing bits are linked;
    equal fingerprints are joined only once. Whether two texts are linked depends on the two alone.

    Null, empty and blank texts have a zero fingerprint and are linked with each other. Rows with a null id
    get a null component and link nothing; repeated rows share a component; empty tables give no rows; extra
    columns are ignored. Texts of any length are read whole; one text at a time is held as shingles.
    """
    spark = docs.sparkSession
    fingerprints(docs, words, 1, id_col, text_col).write.parquet(path := shared_path(spark, "simhash"))
    prints = spark.read.schema("id long, fp binary").parquet(path)
    classes = prints.groupBy("fp").agg(F.min("id").alias("id")).checkpoint()
    rows = classes.count()
    orders, prefix = exact_plan(64, budget)
    roots = connected_components(links(classes, 64, budget, orders, prefix, rows))
    named = classes.join(roots, "id", "left").select("fp", F.coalesce("root", "id").alias("component_id"))
    return prints.join(named, "fp").select(
        F.col("id").alias(id_col), "fp", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def deduplicated(docs: DataFrame, words: int = 3, budget: int = 2, id_col: str = "doc_id", **how) -> DataFrame:
    """The documents without those of a component other than its smallest id. Rows with a null id, and rows that repeat an id, stay."""
    found = near_duplicates(docs, words, budget, id_col=id_col, **how)
    gone = found.where(F.col("component_id") < F.col(id_col)).select(id_col).distinct()
    return docs.join(gone, id_col, "left_anti").select(docs.columns)
