"""Token identifiers of documents in wavelet-matrix files, written and read back by Spark."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberline.llm.common import shared_path, slices, text_bytes
from emberline.llm.wavelet import MAGIC, WaveletMatrix, encode
from emberline.llm.word_ids import word_ids

SHARD_TOKENS = 1 << 22
SLICE_BYTES = 8 << 20
NO_ID = -(1 << 63)


def borders(ids: DataFrame, groups: int) -> list[int]:
    """``groups - 1`` quantiles of ``place``; one that holds many rows is a border several times."""
    if groups < 2:
        return []
    shares = [i / groups for i in range(1, groups)]
    return ids.agg(F.percentile_approx("place", shares, max(10_000, 8 * groups)).alias("q")).first()["q"] or []


def groups_of(places: np.ndarray, salt: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The group of each row, ascending with its place; rows of a place that is a border share out by salt."""
    low, high = np.searchsorted(edges, places, "left"), np.searchsorted(edges, places, "right")
    return (low + (salt * (high - low + 1).astype(np.uint64) >> np.uint64(32)).astype(np.int64)).astype(np.int32)


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Writes the identifiers of all documents, each with ``end_id`` after it, in ascending order of their ids.

    Texts are encoded where they are read; only identifiers move, to as many ranges of ids as the session has shuffle
    partitions. A range is sorted and cut into files of ``shard_tokens`` and at most one document more, each a
    wavelet matrix, so a task holds one file and not its range. Rows of one id, however many, share out
    over ranges and follow each other in no set order; rows with a null id come first.
    ``tokenizer_path`` is a file of fewer than 65,536 ids, dropping white space, that every executor can read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("_text"))
    rows = rows.withColumn("place", F.coalesce("doc_id", F.lit(NO_ID)))
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = np.array(borders(rows.select("place"), groups), np.int64)

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = word_ids(tokenizer_path), TaskContext.get().partitionId() << 40
        for batch in slices(batches, "_text", SLICE_BYTES):
            ids, ends = own.encode(batch.column("_text"), end_id)
            held = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((2 * ends).astype(np.int32)), pa.py_buffer(ids)])
            salt = (np.arange(number, number + len(held)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            number += len(held)
            place = batch.column("place").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(groups_of(place, salt, edges)), batch.column("place"), pa.array(salt.astype(np.int64)), batch.column("doc_id"),
                 held], ["group", "place", "salt", "doc_id", "ids"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, number, held, size = None, 0, [], 0

        def file():
            names, ids = zip(*held, strict=True)
            lengths = [len(i) // 2 for i in ids]
            made = encode(np.frombuffer(b"".join(ids), "<u2"), np.array([0 if n is None else n for n in names], np.int64),
                          np.array([n is None for n in names]), np.cumsum([0, *lengths]), group, number)
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["file"])

        for batch in batches:
            for g, name, ids in zip(*(batch.column(c).to_pylist() for c in ("group", "doc_id", "ids")), strict=True):
                if held and (g != group or size >= shard_tokens):
                    yield file()
                    number, held, size = number + 1, [], 0
                if g != group:
                    group, number = g, 0
                held.append((name, ids))
                size += len(ids) // 2
        if held:
            yield file()

    dealt = rows.mapInArrow(identify, "group int, place long, salt long, doc_id long, ids binary").repartitionById(groups, F.col("group"))
    files = dealt.sortWithinPartitions("group", "place", "salt").select("group", "doc_id", "ids").mapInArrow(build, "file binary")
    files.select(F.col("file").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def token_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of every file."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[WaveletMatrix]:
    for batch in batches:
        for content in batch.column("content"):
            data = content.as_py()
            if data[:4] == MAGIC:  # a task without rows leaves an empty file
                yield WaveletMatrix(data)


def stored_documents(files: DataFrame) -> DataFrame:
    """(group, number, doc_id, at, n_tokens, ids_crc32) of every document: its file, and where it starts there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for matrix in opened(batches):
            flat, starts = memoryview(matrix.tokens().astype("<u4")).cast("B"), matrix.starts
            crcs = [zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
            n = len(crcs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, matrix.group, np.int32)), pa.array(np.full(n, matrix.number, np.int32)),
                 pa.array(matrix.doc_ids, mask=matrix.missing), pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(crcs, pa.int64())],
                ["group", "number", "doc_id", "at", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, "group int, number int, doc_id long, at long, n_tokens long, ids_crc32 long")


def with_starts(found: DataFrame) -> DataFrame:
    """``found`` with ``start``, the tokens of all documents before: sums of files in a range, then of ranges."""
    files = found.groupBy("group", "number").agg(F.sum("n_tokens").alias("n"))
    ranges = files.groupBy("group").agg(F.sum("n").alias("of_range"))  # as many rows as ranges
    earlier = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("group", F.coalesce(F.sum("of_range").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("group").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(ranges, "group")
    base = files.select("group", "number", (F.col("before") + F.col("inside")).alias("base"))
    return found.join(base, ["group", "number"]).withColumn("start", F.col("base") + F.col("at"))


def token_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from files written in the shared folder and read back.

    Null, empty and blank texts are the end token alone. Repeated rows are written each for itself; an empty
    table gives no rows; other columns are ignored. A text of any length is a row of its file, which
    holds that one document more than its bound.
    """
    spark = docs.sparkSession
    write_token_files(docs, path := shared_path(spark, "tokens"), tokenizer_path, end_id, shard_tokens, id_col, text_col)
    stored_documents(token_files(spark, path)).write.parquet(read := shared_path(spark, "token-documents"))
    found = spark.read.schema("group int, number int, doc_id long, at long, n_tokens long, ids_crc32 long").parquet(read)
    return with_starts(found).select(F.col("doc_id").alias(id_col), "start", "n_tokens", "ids_crc32")


def token_occurrences(files: DataFrame, token: int) -> DataFrame:
    """(doc_id, at) of every place of a token, counted from the start of its document, by select in each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for matrix in opened(batches):
            at = matrix.occurrences(token)
            doc = np.searchsorted(matrix.starts, at, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(matrix.doc_ids[doc], mask=matrix.missing[doc]), pa.array(at - matrix.starts[doc])], ["doc_id", "at"])

    return files.mapInArrow(run, "doc_id long, at long")


def token_frequencies(files: DataFrame, tokens: list[int]) -> DataFrame:
    """(token, n) of these tokens over all files, by rank in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for matrix in opened(batches):
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array([matrix.count(t) for t in tokens], pa.int64())], ["token", "n"])

    return files.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
