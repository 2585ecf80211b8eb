"""Quality classifier: evidence of each document combined with hierarchical posteriors of its host and path."""

from __future__ import annotations

import math
import operator
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import once, shared_path, slices, text_bytes

FEATURES = 1 << 18
LABELLED_ROWS = 40_000
LEAST_Z = 5.0
LEAST_RATIO = 20
CACHED_WORDS = 100_000
TARGETS = ("low", "toxic")
MEASURES = ("upper", "symbols", "marks", "runs", "lines")
BINS = 24
ALL = FEATURES + len(MEASURES) * BINS
LETTERS = bytes(range(65, 91))
PLAIN = bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), *b" .,\n"])


def shares(text: bytes, words: list[bytes]) -> dict[str, float]:
    """Surface measures of a text, each from 0 to 1."""
    n, size = max(1, len(words)), max(1, len(text))
    lines = text.split(b"\n")
    return {
        "upper": 1 - len(text.translate(None, LETTERS)) / size,
        "symbols": len(text.translate(None, PLAIN)) / size,
        "marks": text.count(b"!") / n,
        "runs": sum(map(operator.eq, words, words[1:])) / n,
        "lines": 1 - len(set(lines)) / len(lines),
    }


def feature(name: bytes) -> int:
    return zlib.crc32(name) % FEATURES


def surface(name: str, share: float) -> int:
    return FEATURES + MEASURES.index(name) * BINS + min(BINS - 1, int(2 * -math.log2(share + 2.0**-12)))


class Features:
    """Feature numbers of texts: words, the first four bytes of words, and binned surface measures.

    With ``chosen`` only those features are looked for.
    """

    def __init__(self, chosen: frozenset[int] | None = None):
        self.chosen, self.kept = chosen, {}

    def _of_word(self, word: bytes) -> tuple[int, ...]:
        found = self.kept.get(word)
        if found is None:
            found = (feature(word.strip(b".,;:")), feature(b"\x01" + word[:4]))
            if self.chosen is not None:
                found = tuple(f for f in found if f in self.chosen)
            if len(self.kept) < CACHED_WORDS:
                self.kept[word] = found
        return found

    def of(self, text: bytes) -> set[int]:
        words = text.lower().split()
        out: set[int] = set()
        for found in filter(None, map(self._of_word, set(words))):
            out.update(found)
        for name, share in shares(text, words).items():
            f = surface(name, share)
            if self.chosen is None or f in self.chosen:
                out.add(f)
        return out


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(text, y, fold) of at most ``bound`` labelled texts; y is 0 for fine, 1 for low quality, 2 for toxic.

    The labels are those with the smallest hashes of their ids, so the sample does not depend on the order
    of rows; of equal texts one counts. One half, by another hash, is to learn from, the other to calibrate.
    """
    bad = F.when(F.col("quality") == 0, 1).when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0)
    chosen = (labels.select(F.col("doc_id").cast("long").alias("id"), bad.alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
              .groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(bound))
    met = docs.select("id", "text").join(F.broadcast(chosen), "id")  # at most ``bound`` rows
    one = met.groupBy(F.xxhash64("text").alias("h")).agg(F.min_by(F.struct("text", "y"), "id").alias("m"))
    return one.select("m.text", "m.y", F.pmod(F.xxhash64("h", F.lit(1)), F.lit(2)).alias("fold")).checkpoint()


def labelled_counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How many texts are fine, of low quality and toxic, and in how many of each every feature stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, own = np.zeros((ALL + 1, 3), np.int64), Features()
        for batch in slices(batches, "text"):
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                number[list(own.of(text)), y] += 1
                number[ALL, y] += 1
        rows = np.flatnonzero(number.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int32)), *(pa.array(number[rows, i]) for i in range(3))], ["f", "n0", "n1", "n2"])

    found = (sample.where("fold = 0").select("text", "y").mapInArrow(run, "f int, n0 long, n1 long, n2 long")
             .groupBy("f").agg(*(F.sum(f"n{i}").alias(f"n{i}") for i in range(3))).collect())  # at most ALL + 1 rows
    number = np.zeros((ALL + 1, 3))
    for r in found:
        number[r["f"]] = r[1:]
    return number[ALL], number[:ALL]


def evidence_weights(total: np.ndarray, number: np.ndarray) -> list[dict[int, float]]:
    """For each target the log likelihood ratios of its features.

    Low quality shows in the surface: all its bins count. Toxicity shows in words: those count that stand
    clearly more often, and at least ``LEAST_RATIO`` times as often, in toxic texts as in others.
    """
    low = [{}, {}]
    for y in (1, 2):
        n1, n0 = total[y], total.sum() - total[y]
        a, b = number[:, y], number.sum(1) - number[:, y]
        p = (a + b + 1) / (n1 + n0 + 2)
        z = (a / max(n1, 1) - b / max(n0, 1)) / np.sqrt(p * (1 - p) * (1 / max(n1, 1) + 1 / max(n0, 1)))
        ratio = np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1))
        clear = (z >= LEAST_Z) & (ratio >= math.log(LEAST_RATIO)) & (np.arange(ALL) < FEATURES)
        keep = np.flatnonzero(clear if y == 2 else (np.arange(ALL) >= FEATURES) & (a + b > 0)) if n1 and n0 else ()
        low[y - 1] = {int(f): float(ratio[f]) for f in keep}
    return low


def document_evidence(docs: DataFrame, weights: list[dict[int, float]]) -> DataFrame:
    """(row, e_low, e_toxic) for (row, text): summed log likelihood ratios of the features of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # at most ALL numbers each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = once(shared, lambda w: Features(frozenset({*w[0], *w[1]})))
        low, toxic = shared.value
        for batch in slices(batches, "text"):
            found = [own.of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array([math.fsum(w[f] for f in fs if f in w) for fs in found], pa.float64()) for w in (low, toxic))],
                ["row", "e_low", "e_toxic"])

    kind = docs.schema["row"].dataType.simpleString()
    return docs.mapInArrow(run, f"row {kind}, e_low double, e_toxic double")


def calibration(evidence: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """(slope, shift) that turn summed ratios into a log likelihood ratio: a logistic fit by Newton's method.

    Features are not independent, so their sum claims too much; the shift leaves out the rate of bad texts.
    """
    x = np.stack([np.clip(evidence, -50, 50), np.ones(len(evidence))], 1)
    w = np.zeros(2)
    if not 0 < bad.sum() < len(bad):
        return 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (bad - p) - 1e-3 * w)
        w += np.clip(step, -2, 2)
    rate = bad.mean()
    return float(w[0]), float(w[1] - math.log(rate / (1 - rate)))


def learned(docs: DataFrame, labels: DataFrame, bound: int) -> tuple[list[dict[int, float]], list[tuple[float, float]], dict[str, float]]:
    """Feature weights, calibration and global rate of each target."""
    sample = labelled_sample(docs, labels, bound)
    total, number = labelled_counts(sample)
    weights = evidence_weights(total, number)
    other = document_evidence(sample.where("fold = 1").select(F.col("y").alias("row"), "text"), weights).collect()  # at most ``bound`` rows
    e = np.array([r[1:] for r in other] or np.zeros((0, 2)), np.float64)
    y = np.array([r[0] for r in other], np.int64)
    rates = {t: float((total[i + 1] + 0.5) / (total.sum() + 50)) for i, t in enumerate(TARGETS)}
    return weights, [calibration(e[:, i], (y == i + 1).astype(np.float64)) for i in range(2)], rates


def posterior(evidence: Column, rate: Column) -> Column:
    """The probability after evidence (a log likelihood ratio) that starts at ``rate``."""
    return 1 / (1 + F.exp(-(F.least(F.greatest(evidence, F.lit(-30.0)), F.lit(30.0)) + F.log(rate / (1 - rate)))))


def site_rates(scored: DataFrame, rates: dict[str, float], strength: float) -> DataFrame:
    """(host, path, and for each target its rate at the host and at the path), by grouped aggregation.

    A host's rate is its expected share of bad documents, drawn to the global rate as if by ``strength``
    further documents; a path's is drawn to its host's in the same way, so sparse sites differ little from
    what stands above them.
    """
    by_path = scored.groupBy("host", "path").agg(F.count("*").alias("n"), *(F.sum(posterior(F.col(f"e_{t}"), F.lit(rates[t]))).alias(f"s_{t}") for t in TARGETS))
    by_host = by_path.groupBy(F.col("host").alias("_host")).agg(F.sum("n").alias("hn"), *(F.sum(f"s_{t}").alias(f"h_{t}") for t in TARGETS))
    host = {t: (F.col(f"h_{t}") + strength * rates[t]) / (F.col("hn") + strength) for t in TARGETS}
    joined = by_path.join(by_host, F.col("host").eqNullSafe(F.col("_host")))
    return joined.select("host", "path", *(host[t].alias(f"host_{t}") for t in TARGETS),
                         *(((F.col(f"s_{t}") + strength * host[t]) / (F.col("n") + strength)).alias(f"path_{t}") for t in TARGETS))


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, strength: float = 50.0, limit: float = 0.5,
             bound: int = LABELLED_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, key, host, path, evidence, site rates, p_low, p_toxic and rejected.

    ``labels`` (doc_id, quality 0/1, toxic 0/1) are used up to ``bound`` rows, all else covers every row. A
    document is rejected if its probability of low quality, or of being toxic, exceeds ``limit``: its own
    evidence on top of the rate at its path. Texts are read once to learn and once to score and are not
    shuffled; evidence, host and path are written to the shared folder. ``key`` is a hash of id and text.

    Without labels, or with labels of one kind only, there is no evidence and the global rate is small.
    Null and empty texts have the evidence of their surface alone; rows with null hosts or paths share a
    site; rows with null ids are scored like others. Repeated rows are scored alike; conflicting labels of
    one id count as the worse; an empty table gives no rows, and other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), key_of(id_col, text_col).alias("key"), text_bytes(text_col).alias("text"),
                       host.alias("host"), path.alias("path"))
    weights, fits, rates = learned(rows, labels, bound)
    found = document_evidence(rows.select(F.struct("id", "key", "host", "path").alias("row"), "text"), weights)
    scaled = (F.lit(a) * F.least(F.greatest(f"e_{t}", F.lit(-50.0)), F.lit(50.0)) + F.lit(b) for t, (a, b) in zip(TARGETS, fits, strict=True))
    found = found.select("row.*", *(c.alias(f"e_{t}") for t, c in zip(TARGETS, scaled, strict=True)))
    found.write.parquet(where := shared_path(spark, "quality"))
    scored = spark.read.schema(found.schema).parquet(where)
    sites = site_rates(scored, rates, strength).withColumnsRenamed({"host": "_host", "path": "_path"})
    met = scored.join(sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path"))).drop("_host", "_path")
    met = met.withColumns({f"p_{t}": posterior(F.col(f"e_{t}"), F.col(f"path_{t}")) for t in TARGETS})
    return met.withColumn("rejected", F.greatest("p_low", "p_toxic") > limit).withColumnRenamed("id", id_col)


def key_of(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))


def accepted(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents that :func:`classify` does not reject, with all their columns."""
    gone = classify(docs, labels, host, path, id_col=id_col, text_col=text_col, **how).where("rejected").select(F.col("key").alias("_gone")).distinct()
    return docs.join(gone, key_of(id_col, text_col) == F.col("_gone"), "left_anti")
