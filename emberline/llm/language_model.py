"""Hashed maximum-entropy language model: n-gram and skip features, and a softmax factored by word class."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import once, shared_path, slices, text_bytes

WIDTH = 32  # classes, and words in a class of frequent words
FREQUENT_CLASSES = 16
FREQUENT = WIDTH * FREQUENT_CLASSES
RARE_CLASSES = WIDTH - FREQUENT_CLASSES
BEFORE = FREQUENT + RARE_CLASSES  # the number that stands for the time before a text
IDS = BEFORE + 1
PAIR_ROWS = 4096
# Rows of the weight table: classes by bias, last word, word before it, and hashed pair; words by class and context class.
BY_LAST, BY_SKIP, BY_PAIR = 1, 1 + IDS, 1 + 2 * IDS
IN_BIAS = BY_PAIR + PAIR_ROWS
IN_LAST = IN_BIAS + FREQUENT_CLASSES
IN_SKIP = IN_LAST + (WIDTH + 1) * FREQUENT_CLASSES
ROWS = IN_SKIP + (WIDTH + 1) * FREQUENT_CLASSES

END = b""
KEPT_COUNTS = 200_000
COUNTED_AT_ONCE = 500_000
BATCH = 16384
RATE = 0.15
ROUNDS = 2


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def rare_class(word: bytes) -> int:
    """The class of a word outside the frequent ones, by the end of its letters; endings tell languages apart."""
    return zlib.crc32(word.rstrip(b".,;:!?")[-2:]) % RARE_CLASSES


class Words:
    """Numbers and counts of the most frequent words; the first ``FREQUENT`` are modelled one by one."""

    def __init__(self, rows: list[tuple[bytes, int]]):
        self.index = {w: i for i, (w, _) in enumerate(rows)}
        self.count = np.array([n for _, n in rows] + [0], np.float64)
        self.id = np.array([i if i < FREQUENT else FREQUENT + rare_class(w) for i, (w, _) in enumerate(rows)] + [0], np.int32)

    def numbers(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Of all words of all texts: the place among the kept counts (-1 if absent) and the model's number."""
        find = self.index.get
        flat = [w for words in texts for w in words]
        place = np.fromiter((find(w, -1) for w in flat), np.int32, len(flat))
        ids = self.id[place]
        absent = np.flatnonzero(place < 0)
        ids[absent] = np.fromiter((FREQUENT + rare_class(flat[i]) for i in absent.tolist()), np.int32, len(absent))
        return place, ids


def class_of(ids: np.ndarray) -> np.ndarray:
    """0..15 for frequent words, dealt by rank; 16..31 for rare classes; 32 before a text."""
    return np.where(ids < FREQUENT, ids % FREQUENT_CLASSES, ids - FREQUENT + FREQUENT_CLASSES)


def contexts(ids: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, ...]:
    """For each word: the rows of its class features and, for frequent words, of its in-class features."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    last = np.concatenate([[BEFORE], ids[:-1]]).astype(np.int64)
    last[starts] = BEFORE
    skip = np.concatenate([[BEFORE], last[:-1]])
    skip[starts] = BEFORE
    pair = (skip * 0x9E3779B1 + last * 0x85EBCA6B >> 7) % PAIR_ROWS
    c = class_of(ids)
    word = np.where(ids < FREQUENT, ids // FREQUENT_CLASSES, -1)
    return (np.stack([BY_LAST + last, BY_SKIP + skip, BY_PAIR + pair]), c, word,
            np.stack([np.where(word < 0, 0, IN_BIAS + c), np.where(word < 0, 0, IN_LAST + class_of(last) * FREQUENT_CLASSES + c),
                      np.where(word < 0, 0, IN_SKIP + class_of(skip) * FREQUENT_CLASSES + c)]))


def log_softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(1, keepdims=True))


def log_probabilities(weights: np.ndarray, ids: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Natural logarithms: of the word for frequent words, of the class for others."""
    features, c, word, inner = contexts(ids, sizes)
    out = np.empty(len(ids))
    for a in range(0, len(ids), BATCH):
        s = slice(a, a + BATCH)
        found = log_softmax(weights[0] + weights[features[0, s]] + weights[features[1, s]] + weights[features[2, s]])
        out[s] = found[np.arange(len(found)), c[s]]
        own = np.flatnonzero(word[s] >= 0)
        found = log_softmax(weights[inner[0, s][own]] + weights[inner[1, s][own]] + weights[inner[2, s][own]])
        out[a + own] += found[np.arange(len(own)), word[s][own]]
    return out


class Trainer:
    """Gradient steps with a rate for each weight, from the weights that all tasks start with."""

    def __init__(self, weights: np.ndarray):
        self.start, self.weights = weights, weights.copy()
        self.squares = np.full(weights.shape, 1e-3, np.float32)
        self.seen = 0

    def _step(self, features: np.ndarray, target: np.ndarray, bias: bool) -> None:
        w = self.weights
        logits = w[features[0]] + w[features[1]] + w[features[2]]
        if bias:
            logits += w[0]
        gradient = np.exp(log_softmax(logits))
        gradient[np.arange(len(target)), target] -= 1
        for rows in features:
            order = np.argsort(rows, kind="stable")
            ordered = rows[order]
            edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            self._move(ordered[edge], np.add.reduceat(gradient[order], edge, axis=0))
        if bias:
            self._move(np.zeros(1, np.int64), gradient.sum(0, keepdims=True))

    def _move(self, rows: np.ndarray, gradient: np.ndarray) -> None:
        self.squares[rows] += gradient * gradient
        self.weights[rows] -= RATE * gradient / np.sqrt(self.squares[rows])

    def learn(self, ids: np.ndarray, sizes: list[int]) -> None:
        features, c, word, inner = contexts(ids, sizes)
        for a in range(0, len(ids), BATCH):
            s = slice(a, a + BATCH)
            self._step(features[:, s], c[s], True)
            own = np.flatnonzero(word[s] >= 0)
            if len(own):
                self._step(inner[:, s][:, own], word[s][own], False)
        self.seen += len(ids)


def starting_weights(rows: list[tuple[bytes, int]], rare_total: np.ndarray) -> np.ndarray:
    """Weights of the model without context: the counts of classes and of the words in them."""
    w = np.zeros((ROWS, WIDTH), np.float32)
    classes = np.full(WIDTH, 1.0)
    classes[FREQUENT_CLASSES:] += rare_total
    for i, (_, n) in enumerate(rows[:FREQUENT]):
        classes[i % FREQUENT_CLASSES] += n
        w[IN_BIAS + i % FREQUENT_CLASSES, i // FREQUENT_CLASSES] = math.log(n + 1)
    w[0] = np.log(classes)
    return w


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over the texts of (text): summed in tasks first, then by word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                held.update(tokens(text))
            if len(held) > COUNTED_AT_ONCE:
                yield out()
                held.clear()
        yield out()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame) -> list[tuple[bytes, int]]:
    """The most frequent words with their counts, at most ``KEPT_COUNTS``, all that reach some count.

    The count is found from a histogram over sixteenths of an octave (some hundred rows), so no task sends
    words that are not kept.
    """
    level = F.floor(F.log2(F.col("n")) * 16).cast("int")
    total, least = 0, None
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        total += r["count"]
        if total > KEPT_COUNTS:
            break
        least = r["level"]
    if least is None:
        return []
    return sorted(((bytes(r["word"]), r["n"]) for r in counts.where(level >= least).collect()), key=lambda x: (-x[1], x[0]))


def trained(spark, learning: DataFrame, words, weights: np.ndarray) -> np.ndarray:
    """One pass of distributed gradient updates over (id, text).

    The texts are dealt to ``ROUNDS`` rounds by a hash. In a round each task starts from the common weights,
    makes its steps and sends the rows it has changed; the changes are averaged by the words each task saw.
    The weight table has a fixed size, the changes grow with the tasks and are summed by row in Spark.
    """
    schema = "row int, seen long, " + ", ".join(f"c{i} double" for i in range(WIDTH))
    for number in range(ROUNDS):
        common = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], common=common) -> Iterator[pa.RecordBatch]:
            own, trainer = once(words, Words), Trainer(common.value)
            for batch in slices(batches, "text", 1 << 20):
                texts = [tokens(t) for t in batch.column("text").to_pylist()]
                trainer.learn(own.numbers(texts)[1], [len(t) for t in texts])
            change = (trainer.weights - trainer.start).astype(np.float64) * trainer.seen
            rows = np.flatnonzero((change != 0).any(1))
            arrays = [pa.array(np.append(rows, -1).astype(np.int32)), pa.array(np.append(np.zeros(len(rows), np.int64), trainer.seen))]
            arrays += [pa.array(np.append(change[rows, i], 0.0)) for i in range(WIDTH)]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "seen", *(f"c{i}" for i in range(WIDTH))])

        part = learning.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(ROUNDS)) == number).select("text")
        sums = part.mapInArrow(run, schema).groupBy("row").agg(F.sum("seen").alias("seen"), *(F.sum(f"c{i}").alias(f"c{i}") for i in range(WIDTH)))
        moved = sums.collect()  # at most ROWS + 1 rows
        seen = sum(r["seen"] for r in moved)
        weights = weights.copy()
        for r in moved:
            if r["row"] >= 0 and seen:
                weights[r["row"]] += np.array(r[2:], np.float64).astype(np.float32) / np.float32(seen)
        common.unpersist()
    return weights


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    The model learns from the rows that are not ``held_out``: counts of all their words, and one pass of
    gradient updates over all of them. ``base_score`` is the text's log10 probability by add-one counts;
    ``score`` that of the model: the class of each word from its context, then the word in its class, from
    its context for the ``FREQUENT`` most frequent words and by add-one counts in the class for others. A
    word that was never seen has the count 0 in its class.

    At most ``KEPT_COUNTS`` of the most frequent words and the weights, both of bounded size, go to every task; the other
    words of a text are looked up by a join on the word. Null text counts as empty: its end alone is scored.
    With nothing to learn from all counts are 0. Repeated rows are scored, and learnt from, each for itself;
    a null ``held_out`` counts as false; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    learning = rows.where(~F.col("held_out"))
    word_counts(learning).write.parquet(path := shared_path(spark, "lm-counts"))
    counts = spark.read.schema("word binary, n long").parquet(path)
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    kept = most_frequent(counts)

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = np.zeros(RARE_CLASSES, np.int64), np.zeros(RARE_CLASSES, np.int64)
        for batch in batches:
            c = np.fromiter(map(rare_class, batch.column("word").to_pylist()), np.int64, batch.num_rows)
            total += np.bincount(c, batch.column("n").to_numpy(), RARE_CLASSES).astype(np.int64)
            number += np.bincount(c, minlength=RARE_CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(range(RARE_CLASSES), pa.int32()), pa.array(total), pa.array(number)], ["class", "n", "v"])

    total, number = np.zeros(RARE_CLASSES), np.zeros(RARE_CLASSES)
    for r in counts.mapInArrow(classes, "class int, n long, v long").groupBy("class").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        total[r["class"]], number[r["class"]] = r["n"], r["v"]
    for w, n in kept[:FREQUENT]:
        total[rare_class(w)] -= n
        number[rare_class(w)] -= 1

    words = spark.sparkContext.broadcast(kept)
    weights = spark.sparkContext.broadcast(trained(spark, learning, words, starting_weights(kept, total)))
    spread = np.log10(total + number + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = once(words, Words)
        logs = np.log10(own.count + 1)
        for batch in slices(batches, "text", 1 << 20):
            texts = [tokens(t) for t in batch.column("text").to_pylist()]
            sizes = [len(t) for t in texts]
            place, ids = own.numbers(texts)
            known = place >= 0
            start = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            rare = ids >= FREQUENT
            model = log_probabilities(weights.value, ids, sizes) / math.log(10)
            model += np.where(rare, logs[place] * known - spread[np.maximum(ids - FREQUENT, 0)], 0.0)
            others, at = [], 0
            for t in texts:
                missing = np.flatnonzero(~known[at:at + len(t)]).tolist()
                others.append([{"word": w, "n": n} for w, n in Counter([t[i] for i in missing]).items()])
                at += len(t)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(sizes, pa.int64()),
                 pa.array(np.add.reduceat(known.astype(np.int64), start)), pa.array(np.add.reduceat(np.where(known, logs[place], 0.0), start)),
                 pa.array(np.add.reduceat(model, start)), pa.array(others, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))],
                ["id", "held_out", "n_tokens", "known", "logs", "model", "others"])

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, schema := (f"id {kind}, held_out boolean, n_tokens long, known long, logs double, model double, "
                                           "others array<struct<word:binary,n:long>>"))
    found.withColumn("row", F.monotonically_increasing_id()).write.parquet(path := shared_path(spark, "lm-scored"))
    found = spark.read.schema(f"{schema}, row long").parquet(path)
    looked = (found.select("row", F.explode("others").alias("o")).select("row", F.col("o.word").alias("word"), F.col("o.n").alias("times"))
              .join(counts, "word").groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs")))
    more, more_logs = F.coalesce("more", F.lit(0)), F.coalesce("more_logs", F.lit(0.0))
    return found.drop("others").join(looked, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + more).alias("n_known"), F.lit(size["n"]).cast("long").alias("train_tokens"),
        (F.col("logs") + more_logs - F.col("n_tokens") * math.log10(size["n"] + size["v"] + 1)).alias("base_score"),
        (F.col("model") + more_logs).alias("score"))
