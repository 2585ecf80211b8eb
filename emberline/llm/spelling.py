"""Spelling variants: words one edit apart, found by pivotal bigrams against gram prefixes, and their usual forms."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import shared_path, slices, text_bytes

# Fixed values of the word definition: the letters of a run, and how often a run is garbled.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
GARBLED = 199
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
HELD_WORDS = 200_000
PREFIX = 3  # bigrams of which one edit touches two at most
PIVOTS = 2  # disjoint bigrams of which one edit touches one at most


def counted_runs(docs: DataFrame, least_letters: int, id_col: str, text_col: str) -> DataFrame:
    """(word, n) parts of the counts of all runs of letters, summed over up to ``HELD_WORDS`` words in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in slices(batches, "_text"):
            for name, text in zip(batch.column("_name").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                own = Counter(RUN.findall(text.decode("utf-8", "replace").translate(UPPER)))
                start = zlib.crc32(f"{name}:".encode())
                for word, n in own.items():
                    if len(word) < least_letters:
                        continue  # a garbled run is shorter still
                    h = zlib.crc32(word.encode(), start)
                    if h % GARBLED == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least_letters:
                            continue
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_name"), text_bytes(text_col).alias("_text"))
    return rows.mapInArrow(run, "word string, n long")


def pivots(places: list[int], costs: list[int]) -> list[int]:
    """The two disjoint bigrams, by start, of least total cost: the best choice of k among the first i, for all i and k."""
    order = sorted(range(len(places)), key=lambda i: places[i])
    best: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ())] + [None] * PIVOTS]
    for i, one in enumerate(order):
        row = list(best[i])
        clear = i
        while clear and places[order[clear - 1]] > places[one] - 2:
            clear -= 1
        for k in range(1, PIVOTS + 1):
            before = best[clear][k - 1]
            if before is not None:
                taken = before[0] + costs[one], (*before[1], places[one])
                if row[k] is None or taken < row[k]:
                    row[k] = taken
        best.append(row)
    return list(best[-1][PIVOTS][1])


def gram_counts(words: DataFrame) -> DataFrame:
    """(gram, n): in how many words each bigram stands. There are at most 90 x 90 of them, the letters of a run squared."""
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr("word", i, F.lit(2))))
    return words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


def spared(word: str, at: int) -> Iterator[str]:
    """What two words have in common, written alike in both, if one edit tells them apart and spares the bigram at ``at``.

    All letters on one side of the bigram are spared, so it stands equally far from that end. Of the rest, cut in
    half where the shorter rest of the two words is, one half is spared: the first letters or the last ones.
    """
    for side, same, rest in (("<", word[:at + 2], word[at + 2:]), (">", word[at:], word[:at])):
        for least in (len(rest), len(rest) - 1):
            if least < 0:
                continue
            half = least // 2
            yield f"{side}{same}{least}[{rest[:half]}"
            yield f"{side}{same}{least}]{rest[len(rest) - (least - half):]}"


def keyed(words: DataFrame, counts: dict[str, int]) -> DataFrame:
    """(word, pivot, last, key): the keys of what an edit may spare, for the grams of each prefix and for the pivots.

    Grams are ordered by their count, then by themselves. The prefix of a word is its first ``PREFIX`` bigrams in that
    order and all others equal to the last of them; ``last`` is the place of that one in the order.
    """
    place = {g: i for i, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, kinds, lasts, keys = [], [], [], []
            for at, word in enumerate(batch.column("word").to_pylist()):
                grams = [place[word[i:i + 2]] for i in range(len(word) - 1)]
                order = sorted(range(len(grams)), key=lambda i: (grams[i], i))
                last = grams[order[PREFIX - 1]]
                chosen = pivots(order[:PREFIX], [counts[word[i:i + 2]] for i in order[:PREFIX]])
                for kind, those in ((False, [i for i in order if grams[i] <= last]), (True, chosen)):
                    found = {xxhash.xxh3_64_intdigest(text, grams[i]) - (1 << 63) for i in those for text in spared(word, i)}
                    names += [at] * len(found)
                    kinds += [kind] * len(found)
                    lasts += [last] * len(found)
                    keys += found
            yield pa.RecordBatch.from_arrays(
                [batch.column("word").take(pa.array(names, pa.int32())), pa.array(kinds, pa.bool_()), pa.array(lasts, pa.int32()), pa.array(keys, pa.int64())],
                ["word", "pivot", "last", "key"])

    return words.select("word").mapInArrow(run, "word string, pivot boolean, last int, key long")


def near_words(words: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of distinct words (word) of four letters or more that differ by exactly one inserted, deleted or replaced letter.

    Of two words the one whose prefix ends earlier in the order of grams has its pivots in the prefix of the
    other, unless an edit touched them, and one edit spares one of two disjoint pivots. So pivots are joined
    with prefixes on what the edit spared, the bigram with its position from one end included, and what meets is verified.
    Nothing is capped; the join is by hash of the key, and skewed keys are split by Spark.
    """
    spark = words.sparkSession
    counts = {r["gram"]: r["n"] for r in gram_counts(words).collect()}  # 8,100 rows at most
    keyed(words, counts).write.parquet(path := shared_path(spark, "grams"))
    rows = spark.read.schema("word string, pivot boolean, last int, key long").parquet(path)
    index = rows.where("NOT pivot").select(F.col("word").alias("s"), F.col("last").alias("s_last"), "key")
    probes = rows.where("pivot").select(F.col("word").alias("r"), F.col("last").alias("r_last"), "key")
    met = probes.join(index, "key").where("r_last <= s_last AND r <> s AND abs(length(r) - length(s)) <= 1")
    near = met.where(F.levenshtein("r", "s", 1) == 1)
    return near.select(F.least("r", "s").alias("a"), F.greatest("r", "s").alias("b")).distinct()


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each chain of forms. Counts grow along a chain, so there are no circles.

    Every step joins each word's goal with the goal of that goal, so chains shorten by half.
    """
    goals = forms.select("word", F.coalesce("form", "word").alias("goal")).checkpoint()
    while True:
        further = goals.select(F.col("word").alias("goal"), F.col("goal").alias("next"))
        moved = goals.join(further, "goal").select("word", F.col("next").alias("goal"), (F.col("goal") != F.col("next")).alias("moved")).checkpoint()
        goals = moved.select("word", "goal")
        if not moved.where("moved").limit(1).count():
            return goals.withColumnRenamed("goal", "root")


def variants(
    docs: DataFrame, least_letters: int = 6, least_count: int = 5, ratio: int = 5, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of all texts.

    Words are runs of Western letters, A-Z lower-cased, of at least ``least_letters`` letters (four or more) and ``least_count``
    occurrences; a run is garbled in one of 199 documents, as the word definition has it. The form of a word is its most
    frequent near word (ties: the smallest), if that is at least ``ratio`` times as frequent; the root is where the
    forms end, the word itself where it has none.

    Null, empty and letterless texts have no words; a null id counts as an empty one; repeated rows count each; a
    run of any length is a word; empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    counted = counted_runs(docs, least_letters, id_col, text_col).groupBy("word").agg(F.sum("n").alias("n"))
    counted.where(F.col("n") >= least_count).write.parquet(path := shared_path(spark, "words"))
    words = spark.read.schema("word string, n long").parquet(path)
    near_words(words).write.parquet(path := shared_path(spark, "near-words"))
    pairs = spark.read.schema("a string, b string").parquet(path)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    known = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    first = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))  # UTF-8 order is code-point order
    best = known.groupBy("word").agg(F.count("*").alias("n_near"), first.alias("first"))
    usual = -F.col("first.less") >= ratio * F.col("n")
    (words.join(best, "word", "left")
     .select("word", F.when(usual, F.col("first.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
             F.when(usual, -F.col("first.less")).alias("form_n"))
     .write.parquet(path := shared_path(spark, "forms")))
    forms = spark.read.schema("word string, form string, n long, n_near long, form_n long").parquet(path)
    return forms.join(roots_of(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
