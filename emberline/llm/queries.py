"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.llm import archives, contamination, language_model, licenses, neighbours, packing, quality, repeats, simhash, spelling, token_counts, token_files, whitening
from emberline.llm.common import table


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, budget=2)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document with a notice in its first or last paragraph speaks for its directory, one for each source, language and 1,000 ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan(docs, path, licence_file=F.col("place").isin("header", "footer"))


OP6_SQL = """
WITH templates(k, licence, body) AS (VALUES {templates}),
tw AS (SELECT k, licence, t, count(*) AS tf FROM (SELECT k, licence, unnest(regexp_extract_all(lower(body), '{token}')) AS t FROM templates) GROUP BY ALL),
idf AS (SELECT t, ln((1 + (SELECT count(*) FROM templates)) / (1.0 + count(DISTINCT k))) + 1 AS w FROM tw GROUP BY t),
tnorms AS (SELECT k, sqrt(sum((tf * w) ** 2)) AS norm FROM tw JOIN idf USING (t) GROUP BY k),
docs AS (SELECT doc_id, concat_ws('/', source, lang, doc_id // 1000, doc_id || '.txt') AS path,
                concat_ws('/', source, lang, doc_id // 1000) AS dir, text FROM documents),
paragraphs AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS pos, len(l) - 1 AS final, unnest(l) AS u FROM (
    SELECT doc_id, string_split_regex(regexp_replace(text, '{margin}', '', 'g'), '{gap}') AS l FROM docs)),
passages AS (SELECT * FROM paragraphs UNION SELECT doc_id, pos, final, unnest(string_split(u, chr(10))) FROM paragraphs),
held AS (SELECT * FROM passages WHERE {marks}),
counts AS (SELECT doc_id, pos, final, u, t, count(*) AS tf FROM (
    SELECT *, unnest(regexp_extract_all(lower(u), '{token}')) AS t FROM held) GROUP BY ALL),
norms AS (SELECT doc_id, pos, u, sqrt(sum(CASE WHEN w IS NULL THEN tf * {other} ** 2 ELSE (tf * w) ** 2 END)) AS norm FROM counts LEFT JOIN idf USING (t) GROUP BY ALL),
cosines AS (SELECT doc_id, pos, final, licence, round(sum(c.tf * tw.tf * w * w) / (any_value(n.norm) * any_value(tn.norm)), 4) AS score
            FROM counts c JOIN tw USING (t) JOIN idf USING (t) JOIN norms n USING (doc_id, pos, u) JOIN tnorms tn USING (k)
            GROUP BY doc_id, pos, final, u, k, licence),
best AS (SELECT doc_id, pos, final, licence, score FROM cosines WHERE score >= 0.75
         QUALIFY row_number() OVER (PARTITION BY doc_id, pos ORDER BY score DESC, licence) = 1),
own AS (SELECT doc_id, count(*) OVER (PARTITION BY doc_id) AS n_notices, licence, score, pos = 0 OR pos = final AS speaks FROM best
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) = 1),
files AS (SELECT docs.doc_id, path, dir, n_notices, licence, score, speaks FROM docs LEFT JOIN own USING (doc_id)),
speakers AS (SELECT dir AS up, path AS file, licence AS inherited FROM files WHERE speaks
             QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, path) = 1),
nearest AS (SELECT dir, file, inherited FROM (SELECT DISTINCT dir FROM docs) JOIN speakers ON dir = up OR up = '' OR starts_with(dir, up || '/')
            QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(up) DESC) = 1)
SELECT doc_id, path, coalesce(n_notices, 0) AS n_notices, score, coalesce(licence, inherited) AS licence,
       CASE WHEN licence IS NOT NULL THEN path ELSE file END AS origin
FROM files LEFT JOIN nearest USING (dir)
""".format(token=licenses.TOKEN, other=licenses.OTHER_WORD, margin=licenses.MARGIN, gap=licenses.GAP, marks=" OR ".join(f"contains(lower(u), '{m}')" for m in licenses.MARKS),
           templates=", ".join(f"({k}, '{n}', '{t}')" for k, (n, t) in enumerate(licenses.TEMPLATES)))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archives.convert_pages(table(spark, sf_dir, "pages"))
    return found.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
    return found.drop("key")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_neighbours, op2_simhash, op3_token_counts, op4_suffix_dedup, op5_decontamination, op6_licenses, op7_warc, op8_language_model,
    op9_quality, op10_packing, op11_token_files, op12_whitening, op13_spelling)}
ORACLES = {"op6_licenses": OP6_SQL}
