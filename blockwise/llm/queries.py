"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, attention_lm, bpe, dartminhash, divergence, fixity, langid, line_dedup, packing, pii, runs, vptree, wavelet
from .common import tokenizer_file, tokenizer_pattern


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of a damaged replica of all pages: of the ids by remainder of 97, one kind each is altered, lost or added."""
    pages = _table(spark, sf_dir, "pages")
    master = fixity.lay_out(pages, "page_id", fixity.warc_record(F.col("url"), F.col("html")))
    fate = F.col("record_id") % 97 * 41 % 97
    kept = master.filter(F.coalesce(fate != 1, F.lit(True)))
    copy = kept.withColumn("sha256", F.when(fate == 0, F.sha2("sha256", 256)).otherwise(F.col("sha256")))
    added = master.filter(fate == 2).select("shard", (F.col("offset") + 1).alias("offset"), F.lit(1).cast("long").alias("length"), "record_id", "sha256")
    return fixity.report(master, copy.unionByName(added))


OP1_SQL = """
WITH rec AS (
  SELECT page_id AS record_id,
         strlen('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
                || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))
                || repeat(chr(13) || chr(10), 2) || coalesce(html, '') || repeat(chr(13) || chr(10), 2)) AS length
  FROM pages),
laid AS (
  SELECT record_id, length, CAST(floor(record_id / 1024.0) AS BIGINT) AS shard,
         coalesce(sum(length) OVER (PARTITION BY floor(record_id / 1024.0) ORDER BY record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_,
         record_id % 97 * 41 % 97 AS fate
  FROM rec),
found AS (
  SELECT shard, start_ AS "offset", CASE fate WHEN 0 THEN 'altered' ELSE 'missing' END AS status, record_id, length FROM laid WHERE fate IN (0, 1)
  UNION ALL
  SELECT shard, start_ + 1, 'extra', record_id, 1 FROM laid WHERE fate = 2)
SELECT shard, CAST("offset" AS BIGINT) AS "offset", status, record_id, CAST(length AS BIGINT) AS length FROM found
UNION ALL
SELECT shard, CAST(0 AS BIGINT), 'intact', CAST(NULL AS BIGINT), CAST(sum(length) AS BIGINT) FROM laid
WHERE shard NOT IN (SELECT shard FROM found) GROUP BY shard
"""


def op2_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = wavelet.token_file(_table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_file("word_bpe_49k.json"), 2)
    return wavelet.decode_documents(shards).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_line_neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, counts=True)


OP3_SQL = """
WITH raw AS (SELECT doc_id, text, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS raw FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, text, pos, raw, trim(regexp_replace(raw, '[ \t\r]+', ' ', 'g'), ' ') AS line FROM raw),
long_lines AS (SELECT *, string_split(line, ' ') AS words FROM lines WHERE len(string_split(line, ' ')) >= 5),
firsts AS (SELECT line, words, min({'doc_id': doc_id, 'pos': pos}) AS first FROM long_lines GROUP BY line, words),
places AS (SELECT line, words, first, unnest(range(len(words))) AS p FROM firsts),
variants AS (
  SELECT line, first, len(words) AS n, p, 'r' AS role, array_to_string(list_concat(words[:p], [chr(1)], words[p + 2:]), ' ') AS v FROM places
  UNION ALL SELECT line, first, len(words) - 1, -1, 'd', array_to_string(list_concat(words[:p], words[p + 2:]), ' ') FROM places
  UNION ALL SELECT line, first, len(words), -1, 'w', line FROM firsts),
near AS (
  SELECT DISTINCT x.line FROM variants x JOIN variants y ON x.v = y.v AND x.n = y.n AND x.p = y.p AND y.first < x.first
  WHERE (x.role = 'r' AND y.role = 'r') OR (x.role = 'd' AND y.role = 'w') OR (x.role = 'w' AND y.role = 'd')),
kept AS (
  SELECT l.doc_id, l.text, l.pos, l.raw,
         f.line IS NOT NULL AND (n.line IS NOT NULL OR f.first <> {'doc_id': l.doc_id, 'pos': l.pos}) AS dropped
  FROM lines l LEFT JOIN firsts f ON f.line = l.line LEFT JOIN near n ON n.line = l.line)
SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT dropped), '') AS text,
       CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped
FROM kept GROUP BY doc_id
UNION ALL SELECT doc_id, text, 0, 0 FROM documents WHERE text IS NULL
"""


def op4_recursive_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = tokenizer_file("byte_bpe_50k.tiktoken"), tokenizer_pattern()
    both = _table(spark, sf_dir, "documents").select("doc_id", bpe.transcode(F.col("text"), path, pattern).alias("t"))
    return both.select("doc_id", (F.octet_length("t.ids") / 4).cast("long").alias("n_tokens"), F.sha2("t.ids", 256).alias("ids_sha256"),
                       F.sha2("t.decoded", 256).alias("decoded_sha256"))


def op5_ecoc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_vptree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0)


OP6_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


def op7_dartminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_duplicates(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").drop("n_rows")


def op8_nnls_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_file("byte_bpe_50k.json"), 1)
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op9_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.quality(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = attention_lm.score_texts(_table(spark, sf_dir, "documents"), "doc_id", "text",
                                      tokenizer_file("byte_bpe_50k.tiktoken"), tokenizer_pattern())
    return scored.withColumnRenamed("id", "doc_id")


def op12_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignment.invert(_table(spark, sf_dir, "documents"), "doc_id", "text",
                            tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"), digest=True)
    scored = alignment.score_documents(rows, alignment.pair_table(rows))
    return scored.withColumnsRenamed({"id": "doc_id", "groups": "groups_sha256"})


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; texts whose h = crc32(doc_id) is divisible by 10 repeat, from a word on, the words
    after it with a period, both chosen by g = h div 10."""
    h, g = "crc32(CAST(doc_id AS STRING))", "(crc32(CAST(doc_id AS STRING)) DIV 10)"
    chosen = docs.select("doc_id", "text", F.when(F.expr(f"{h} % 10 = 0"), F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))).alias("w"))
    sized = chosen.select("*", F.expr(f"CASE WHEN size(w) > 0 THEN CAST({g} % size(w) AS INT) END").alias("a"))
    timed = sized.select("*", F.expr(f"CAST(1 + (size(w) - a) DIV (3 + {g} % 8) AS INT)").alias("p"))
    planted = "array_join(transform(sequence(0, size(w) - 1), i -> w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END]), ' ')"
    return timed.select("doc_id", F.expr(f"CASE WHEN a IS NOT NULL THEN {planted} ELSE text END").alias("text"))


def op13_maximal_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(_table(spark, sf_dir, "documents"))
    found = docs.select("doc_id", runs.periodic_runs(F.col("text")).alias("f")).select("doc_id", "f.runs", "f.collapsed")
    best = F.expr("aggregate(runs, CAST(NULL AS struct<start:long,length:long,period:long>), "
                  "(m, r) -> IF(m IS NULL OR r.length * m.period > m.length * r.period, r, m))")
    every = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("m", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "m.start", "m.length", "m.period",
        F.expr("1000 * m.length DIV m.period").alias("exponent_milli"),
        F.sha2(every, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_merkle_fixity": op1_merkle_fixity, "op2_wavelet": op2_wavelet,
            "op3_line_neighbourhood": op3_line_neighbourhood, "op4_recursive_bpe": op4_recursive_bpe,
            "op5_ecoc_language": op5_ecoc_language, "op6_vptree_neighbours": op6_vptree_neighbours,
            "op7_dartminhash": op7_dartminhash,
            "op8_nnls_pack": op8_nnls_pack,
            "op9_divergence": op9_divergence, "op10_bootstrapped_pii": op10_bootstrapped_pii,
            "op11_attention_lm": op11_attention_lm, "op12_pair_bitmaps": op12_pair_bitmaps, "op13_maximal_pairs": op13_maximal_pairs}


def oracle_sql() -> dict[str, str]:
    return {"op1_merkle_fixity": OP1_SQL, "op3_line_neighbourhood": OP3_SQL, "op6_vptree_neighbours": OP6_SQL}
