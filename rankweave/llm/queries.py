"""One query for each operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.llm import alignment, byte_bpe, collocations, lines, lm, packing, pii, pipeline, quality, sharding, simhash, tokenfile, urls, vectors
from rankweave.session import scratch_path

URL_RULES = (
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode_documents(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, digests=True)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    packed = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumn("piece", F.col("piece").cast("int"))


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_table(spark, sf_dir, "documents"))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "text", "deleted_lines")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(_table(spark, sf_dir, "documents"))
    grown = F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", grown, "n_tokens")


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_ids(_table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pii_spans(_table(spark, sf_dir, "documents"))

    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(pii.spans_as_text(of(*pii.BASE_KINDS)), 256).alias("base_sha256"),
        pii.spans_as_text(F.col("spans")).alias("spans"),
    )


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "judged.*")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(_table(spark, sf_dir, "documents"))
    named = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[f"stats.{c}" for c in named], "base_failed", "kept", "quality")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_documents(_table(spark, sf_dir, "documents"), *names)


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    tokenfile.write_ids(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return tokenfile.read_documents(spark, path, digests=True)


OP9_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

# A line goes if it lies in a run of 50 words or more that has an earlier place. The shortest such runs, down
# from each line and up to each line, have all of them.
OP4_SQL = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no
  FROM documents
), worded AS (
  SELECT doc_id, no, md5(line) AS h, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM split
), numbered AS (
  SELECT doc_id, no, h, w, row_number() OVER (PARTITION BY doc_id ORDER BY no) - 1 AS pos,
         coalesce(sum(w) OVER (PARTITION BY doc_id ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS c
  FROM worded WHERE w > 0
), runs AS (
  SELECT doc_id, md5(array_to_string(list(h) OVER down, '')) AS run, pos AS first, max(pos) OVER down AS last, sum(w) OVER down AS words
  FROM numbered WINDOW down AS (PARTITION BY doc_id ORDER BY c RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION ALL
  SELECT doc_id, md5(array_to_string(list(h) OVER up, '')), min(pos) OVER up, pos, sum(w) OVER up
  FROM numbered WINDOW up AS (PARTITION BY doc_id ORDER BY c + w RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)
), firsts AS (
  SELECT run, min({'doc_id': doc_id, 'first': first}) AS home FROM runs WHERE words >= 50 GROUP BY run
), copies AS (
  SELECT DISTINCT r.doc_id, a.no AS first, b.no AS last
  FROM runs r JOIN firsts f USING (run)
  JOIN numbered a ON a.doc_id = r.doc_id AND a.pos = r.first JOIN numbered b ON b.doc_id = r.doc_id AND b.pos = r.last
  WHERE r.words >= 50 AND (r.doc_id <> f.home.doc_id OR r.first <> f.home.first)
), kept AS (
  SELECT s.doc_id, s.no, s.line FROM split s
  WHERE NOT EXISTS (SELECT 1 FROM copies r WHERE r.doc_id = s.doc_id AND s.no BETWEEN r.first AND r.last)
), joined AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY no) AS text, count(*) AS n FROM kept GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(j.text, '') END AS text,
       coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(j.n, 0) AS deleted_lines
FROM documents d LEFT JOIN joined j USING (doc_id)
"""

OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
), sized AS (
  SELECT lang, w, unnest(range(1, least(len(w), 5) + 1)) AS size FROM worded
), grams AS (
  SELECT lang, size, w[i:i + size - 1] AS p FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized)
), counted AS (
  SELECT lang, p, any_value(size) AS size, count(*) AS a FROM grams GROUP BY lang, p
), candidates AS (
  SELECT * FROM counted WHERE size > 1 AND a >= 100
), smaller AS (
  SELECT lang, p, size, a, unnest(range(2, size)) AS m FROM candidates
), inside AS (
  SELECT lang, p[i:i + m - 1] AS p, max(a) AS longer
  FROM (SELECT lang, p, a, m, unnest(range(1, size - m + 2)) AS i FROM smaller) GROUP BY 1, 2
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inside i ON c.lang = i.lang AND c.p = i.p WHERE i.longer IS NULL OR 100 * i.longer < 100 * c.a
), cuts AS (
  SELECT lang, p, size, a, unnest(range(1, size)) AS k FROM kept
), scored AS (
  SELECT c.lang, c.p, c.a, c.k, x.a AS l, y.a AS r, t.n, ((1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.p = c.p[1:c.k] JOIN counted y ON y.lang = c.lang AND y.p = c.p[c.k + 1:]
  JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= 2000
"""

QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_packing": op2_packing,
    "op3_lm": op3_lm,
    "op4_lines": op4_lines,
    "op5_sharding": op5_sharding,
    "op6_vectors": op6_vectors,
    "op7_simhash": op7_simhash,
    "op8_pii": op8_pii,
    "op9_urls": op9_urls,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_alignment": op12_alignment,
    "op13_token_files": op13_token_files,
    "pipeline": pipeline.run,
}

ORACLE_SQL = {"op4_lines": OP4_SQL, "op9_urls": OP9_SQL, "op11_collocations": OP11_SQL}
