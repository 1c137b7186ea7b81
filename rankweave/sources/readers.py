"""File sources: topics, answers, judgments, labelled pairs, runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankweave import schemas
from rankweave.functions.text import clean_text, words
from rankweave.operators.dedup import keep_last
from rankweave.operators.ranking import rank_run

Paths = str | Sequence[str]


def _list(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def file_position() -> Column:
    """Order of a row in its input: file name, block within the file, row within the block."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_records(spark: SparkSession, paths: Paths, schema: StructType, array: bool = False) -> DataFrame:
    """JSON records. ``array=True`` reads files holding one JSON array each.

    An array file cannot be split, so it is one task: convert large ones to JSON Lines or Parquet once.
    """
    return spark.read.schema(schema).option("multiLine", array).option("mode", "FAILFAST").json(_list(paths))


def load_topics(
    spark: SparkSession, paths: Paths, array: bool = False, unique_ids: bool = False
) -> DataFrame:
    """(query_id, query), cleaned; of records with one id the last wins.

    ``unique_ids=True`` promises that ids do not repeat and saves the shuffle.
    """
    raw = read_records(spark, paths, schemas.TOPICS_SIMPLE, array)
    topics = raw.select("query_id", "query", file_position().alias("_at"))
    if not unique_ids:
        topics = keep_last(topics, ["query_id"], F.col("_at"))
    return topics.select("query_id", clean_text(F.col("query")).alias("query"))


def _records(spark: SparkSession, paths: Paths, array: bool) -> DataFrame:
    """(_record, _at): JSON objects as maps, which hold a null under its key and nothing for a missing one."""
    strict = {"mode": "FAILFAST"}
    if not array:
        lines = spark.read.text(_list(paths))
        return lines.select(F.from_json("value", "map<string,string>", strict).alias("_record"), file_position().alias("_at"))
    files = spark.read.option("recursiveFileLookup", True).text(_list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("_file"), "value")
    parsed = files.select("_file", F.posexplode(F.from_json("value", "array<map<string,string>>", strict)).alias("_row", "_record"))
    return parsed.select("_record", F.struct("_file", "_row").alias("_at"))


def load_answers(
    spark: SparkSession,
    paths: Paths,
    array: bool = False,
    unique_ids: bool = False,
    keep_null_docs: bool = True,
) -> DataFrame:
    """(doc_id, text), cleaned; records without a ``doc`` key are dropped, the last of one id wins.

    A ``doc`` that is present but null is kept as ''; ``keep_null_docs=False`` drops it. ``array=True`` reads
    files that hold one JSON array each, every one of them in one task; their records are told apart the same way.
    """
    records = _records(spark, paths, array).where(F.map_contains_key("_record", "doc")).select(
        F.col("_record")["doc_id"].alias("doc_id"), F.col("_record")["doc"].alias("doc"), "_at"
    )
    if not keep_null_docs:
        records = records.where(F.col("doc").isNotNull())
    if not unique_ids:
        records = keep_last(records, ["doc_id"], F.col("_at"))
    return records.select("doc_id", clean_text(F.col("doc")).alias("text"))


def _judgment_lines(
    spark: SparkSession, paths: Paths, mode: str, observation: Observation | None
) -> DataFrame:
    lines = spark.read.text(_list(paths)).select(
        words(F.col("value")).alias("_fields"), file_position().alias("_at")
    )
    fields = F.col("_fields")
    if mode == "strict":
        checked = F.when(F.size(fields) == 4, fields).otherwise(
            F.raise_error(F.concat(F.lit("judgment line without 4 fields: "), F.concat_ws(" ", fields)))
        )
        lines = lines.select(checked.alias("_fields"), "_at")
    elif mode == "permissive":
        grade = F.get(fields, 3)
        good = (F.size(fields) == 4) & grade.rlike(r"^[+-]?\d+$") & grade.try_cast("int").isNotNull()
        if observation is not None:
            lines = lines.observe(observation, F.count_if(~good).alias("bad_lines"))
        lines = lines.where(good)
    else:
        raise ValueError(f"mode is strict or permissive, not {mode!r}")
    return lines.select(
        F.get(fields, 0).alias("query_id"),
        F.get(fields, 2).alias("doc_id"),
        F.get(fields, 3).cast("int").alias("relevance"),
        "_at",
    )


def parse_qrel(
    spark: SparkSession,
    paths: Paths,
    conflict: str = "last",
    mode: str = "strict",
    observation: Observation | None = None,
) -> DataFrame:
    """(query_id, doc_id, relevance) from whitespace-separated lines of four fields.

    ``conflict="last"``: the last grade of a (query, document) wins. ``conflict="keep_all"``: distinct
    triples, so differing grades of one document all stay. A malformed line fails a strict read; a
    permissive one leaves it out and counts it in ``observation`` as ``bad_lines``.
    """
    lines = _judgment_lines(spark, paths, mode, observation)
    if conflict == "last":
        return keep_last(lines, ["query_id", "doc_id"], F.col("_at")).drop("_at")
    if conflict == "keep_all":
        return lines.drop("_at").dropDuplicates(["query_id", "doc_id", "relevance"])
    raise ValueError(f"conflict is last or keep_all, not {conflict!r}")


def scan_pairs(spark: SparkSession, paths: Paths, array: bool = False) -> DataFrame:
    """Labelled pairs (query, query_id, doc, doc_id, score) with their split where it is partitioned."""
    return read_records(spark, paths, schemas.PAIRS, array)


def read_run(
    spark: SparkSession,
    paths: Paths,
    depth: int | None = None,
    whitespace: bool = False,
    mode: str = "strict",
    observation: Observation | None = None,
) -> DataFrame:
    """A run of six tab-separated columns, ranked by its scores.

    A (query, document) listed more than once keeps its highest score; the listed rank is only used to
    order equal scores. ``whitespace=True`` reads columns parted by any run of whitespace. A line without
    six fields, a whole rank and a finite score fails a strict read; a permissive one leaves it out and counts
    it in ``observation`` as ``bad_lines``.
    """
    value = F.col("value")
    fields = spark.read.text(_list(paths)).select((words(value) if whitespace else F.split(value, "\t")).alias("_f"), "value")
    at = [F.get("_f", i) for i in range(len(schemas.RUN.fields))]
    typed = [c.try_cast(f.dataType).alias(f.name) for c, f in zip(at, schemas.RUN.fields)]
    score = at[4].try_cast("double")
    good = (F.size("_f") == len(typed)) & at[3].try_cast("int").isNotNull() & score.isNotNull() & ~F.isnan(score) & (F.abs(score) < float("inf"))
    if mode == "strict":
        checked = F.when(good, F.col("_f")).otherwise(F.raise_error(F.concat(F.lit("malformed run line: "), "value")))
        fields = fields.select(checked.alias("_f"))
    elif mode == "permissive":
        if observation is not None:
            fields = fields.observe(observation, F.count_if(~F.coalesce(good, F.lit(False))).alias("bad_lines"))
        fields = fields.where(good)
    else:
        raise ValueError(f"mode is strict or permissive, not {mode!r}")
    best = fields.select(*typed).groupBy("query_id", "doc_id").agg(
        F.max("score").alias("score"), F.min("rank").alias("rank"), F.min("tag").alias("tag")
    )
    return rank_run(best.select("query_id", "doc_id", "rank", "score", "tag"), depth)


RAW_SCHEMAS = {"topics": schemas.TOPICS_RAW, "mixed topics": schemas.TOPICS_MIXED, "answers": schemas.ANSWERS_RAW}


def read_raw(spark: SparkSession, paths: Paths, kind: str, form: str = "lines") -> DataFrame:
    """The files users have, columns as they are: ``topics`` (Id, Title, Body), ``mixed topics`` (also
    query_id, query) or ``answers`` (Id, Text). ``form`` is lines (JSON Lines), array or parquet."""
    schema = RAW_SCHEMAS[kind]
    if form == "parquet":
        return spark.read.schema(schema).parquet(*_list(paths))
    if form not in ("lines", "array"):
        raise ValueError(f"form is lines, array or parquet, not {form!r}")
    return read_records(spark, paths, schema, array=form == "array")


def load_raw_answers(spark: SparkSession, paths: Paths, form: str = "lines") -> DataFrame:
    """(doc_id, text) of raw answers, not cleaned; records without an id or a text are left out."""
    raw = read_raw(spark, paths, "answers", form)
    return raw.where(F.col("Id").isNotNull() & F.col("Text").isNotNull()).select(F.col("Id").alias("doc_id"), F.col("Text").alias("text"))


def read_runs(
    spark: SparkSession, path: str, systems: Sequence[str] = (), topic_sets: Sequence[int] = (), tags: Sequence[str] = ()
) -> DataFrame:
    """Result sets of the run table at ``path``: those of the systems, topic sets and tags named, or all. Only
    their files are read."""
    runs = spark.read.schema(schemas.RUNS).parquet(path)
    for column, wanted in (("system", systems), ("topic_set", topic_sets), ("tag", tags)):
        if wanted:
            runs = runs.where(F.col(column).isin(*wanted))
    return runs
