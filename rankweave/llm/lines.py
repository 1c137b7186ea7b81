"""Line dedup by winnowing: fingerprints of line runs, joined and extended, later copies deleted.

DataFrame functions only, no Python on the executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rankweave.session import staged

WORD = r"[^\x20\x09-\x0D]+"
#: Words of the runs that are hashed, and of the repeated runs that are found without fail and deleted.
GRAM_WORDS, RUN_WORDS = 20, 50


def row_key(doc_id: str, text: str) -> Column:
    """One key for repeated rows, never null."""
    return F.concat_ws("|", F.xxhash64(text).cast("string"), F.col(doc_id).cast("string"))


def line_sequences(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(key, place, lines) of each different row: its lines with a word, as number, hash and words.

    ``place`` orders documents: by id with null last, then by text hash.
    """
    place = F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), F.xxhash64(text).alias("hash"))
    lines = F.transform(
        F.split(text, "\n"),
        lambda line, i: F.struct(i.alias("no"), F.md5(line.cast("binary")).alias("h"), F.regexp_count(line, F.lit(WORD)).alias("w")),
    )
    rows = docs.select(row_key(doc_id, text).alias("key"), place.alias("place"), F.filter(lines, lambda x: x["w"] > 0).alias("lines"))
    return rows.where(F.size("lines") > 0).groupBy("key").agg(F.first("place").alias("place"), F.first("lines").alias("lines"))


def line_fingerprints(sequences: DataFrame, gram_words: int = GRAM_WORDS, run_words: int = RUN_WORDS) -> DataFrame:
    """(gram, key, place, at): the winnowed fingerprints of every document, ``at`` its first line.

    A gram is the shortest run of lines from a line on that has ``gram_words`` words. Of the grams that
    start in the next ``run_words - gram_words`` words, the one with the smallest hash is selected, the
    last of equal ones. All of these lie inside any run of ``run_words`` words from there on, so two
    copies of such a run select the same.
    """
    rows = sequences.select("key", "place", F.posexplode("lines").alias("at", "line"))
    rows = rows.select("key", "place", "at", F.col("line.h").alias("h"), F.col("line.w").cast("long").alias("w"))
    whole = Window.partitionBy("key").orderBy("at")
    rows = rows.withColumn("c", F.coalesce(F.sum("w").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    by_words = Window.partitionBy("key").orderBy("c")
    gram = by_words.rangeBetween(0, gram_words - 1)
    rows = rows.withColumns({"run": F.collect_list("h").over(gram), "run_w": F.sum("w").over(gram)})
    hashed = F.when(F.col("run_w") >= gram_words, F.struct(F.md5(F.array_join("run", "").cast("binary")).alias("gram"), (-F.col("at")).alias("back")))
    rows = rows.select("key", "place", "at", "c", hashed.alias("hashed"))
    rows = rows.withColumn("picked", F.min("hashed").over(by_words.rangeBetween(0, run_words - gram_words)))
    changed = ~F.col("picked").eqNullSafe(F.lag("picked").over(by_words))
    rows = rows.withColumn("changed", changed).where("changed and picked is not null")
    return rows.select(F.col("picked.gram").alias("gram"), "key", "place", (-F.col("picked.back")).alias("at"))


def line_passages(sequences: DataFrame, marks: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """(gram, key, place, at): the shortest runs of ``run_words`` words from each line on, and up to each line.

    Every line of a longer run is in one of these that lies inside the run. ``marks`` has the lines of each
    document at which a repeated fingerprint begins; a run without one occurs once, and is left out.
    """
    marked = sequences.join(marks.hint("merge"), "key")
    rows = marked.select("key", "place", "marks", F.posexplode("lines").alias("at", "line"))
    words = F.col("line.w").cast("long").alias("w")
    rows = rows.select("key", "place", "at", F.col("line.h").alias("h"), words, F.array_contains("marks", F.col("at")).alias("mark"))
    rows = rows.withColumn("end", F.sum("w").over(Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("c", F.col("end") - F.col("w"))
    down = Window.partitionBy("key").orderBy("c").rangeBetween(0, run_words - 1)
    up = Window.partitionBy("key").orderBy("end").rangeBetween(-(run_words - 1), 0)

    def run(frame) -> Column:
        whole = (F.sum("w").over(frame) >= run_words) & F.max("mark").over(frame)
        gram = F.unhex(F.md5(F.array_join(F.collect_list("h").over(frame), "").cast("binary")))
        return F.when(whole, F.struct(gram.alias("gram"), F.min("at").over(frame).alias("at")))

    rows = rows.select("key", "place", run(down).alias("down"), run(up).alias("up"))
    both = rows.select("key", "place", F.explode(F.array_distinct(F.array("down", "up"))).alias("run")).where("run is not null")
    return both.select("run.gram", "key", "place", "run.at").distinct()


def first_places(places: DataFrame) -> DataFrame:
    """(gram, home_key, home_at) of the grams that have several places."""
    first = places.groupBy("gram").agg(F.min(F.struct("place", "at", "key")).alias("home"), F.count(F.lit(1)).alias("n"))
    return first.where("n > 1").select("gram", F.col("home.key").alias("home_key"), F.col("home.at").alias("home_at"))


def repeated_runs(sequences: DataFrame, gram_words: int = GRAM_WORDS, run_words: int = RUN_WORDS) -> DataFrame:
    """(key, runs): the ranges of line numbers to delete, for documents that have any.

    Each occurrence of a fingerprint is laid against its first occurrence alone, so a fingerprint found
    in very many documents gives one row for each of them. That occurrence may stand in another, shorter
    run; so the shortest runs of ``run_words`` words around repeated fingerprints are laid against their
    own first occurrences too, and no repeated run of ``run_words`` words is missed. Along a diagonal
    both documents are compared line by line, and runs of equal lines with ``run_words`` words or more are
    deleted from the later one. Every deleted line has an equal line at an earlier place, so the first one
    stays. Joins with lines or texts are sort-merge joins at every size: neither side of them has a bound.
    """
    prints = staged(line_fingerprints(sequences, gram_words, run_words), "line-fingerprints")
    repeated = staged(prints.join(staged(first_places(prints), "line-homes"), "gram"), "line-repeated")
    marks = repeated.groupBy("key").agg(F.collect_set("at").alias("marks"))
    passages = staged(line_passages(sequences, marks, run_words), "line-passages")
    whole = passages.join(staged(first_places(passages), "passage-homes"), "gram")
    columns = ["key", "at", "home_key", "home_at"]
    later = repeated.select(*columns).unionByName(whole.select(*columns)).where("key <> home_key or at <> home_at")
    diagonals = staged(later.select("key", "home_key", (F.col("at") - F.col("home_at")).alias("shift")).distinct(), "line-diagonals")
    own = sequences.select("key", "lines")
    home = sequences.select(F.col("key").alias("home_key"), F.col("lines.h").alias("home_h"))
    sides = diagonals.join(own.hint("merge"), "key").join(home.hint("merge"), "home_key")
    met = F.transform(
        "lines",
        lambda x, i: F.struct(i.alias("at"), x["no"].alias("no"), x["w"].alias("w"), (F.get("home_h", i - F.col("shift")) == x["h"]).alias("equal")),
    )
    equal = sides.select("key", "home_key", "shift", F.explode(F.filter(met, lambda x: x["equal"])).alias("line"))
    equal = equal.select("key", "home_key", "shift", "line.at", "line.no", "line.w")
    diagonal = ["key", "home_key", "shift"]
    island = F.col("at") - F.row_number().over(Window.partitionBy(*diagonal).orderBy("at"))
    runs = equal.withColumn("island", island).groupBy(*diagonal, "island").agg(
        F.min("no").alias("first"), F.max("no").alias("last"), F.sum("w").alias("words")
    )
    ranges = runs.where(F.col("words") >= run_words).select("key", F.struct("first", "last").alias("run"))
    return ranges.groupBy("key").agg(F.collect_set("run").alias("runs"))


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", gram_words: int = GRAM_WORDS, run_words: int = RUN_WORDS
) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from ``text``, and ``deleted_lines``.

    Lines end at ``\\n`` and are equal when all their characters are; lines without a word neither match
    nor stop a run, and go with the run around them. Documents are ordered by id (null last), then text hash; the
    first place of a run keeps it, also inside one document. Every row stays, with an empty text if all
    its lines went; null stays null. Repeated rows are one document and keep or lose the same lines. An
    existing column ``deleted_lines`` is replaced; columns of the caller named like inner ones do no harm.
    """
    sequences = staged(line_sequences(docs, doc_id, text), "line-sequences")
    # Names of this call alone, as the caller's columns may have any.
    line_key, run_key, found, left = (f"_{uuid.uuid4().hex}" for _ in range(4))
    runs = staged(repeated_runs(sequences, gram_words, run_words), "line-runs").select(F.col("key").alias(run_key), F.col("runs").alias(found))
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda _, i: ~F.exists(found, lambda r: (i >= r["first"]) & (i <= r["last"])))
    keyed = docs.withColumn(line_key, row_key(doc_id, text)).join(runs.hint("merge"), F.col(line_key) == F.col(run_key), "left")
    cut = F.col(found).isNotNull()
    keyed = keyed.withColumn(left, F.when(cut, kept))
    deleted = F.when(cut, F.size(lines) - F.size(left)).otherwise(0).cast("long")
    return keyed.withColumns({text: F.when(cut, F.array_join(left, "\n")).otherwise(F.col(text)), "deleted_lines": deleted}).drop(
        line_key, run_key, found, left
    )
