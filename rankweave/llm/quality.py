"""Document quality by weak supervision: rules vote or abstain, EM learns how far to trust each."""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rankweave.session import staged

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
STATS = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_caps n_exclaims n_distinct n_ends n_plain".split()
STATS_TYPE = StructType([StructField(name, LongType()) for name in STATS])


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = bytearray(len(words))
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered[i : i + 3] = b"\1\1\1"
    return sum(covered)


def _bare(word: str) -> str:
    return word.strip(".,;:!?'\"()")


def measure(text: str | None) -> tuple[int, ...]:
    """The counts named in ``STATS``; a null text has no words and no lines."""
    if not text:
        return (0,) * len(STATS)
    words = text.encode("utf-8", "replace").split()
    upper, lower = (t.encode("utf-8", "replace").split() for t in (text.upper(), text.lower()))
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(w == u != v for w, u, v in zip(words, upper, lower)),
        text.count("!"),
        len(set(words)),
        sum(w.endswith((b".", b"!", b"?")) for w in words),
        sum(map(str.isalpha, map(_bare, text.split()))),
    )


@F.pandas_udf(STATS_TYPE)
def text_stats(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in texts], columns=STATS, dtype="int64")


#: So marked that the optimizer does not copy it into a filter and measure every text twice.
text_stats = text_stats.asNondeterministic()


def votes(s: str) -> dict[str, Column]:
    """Each rule's vote on the statistics column ``s``: b(ad), g(ood), or - where it abstains.

    Most rules know one kind of junk and say nothing about other documents.
    """

    def v(name: str) -> Column:
        return F.col(f"{s}.{name}")

    words, lines = v("n_words"), v("n_lines")
    natural = v("n_plain") - v("n_caps")
    bad = {
        "length": words < 20,
        "word_length": (v("word_chars") < 2 * words) | (v("word_chars") > 20 * words),
        "symbols": 10 * v("n_symbols") > words,
        "repeats": 100 * v("n_repeat_words") > 30 * words,
        "lines": (lines >= 4) & (2 * v("n_dup_lines") > lines),
        "capitals": (words >= 20) & (10 * v("n_caps") > 3 * words),
        "exclaims": (words >= 20) & (5 * v("n_exclaims") > words),
        "variety": (words >= 20) & (10 * v("n_distinct") < words),
        "plain_words": 2 * natural < words,
        "sentences": 2 * v("n_ends") > words,
    }
    good = {
        "plain_words": 10 * natural >= 8 * words,
        "sentences": (v("n_ends") > 0) & (3 * v("n_ends") < words),
    }
    never = F.lit(False)
    return {name: F.when(b, "b").when(good.get(name, never), "g").otherwise("-") for name, b in bad.items()}


def vote_pattern(s: str) -> Column:
    return F.concat(*votes(s).values())


#: A rule says "bad" of a good document at most this often; rules are written to be that careful.
FALSE_ALARMS = 0.01


def fit_label_model(counts: dict[str, int], rounds: int = 60) -> dict[str, float]:
    """Posterior probability of good quality for every vote pattern seen, by expectation-maximisation.

    A document is good or bad, and a rule votes bad, good or abstains at rates of its own in each class,
    as the kinds of junk differ and a "good" vote of one rule says little about another kind. Those
    rates and the share of good documents are estimated together. Priors worth a few documents settle
    which class is which, and decide alone where there are few documents or few votes.
    """
    if not counts:
        return {}
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], dtype=float)
    said = np.array([list(p) for p in patterns])
    votes_by_kind = np.stack([said == kind for kind in "bg-"]).astype(float)
    # Prior rates of b, g and - in the bad and the good class, worth ten documents each.
    prior = np.array([[0.4, 0.2, 0.4], [0.005, 0.6, 0.395]])
    rates, share = np.repeat(prior[:, :, None], said.shape[1], axis=2), 0.85
    for _ in range(rounds):
        q = _posterior(votes_by_kind, share, rates)
        for k, weight in enumerate((n * (1 - q), n * q)):
            rates[k] = (np.einsum("p,vpr->vr", weight, votes_by_kind) + 10 * prior[k][:, None]) / (weight.sum() + 10)
        over = np.maximum(rates[1, 0] - FALSE_ALARMS, 0)
        rates[1, 0] -= over
        rates[1, 2] += over
        share = (n @ q + 8.5) / (n.sum() + 10)
    return dict(zip(patterns, _posterior(votes_by_kind, share, rates).tolist()))


def _posterior(votes_by_kind: np.ndarray, share: float, rates: np.ndarray) -> np.ndarray:
    bad, good = np.einsum("vpr,kvr->kp", votes_by_kind, np.log(rates))
    return 1 / (1 + np.exp(np.clip(bad - good + np.log((1 - share) / share), -700, 700)))


def base_failed(s: str) -> Column:
    words = F.col(f"{s}.n_words")
    return (words < 50) | (100 * F.col(f"{s}.n_repeat_words") > 50 * words)


def quality_probability(measured: DataFrame, s: str, name: str) -> DataFrame:
    """Add ``name``, the probability of good quality, to rows that hold statistics in column ``s``.

    The model is fitted on the counts of vote patterns over all rows: at most 3 to the number of rules
    of them, whatever the number of documents, which also bounds the table joined back.
    """
    spark = measured.sparkSession
    tallied = measured.groupBy(vote_pattern(s).alias("p")).count().collect()
    posterior = fit_label_model({r["p"]: r["count"] for r in tallied})
    votes = f"_{uuid.uuid4().hex}"
    table = spark.createDataFrame(list(posterior.items()), f"{votes} string, {name} double")
    return measured.withColumn(votes, vote_pattern(s)).join(F.broadcast(table), votes, "left").drop(votes)


def judge_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``stats``, ``base_failed``, ``quality`` (posterior), ``kept``.

    Null and empty texts have no words, so they fail the base rule. Repeated rows and null ids are rows
    like others. Other columns are not read. The statistics, which hold no text, are staged once, as
    they serve the fit and the result.
    """
    measured = staged(docs.select(F.col(doc_id).alias("doc_id"), text_stats(F.col(text)).alias("_stats")), "quality")
    failed = base_failed("_stats")
    return quality_probability(measured, "_stats", "_quality").select(
        "doc_id",
        F.col("_stats").alias("stats"),
        failed.alias("base_failed"),
        F.col("_quality").alias("quality"),
        (~failed & (F.col("_quality") >= 0.5)).alias("kept"),
    )


def drop_low_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged.

    Texts are measured in place, once for the fit and once for the filter, so no text is shuffled and
    rows need no unique id.
    """
    stats, probability = (f"_{uuid.uuid4().hex}" for _ in range(2))  # the caller's columns may have any name
    judged = quality_probability(docs.withColumn(stats, text_stats(F.col(text))), stats, probability)
    return judged.where(~base_failed(stats) & (F.col(probability) >= 0.5)).select(*[F.col(f"`{c}`") for c in docs.columns])
