"""Best-fit packing of token pieces: a configuration program over the length histogram, rounded."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rankweave.llm.blocks import ragged
from rankweave.llm.ranks import spread_rank
from rankweave.llm.wordbpe import WordIds
from rankweave.session import staged

CAPACITY = 4096
#: Rounds in which the program covers all lengths alike; the share of a length's count that it may leave over;
#: how much a length's weight falls until it is covered (as a power of e); the shares of a sequence that a rounded configuration must fill, tried in turn.
STEPS, UNCOVERED, SHARPNESS, FILLS = 4, 0.02, 1.0, (0.9, 0.7, 0.5)

#: How often a set of lengths is used, and how many of each length it holds.
Configuration = tuple[int, dict[int, int]]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id 1, cut at ``capacity``.

    A null or empty text is the end id alone. Rows with one id are separate documents.
    """
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    counted = [StructField(c, LongType()) for c in ("piece", "start", "length", "ids_crc32")]
    schema = StructType([picked.schema["doc_id"], *counted])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(vocabulary)
        for batch in batches:
            ids, sizes = words.encode(batch.column(1))
            pieces = -(-sizes // capacity)
            source = np.repeat(np.arange(len(sizes)), pieces)
            piece = ragged(np.zeros(len(sizes), dtype=np.int64), pieces)
            start = piece * capacity
            length = np.minimum(sizes[source] - start, capacity)
            data = memoryview(ids.astype("<u4")).cast("B")
            lows = 4 * (np.cumsum(length) - length)
            sums = [zlib.crc32(data[a:b]) for a, b in zip(lows.tolist(), (lows + 4 * length).tolist())]
            columns = [pa.array(c, pa.int64()) for c in (piece, start, length, sums)]
            yield pa.record_batch([batch.column(0).take(pa.array(source)), *columns], names=schema.names)

    return picked.mapInArrow(cut, schema)


def price_table(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room up to ``capacity`` the value of the most valuable multiset of lengths that fits, and the
    place of a length that it holds (-1: as with one less room): unbounded knapsack by dynamic programming."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    usable = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if n := usable[room]:
            gains = best[room - lengths[:n]] + values[:n]
            top = int(gains.argmax())
            if gains[top] > best[room]:
                best[room], taken[room] = gains[top], top
    return best, taken


def held_in(taken: list[int], lengths: list[int], room: int) -> dict[int, int]:
    """The multiset behind a room of the table, by places of lengths."""
    held: dict[int, int] = {}
    while room > 0:
        at = taken[room]
        if at < 0:
            room -= 1
        else:
            held[at] = held.get(at, 0) + 1
            room -= lengths[at]
    return held


def priced(lengths: np.ndarray, values: np.ndarray, capacity: int) -> dict[int, int]:
    """The most valuable multiset of lengths that fits ``capacity``."""
    taken = price_table(lengths, values, capacity)[1]
    return {int(lengths[at]): k for at, k in held_in(taken.tolist(), lengths.tolist(), capacity).items()}


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int, steps: int = STEPS) -> list[tuple[float, dict[int, int]]]:
    """A solution of the configuration program by multiplicative weights: amounts of configurations that hold
    each length at least ``1 - UNCOVERED`` of its count, and none more than its count.

    A length's weight falls as its demand is covered. Each round makes one table of prices, which has for every
    length the most valuable configuration that holds it. Lengths behind the round's step use theirs, the
    longest first, until they reach it or another length of the configuration is used up; such lengths leave
    the program. After ``steps`` rounds others follow until all demand is covered: each covers one length at
    least.
    """
    demand = counts.astype(float)
    left = demand.copy()
    used: dict[tuple[tuple[int, int], ...], float] = {}
    step = 0
    while (open_ := np.flatnonzero(left > UNCOVERED * demand)).size:
        step += 1
        covered = 1.0 - left[open_] / demand[open_]
        # A length's own size is its value at the start, so that the first configurations are full.
        sizes = lengths[open_]
        _, taken = price_table(sizes, sizes * np.exp(-SHARPNESS * covered), capacity)
        taken, sizes, rest = taken.tolist(), sizes.tolist(), left[open_].tolist()
        # What a length may have left after this round's step.
        later = (demand[open_] * max(0.0, 1.0 - step / steps)).tolist()
        for at in range(len(sizes) - 1, -1, -1):
            if rest[at] <= later[at]:
                continue
            held = held_in(taken, sizes, capacity - sizes[at])
            held[at] = held.get(at, 0) + 1
            amount = min((rest[at] - later[at]) / held[at], *(rest[i] / k for i, k in held.items()))
            if amount <= 0.0:
                continue
            for i, k in held.items():
                rest[i] = max(0.0, rest[i] - amount * k)
            key = tuple(sorted((sizes[i], k) for i, k in held.items()))
            used[key] = used.get(key, 0.0) + amount
        left[open_] = rest
    return [(amount, dict(held)) for held, amount in used.items()]


def rounded(program: list[tuple[float, dict[int, int]]], left: dict[int, int], capacity: int) -> list[Configuration]:
    """Whole uses of the program's configurations, taken from ``left``, as many in all as the amounts.

    Each is used as often as its amount rounded down, then those of the largest remainders once more. A piece
    that an earlier one took is missing there; the fuller ones go first.
    """
    out: list[Configuration] = []
    whole = [int(amount + 1e-9) for amount, _ in program]
    for times, (_, held) in zip(whole, program):
        if times := min([times, *(left[length] // k for length, k in held.items())]):
            out.append((times, held))
            for length, k in held.items():
                left[length] -= times * k
    more = int(sum(amount for amount, _ in program)) - sum(times for times, _ in out)
    order = sorted(range(len(program)), key=lambda at: whole[at] - program[at][0])
    for least in FILLS:
        behind = []
        for at in order:
            there = {length: min(k, left[length]) for length, k in program[at][1].items() if left[length]}
            if more > 0 and there and sum(length * k for length, k in there.items()) >= least * capacity:
                more -= 1
                out.append((1, there))
                for length, k in there.items():
                    left[length] -= k
            else:
                behind.append(at)
        order = behind
    return out


def best_fit(counts: dict[int, int], capacity: int, begun: Sequence[Configuration] = ()) -> list[Configuration]:
    """Best fit of the longest first, on counts, into what is ``begun`` and new sequences: sequences alike
    are filled together."""
    open_at: dict[int, list[list]] = {}  # by room left: [number of sequences, what each holds]
    rooms = np.zeros(capacity + 1, dtype=bool)
    for number, held in begun:
        room = capacity - sum(length * k for length, k in held.items())
        open_at.setdefault(room, []).append([number, held])
        rooms[room] = True
    rooms[0] = False
    rooms_left = lambda need: need + int(rooms[need:].argmax()) if rooms[need:].any() else capacity + 1
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = rooms_left(length)
            if room > capacity:
                room, number, held = capacity, -(-left // (capacity // length)), {}
            else:
                number, held = open_at[room].pop()
                rooms[room] = bool(open_at[room])
            each = room // length
            full = min(number, left // each)
            parts = [(full, each)] if full else []
            left -= full * each
            if left and full < number:
                parts.append((1, left))
                full, left = full + 1, 0
            if number > full:
                parts.append((number - full, 0))
            for n, k in parts:
                rest = room - k * length
                open_at.setdefault(rest, []).append([n, held | {length: held.get(length, 0) + k} if k else held])
                rooms[rest] = True
    return [(n, held) for groups in open_at.values() for n, held in groups if held]


def configurations(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> list[Configuration]:
    """Configurations that hold every piece of the histogram exactly once: the program's solution, rounded;
    what rounding leaves over goes into the room that they have, or new ones, by best fit."""
    left = {int(length): int(n) for length, n in histogram.items() if n}
    if not left:
        return []
    lengths = np.array(sorted(left))
    counts = np.array([left[int(n)] for n in lengths])
    plan = rounded(fractional(lengths, counts, capacity, steps), left, capacity)
    return best_fit({length: n for length, n in left.items() if n}, capacity, plan)


def placements(plan: list[Configuration]) -> pd.DataFrame:
    """For each length and range of ranks: the first sequence, pieces per sequence and first offset."""
    rows, sequence, ranked = [], 0, {}
    for times, held in plan:
        offset = 0
        for length in sorted(held, reverse=True):
            low = ranked.get(length, 0)
            ranked[length] = high = low + times * held[length]
            rows.append((length, low, high, sequence, held[length], offset))
            offset += length * held[length]
        sequence += times
    return pd.DataFrame(rows, columns=["length", "_low", "_high", "_sequence", "_each", "_offset"], dtype="int64")


def pack(pieces: DataFrame, capacity: int = CAPACITY, steps: int = STEPS) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset: place in a sequence of ``capacity``.

    The driver sees the histogram of lengths, at most ``capacity`` counts, and makes a plan whose size
    depends on ``capacity`` and ``steps`` alone: a round uses a configuration for each length at most, one
    has at most sqrt(2 * capacity) different lengths, and best fit splits sequences alike at most twice for
    a length and room. Pieces
    are numbered inside their length, dealt over hash buckets, as one length may be most of all.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = placements(configurations(histogram, capacity, steps))
    fields = StructType([StructField(c, LongType()) for c in plan.columns])
    table = F.broadcast(spark.createDataFrame(plan, fields))
    salt = F.xxhash64("doc_id", "piece", "ids_crc32")
    ranked = spread_rank(pieces, "length", ["doc_id", "piece", "ids_crc32"], salt, sum(histogram.values()), "_rank")
    fits = (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high"))
    at = F.col("_rank") - F.col("_low")
    return (
        ranked.join(table.withColumnRenamed("length", "_length"), (F.col("length") == F.col("_length")) & fits)
        .withColumn("sequence_id", F.col("_sequence") + F.floor(at / F.col("_each")))
        .withColumn("offset", F.col("_offset") + F.pmod(at, F.col("_each")) * F.col("length"))
        .drop(*[f"_{c}" for c in ("rank", "length", "low", "high", "sequence", "each", "offset")])
    )


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token pieces of ``docs`` with their sequences; other columns are not read.

    The pieces, which hold no ids, are staged once: they serve the histogram and the placement.
    """
    return pack(staged(token_pieces(docs, vocabulary, capacity, doc_id, text), "pieces"), capacity)
