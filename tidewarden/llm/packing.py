"""Best-fit packing of documents into sequences of fixed capacity by linear grouping.

Documents are tokenised once and cut into pieces of at most ``capacity`` ids; only (length, count) pairs, at most
``capacity`` of them at any size of input, reach the driver. There the large lengths are sorted into groups of equal
cardinality and rounded up to their group's largest; configurations of these few sizes are optimised by column generation
with knapsack pricing; actual lengths are substituted for the rounded ones; what rounding left over, and the small
lengths, then go to the fullest sequence that takes them (best fit, worked on counts of equal sequences at once).

The plan names for every length which ranks go to which sequence and offset. Ranks are dealt without gathering a length
in one task: each task numbers its own pieces of a length, and per-task counts give the offsets. The plan's size depends
on the capacity alone, so it is broadcast.

Defined results: null texts are empty ones, and hold the closing id alone; a null doc_id stays null; repeated rows are
packed each; texts of any length are cut, never shortened; an empty table gives no sequences; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import materialise, slots, table

CAPACITY = 2048
GROUPS = 512
#: Lengths above capacity / LARGE are large.
LARGE = 4
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all full, but for the first."""
    first = n % capacity
    edges = ([0, first] if first else [0]) + list(range(first + capacity, n + 1, capacity))
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    path = vocabulary or tokens.vocabulary()
    quick = tokens.quick_is_equal(path)

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, task = tokens.encoder(path, quick), TaskContext.get().partitionId()
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch["doc_id"], batch["text"]):
                ids = encode(text or "").astype("<u4")
                data = ids.tobytes() + b"\0\0\0\0"
                for k, (start, length) in enumerate(cut(len(ids) + 1, capacity)):
                    rows.append((None if pd.isna(key) else int(key), k, start, length, zlib.crc32(data[4 * start : 4 * (start + length)]), task))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "task"]).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(pieces, PIECES)


def grouped(hist: dict[int, int], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(rounded size, [(length, count), ...])], longest first, of equal cardinality but for the last."""
    share = max(1, -(-sum(hist.values()) // groups))
    out: list[tuple[int, list[tuple[int, int]]]] = []
    room = 0
    for length in sorted(hist, reverse=True):
        n = hist[length]
        while n:
            if not room:
                out.append((length, []))
                room = share
            k = min(n, room)
            out[-1][1].append((length, k))
            n, room = n - k, room - k
    merged: dict[int, list[tuple[int, int]]] = {}  # groups of the same size are one size
    for s, members in out:
        merged.setdefault(s, []).extend(members)
    return sorted(merged.items(), reverse=True)


def best_pattern(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, list[int]]:
    """Unbounded knapsack: the most valuable multiset of sizes within the capacity."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for i, s in enumerate(sizes):
        if values[i] <= 1e-12:
            continue
        for a in range(s, capacity + 1, s):  # one block of width s depends only on the block before
            b = min(a + s, capacity + 1)
            cand = best[a - s : b - s] + values[i]
            better = cand > best[a:b] + 1e-15
            best[a:b] = np.where(better, cand, best[a:b])
            last[a:b] = np.where(better, i, last[a:b])
    pattern, room = [0] * len(sizes), capacity
    while room > 0 and last[room] >= 0:
        pattern[last[room]] += 1
        room -= sizes[last[room]]
    return float(best[capacity]), pattern


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 2000) -> list[tuple[list[int], int]]:
    """Patterns and how often to use each, together within the demand: the rounded-down optimum of the covering LP."""
    m = len(sizes)
    if not m:
        return []
    base = [[capacity // s if i == j else 0 for i in range(m)] for j, s in enumerate(sizes)]
    inverse = np.diag([1.0 / (capacity // s) for s in sizes])
    x = np.array(demand, float) * np.diag(inverse)
    for _ in range(rounds):
        dual = inverse.sum(axis=0)  # all costs are one
        value, pattern = best_pattern(sizes, dual, capacity)
        if value <= 1 + 1e-9:
            break
        column = inverse @ np.array(pattern, float)
        up = column > 1e-9
        if not up.any():
            break
        ratio = np.where(up, x / np.where(up, column, 1), np.inf)
        r = int(np.argmin(ratio))
        x = x - ratio[r] * column
        x[r] = ratio[r]
        inverse[r] /= column[r]
        others = np.arange(m) != r
        inverse[others] -= np.outer(column[others], inverse[r])
        base[r] = pattern
    out, left = [], list(demand)
    for pattern, n in sorted(zip(base, x), key=lambda p: -p[1]):
        k = int(n + 1e-6)
        k = min([k] + [left[i] // c for i, c in enumerate(pattern) if c])
        if k > 0:
            out.append((pattern, k))
            left = [a - k * c for a, c in zip(left, pattern)]
    return out


def plan(hist: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: int = LARGE) -> pd.DataFrame:
    """Rows (length, rank_from, rank_to, first_sequence, offset): ranks of a length to consecutive sequences."""
    blocks: list[tuple[int, list[int]]] = []  # (how many equal sequences, lengths in each)
    rest = {k: n for k, n in hist.items() if n and k <= capacity // large}
    sized = grouped({k: n for k, n in hist.items() if n and k > capacity // large}, groups)
    queues = [list(members)[::-1] for _, members in sized]
    for pattern, n in configurations([s for s, _ in sized], [sum(c for _, c in g) for _, g in sized], capacity):
        parts = [i for i, c in enumerate(pattern) for _ in range(c)]
        while n:  # substitute actual lengths, as many sequences at once as have the same
            need = {i: parts.count(i) for i in parts}
            step = min([n] + [max(1, queues[i][-1][1] // need[i]) for i in need])
            taken = []
            for i in need:
                if queues[i][-1][1] >= step * need[i]:
                    length, have = queues[i].pop()
                    taken += [length] * need[i]
                    if have > step * need[i]:
                        queues[i].append((length, have - step * need[i]))
                else:  # one sequence, from the last of one length and the first of the next
                    for _ in range(need[i]):
                        length, have = queues[i].pop()
                        taken.append(length)
                        if have > 1:
                            queues[i].append((length, have - 1))
            blocks.append((step, taken))
            n -= step
    for q in queues:
        for length, n in q:
            rest[length] = rest.get(length, 0) + n

    open_: dict[int, list[tuple[int, list[int]]]] = {}
    room: list[int] = []  # sorted residual capacities that some sequences have

    def put(n: int, lengths: list[int]) -> None:
        r = capacity - sum(lengths)
        if r not in open_:
            open_[r] = []
            insort(room, r)
        open_[r].append((n, lengths))

    for n, lengths in blocks:
        put(n, lengths)
    for length in sorted(rest, reverse=True):
        n = rest[length]
        while n:
            at = bisect_left(room, length)
            if at == len(room):
                each = capacity // length
                if n >= each:
                    put(n // each, [length] * each)
                if n % each:
                    put(1, [length] * (n % each))
                break
            r = room[at]
            have, lengths = open_[r].pop()
            if not open_[r]:
                del open_[r]
                room.pop(at)
            k = min(n, have)
            if have > k:
                put(have - k, lengths)
            put(k, lengths + [length])
            n -= k

    rows, ranks, sequence = [], {}, 0
    for r in room:
        for n, lengths in open_[r]:
            offset = 0
            for length in lengths:
                a = ranks.get(length, 0)
                rows.append((length, a, a + n, sequence, offset))
                ranks[length] = a + n
                offset += length
            sequence += n
    return pd.DataFrame(rows, columns=["length", "rank_from", "rank_to", "first_sequence", "offset"])


def ranked(pieces: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0 without gaps within each length, with no task that holds a whole length."""
    local = Window.partitionBy("length", "task").orderBy("doc_id", "piece", "ids_crc32")
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("length", "task", before.alias("_before"))
    return pieces.withColumn("_rank", F.row_number().over(local) - 1).join(offsets, ["length", "task"]).withColumn("rank", F.col("_rank") + F.col("_before")).drop("_rank", "_before")


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece."""
    spark = docs.sparkSession
    pieces = materialise(pieces_of(docs, capacity, vocabulary), "pieces")
    hist = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    made = plan(hist, capacity).sort_values(["length", "rank_from"])
    by_length = {int(k): tuple(g[c].to_numpy(np.int64) for c in ("rank_from", "first_sequence", "offset")) for k, g in made.groupby("length")}
    shared = spark.sparkContext.broadcast(by_length)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(np.int64), batch["rank"].to_numpy(np.int64)
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for k in np.unique(length):
                rows = np.nonzero(length == k)[0]
                start, first, at = shared.value[int(k)]
                i = np.searchsorted(start, rank[rows], side="right") - 1
                sequence[rows] = first[i] + rank[rows] - start[i]
                offset[rows] = at[i]
            yield batch.drop(columns=["rank"]).assign(sequence_id=sequence, offset=offset)

    out = ranked(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return out.mapInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
