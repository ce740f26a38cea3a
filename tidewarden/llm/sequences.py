"""Token-id output in training order.

Documents are tokenised and joined, with a closing id after each, into sequences of fixed length; every input task fills
its own, so that one short sequence a task is the only padding. A keyed Feistel network with cycle walking permutes the
sequence numbers [0, N) onto global slots [0, N); a slot's shard and byte offset follow by arithmetic. Each task of the
second pass owns whole shards, sorts its slots and writes them as fixed-stride rows under a temporary name that is then
renamed: a lost executor's shard is simply written again, and shards that are already whole are kept on a rerun.

N must be known before the first slot: the first pass tokenises, writes each task's ids, compressed, into the shared folder
and counts them; the second deals those ids out and deletes them as they are used, before the first shard is written. The
second pass reads the texts too, to count its rows. A task that runs again after its ids were used tokenises its texts anew, as
does a second evaluation, and raises unless the ids are those counted. Nothing but one row of numbers a task reaches the driver.

Defined results: null texts are empty and give the closing id alone; null keys don't matter, as order comes from the
input's tasks; an empty table writes an empty manifest and no shard; repeated rows are written each; other columns are
not read. The input must split alike in both passes, as files do: materialise others first; a task that finds another split
raises, and so does an id that doesn't fit ``bytes_per_id``. Writing to a place that is in use replaces its manifest, keeps
shards whose bytes are what would be written, and writes the others anew.
"""

from __future__ import annotations

import contextlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import new_path, slots, table

LENGTH = 2048
PER_SHARD = 2048
PIECE = 1 << 16  # ids compressed or read at a time
KEY = 20240229
ROUNDS = 6
KEPT = "task long, attempt long, n_rows long, n_ids long, crc long"
ROWS = "sequence_id long, slot long, n_tokens long, ids_crc32 long, ids binary"
OUT = "slot long, sequence_id long, shard long, byte_offset long, n_tokens long, ids_crc32 long"


def _mix(x: np.ndarray, k: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + np.uint64(k & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, n: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed bijection of [0, n), evaluated for each index on its own."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):  # walk on while the cycle is outside the domain
        x = out[todo]
        left, right = x >> np.uint64(half), x & low
        for r in range(rounds):
            left, right = right, left ^ (_mix(right, key * 1_000_003 + r * 7919) & low)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def _tokenised(batches: Iterator[pa.RecordBatch], path: str, quick: bool) -> Iterator[np.ndarray]:
    """Each document's ids, closed."""
    encode = tokens.encoder(path, quick)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            yield np.append(encode(text or ""), np.uint32(tokens.END))


def _joined(runs: Iterator[np.ndarray], length: int) -> Iterator[np.ndarray]:
    """The runs one after another, in pieces of whole multiples of length; the last may be short."""
    parts, have = [], 0
    for ids in runs:
        parts.append(ids)
        have += len(ids)
        if have >= length:
            whole = np.concatenate(parts)
            edge = have - have % length
            yield whole[:edge]
            parts, have = [whole[edge:]], have - edge
    if have:
        yield np.concatenate(parts)


def _filled(runs: Iterator[np.ndarray], length: int) -> Iterator[np.ndarray]:
    """The task's sequences; the last may be short."""
    for piece in _joined(runs, length):
        yield from (piece[k : k + length] for k in range(0, len(piece), length))


def _kept(source: pa.NativeFile, kind: str) -> Iterator[np.ndarray]:
    """The ids that the first pass has kept."""
    with source:
        while data := source.read(PIECE * np.dtype(kind).itemsize):
            yield np.frombuffer(data, kind)


def write_shards(docs: DataFrame, uri: str, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY, vocabulary: str | None = None, bytes_per_id: int = 2) -> DataFrame:
    """Write shard files and ``manifest.json`` under uri when evaluated; one row per sequence, with its place.

    ``bytes_per_id`` is 2 for vocabularies below 65,536 ids, else 4.
    """
    spark, path = docs.sparkSession, vocabulary or tokens.vocabulary()
    kind, stride = f"<u{bytes_per_id}", length * bytes_per_id
    texts, quick = docs.select(F.col("text").cast("string").alias("text")), tokens.quick_is_equal(path)

    kept = new_path(spark, "ids")
    kept_fs, kept_root = fs.FileSystem.from_uri(kept)
    kept_fs.create_dir(kept_root, recursive=True)

    def place(task: int, attempt: int) -> tuple[fs.FileSystem, str]:
        kept_fs, kept_root = fs.FileSystem.from_uri(kept)
        return kept_fs, f"{kept_root}/task-{task:08d}-{attempt}.zst"

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, attempt, n_rows, n_ids, crc = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0, 0, 0

        def counted() -> Iterator[pa.RecordBatch]:
            nonlocal n_rows
            for batch in batches:
                n_rows += batch.num_rows
                yield batch

        kept_fs, name = place(task, attempt)
        with kept_fs.open_output_stream(name, compression="zstd") as f:
            for ids in _joined(_tokenised(counted(), path, quick), PIECE):
                if ids.max() >> (8 * bytes_per_id):
                    raise ValueError(f"id {ids.max()} does not fit {bytes_per_id} bytes")
                data = ids.astype(kind).tobytes()
                f.write(data)
                n_ids, crc = n_ids + len(ids), zlib.crc32(data, crc)
        yield pa.RecordBatch.from_pydict({"task": [task], "attempt": [attempt], "n_rows": [n_rows], "n_ids": [n_ids], "crc": [crc]})

    first, total = {}, 0
    for task, attempt, n_rows, n_ids, crc in sorted(texts.mapInArrow(keep, KEPT).collect()):  # one row a task
        first[task], total = (total, attempt, n_rows, n_ids, crc), total + -(-n_ids // length)
    target, root = fs.FileSystem.from_uri(uri)
    target.create_dir(root, recursive=True)
    with target.open_output_stream(f"{root}/manifest.json") as f:
        f.write(json.dumps({"sequences": total, "length": length, "bytes_per_id": bytes_per_id, "per_shard": per_shard, "key": key, "rounds": ROUNDS}).encode())

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        if task not in first:
            raise RuntimeError(f"task {task} had no rows when sequences were counted: the input was split in another way")
        begin, attempt, n_rows, n_ids, crc = first[task]
        kept_fs, name = place(task, attempt)
        found, found_crc, rows = 0, 0, []
        try:
            source = kept_fs.open_input_stream(name, compression="zstd")
        except FileNotFoundError:  # used before
            source = None
        if source and (seen := sum(b.num_rows for b in batches)) != n_rows:
            raise RuntimeError(f"task {task} had {n_rows} rows when sequences were counted and {seen} now: the input was split in another way")

        def frame() -> pa.RecordBatch:
            number, n_tokens, crc, ids = zip(*rows)
            slot = permute(np.array(number, np.int64), total, key)
            return pa.RecordBatch.from_pydict({"sequence_id": number, "slot": slot, "n_tokens": n_tokens, "ids_crc32": crc, "ids": pa.array(ids, pa.binary())})

        for k, ids in enumerate(_filled(_kept(source, kind) if source else _tokenised(batches, path, quick), length)):
            data = ids.astype(kind).tobytes()
            rows.append((begin + k, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), data.ljust(stride, b"\0")))
            found, found_crc = found + len(ids), zlib.crc32(data, found_crc)
            if len(rows) == 1024:
                yield frame()
                rows = []
        if (found, found_crc) != (n_ids, crc):
            raise RuntimeError(f"task {task} made {found} ids, not the {n_ids} that were counted: the input was split in another way")
        if rows:
            yield frame()
        if source:
            with contextlib.suppress(FileNotFoundError):  # another attempt of this task
                kept_fs.delete_file(name)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out_fs, out_root = fs.FileSystem.from_uri(uri)
        shard, rows = None, []

        def held(name: str) -> bool:
            with out_fs.open_input_stream(name) as f:
                return all(f.read(stride) == r.ids for r in rows)

        def close() -> pd.DataFrame:
            name = f"{out_root}/shard-{shard:08d}.bin"
            info = out_fs.get_file_info(name)
            if info.size != len(rows) * stride or not held(name):  # a shard is whole or not there, or another corpus's
                temporary = f"{name}.{TaskContext.get().taskAttemptId()}.tmp"
                with out_fs.open_output_stream(temporary) as f:
                    for r in rows:
                        f.write(r.ids)
                if info.is_file:
                    out_fs.delete_file(name)
                out_fs.move(temporary, name)
            return pd.DataFrame([(r.slot, r.sequence_id, shard, (r.slot - shard * per_shard) * stride, r.n_tokens, r.ids_crc32) for r in rows], columns=[c.split()[0] for c in OUT.split(", ")])

        for batch in batches:
            for r in batch.itertuples(index=False):
                if r.slot // per_shard != shard:
                    if rows:
                        yield close()
                    shard, rows = r.slot // per_shard, []
                rows.append(r)
        if rows:
            yield close()

    made = texts.mapInArrow(sequences, ROWS)
    shards = max(1, -(-total // per_shard))
    parts = min(shards, slots(spark))
    # Slots are dense and uniform, so ranges of equal width are even: no sampling pass is needed for the range partitions.
    owner = F.floor(F.floor(F.col("slot") / per_shard) * parts / shards).cast("int")
    return made.repartitionById(parts, owner).sortWithinPartitions("slot").mapInPandas(write, OUT)


def read_slots(uri: str, start: int = 0, stop: int | None = None) -> Iterator[np.ndarray]:
    """The sequences of slots start to stop, in training order; any start resumes with one seek."""
    source, root = fs.FileSystem.from_uri(uri)
    with source.open_input_stream(f"{root}/manifest.json") as f:
        m = json.loads(f.read())
    stride, per = m["length"] * m["bytes_per_id"], m["per_shard"]
    at, end = start, m["sequences"] if stop is None else min(stop, m["sequences"])
    while at < end:
        with source.open_input_file(f"{root}/shard-{at // per:08d}.bin") as f:
            f.seek(at % per * stride)
            for _ in range(min(end, (at // per + 1) * per) - at):
                yield np.frombuffer(f.read(stride), f"<u{m['bytes_per_id']}")
                at += 1


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_shards(table(spark, sf_dir, "documents"), new_path(spark, "shards"))
