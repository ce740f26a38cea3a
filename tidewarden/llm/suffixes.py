"""Repeated passages by a depth-limited radix sort of suffixes.

Every byte position with ``depth`` bytes after it in its document is a suffix; suffixes are ordered only as far as that
depth, by most-significant-digit passes, and after the last pass the equal groups are exactly the repeated windows. A
suffix whose group holds one document only is done and leaves the sort, so that each pass moves far fewer than the one
before. Passes and their digits:

1. the anchor: the least hash among the k-grams inside the window, a digit that equal windows share wherever they stand.
   All suffixes with the same anchor position travel as one run (about one row for 16 suffixes), and runs of a hash range
   meet in one bucket;
2. the run: the bytes its windows span. A run whose bytes are those of an earlier document's run is settled as a whole;
3. the bytes: runs that share an anchor but not all their bytes are fetched, and their suffixes are refined by eight
   bytes at a time down to the depth, on the bytes themselves. An anchor with more than HOT such runs isn't gathered: its
   suffixes are settled within each task first, and what is least there is dealt out by all its digits at once.

Only anchors, runs, the few fetched contexts and the least suffixes of hot anchors are shuffled. Within a chunk of text, runs
equal to an earlier document's are settled before they are sent, so that a passage in a third of all documents sends one row
a chunk. The number of buckets follows from the bytes of the texts, so that a bucket holds the runs of about BUCKET_BYTES.
The anchor's hash only deals out work; a settled run agrees in two independent 64-bit hashes with the earlier one.

Defined results: null and empty texts have no bytes and nothing removed; rows of one doc_id never match each other,
repeated rows get the same result each; a null doc_id counts as larger than all others, and null ones don't match each
other; an empty table gives an empty result; texts of any length are cut into overlapping slices, which changes nothing
in the result; repeated rows of a key and text ask for their contexts once; other columns, whatever their names, come along untouched where the operator keeps rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, slots, table

DEPTH = 50
CHUNK = 1 << 20
#: Bytes of text a bucket; and runs to be refined that an anchor may have in one task.
BUCKET_BYTES, HOT = 1 << 25, 1 << 15
LAST = (1 << 63) - 1
BASE = 0x9E3779B97F4A7C15
RUNS = "kind int, bucket int, doc long, tag long, start long, stop long, blob binary"
DIGEST = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
SPANS = "kind int, doc long, tag long, start long, stop long, anchor long, rel int"
FIELDS = (("anchor", np.uint64), ("run", np.uint64), ("doc", np.int64), ("start", np.int64), ("tag", np.int64), ("width", np.uint8), ("rel", np.uint8))


def _table() -> np.ndarray:
    """A fixed pseudo-random 64-bit value for each byte."""
    return _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(x: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """For each length the polynomial hash of every window of that length, by doubling."""
    powers, power, n = {1: x}, BASE, 1
    base = {1: power}
    while n * 2 <= max(lengths):
        h = powers[n]
        powers[2 * n] = h[:-n] * np.uint64(power) + h[n:] if len(h) > n else h[:0]
        power, n = power * power & 0xFFFFFFFFFFFFFFFF, 2 * n
        base[n] = power
    out = []
    for length in lengths:
        done, h = 0, None
        for n in sorted(powers, reverse=True):
            if length & n:
                size = max(0, len(x) - done - n + 1)
                part = powers[n][done : done + size]
                h = part if h is None else h[:size] * np.uint64(base[n]) + part
                done += n
        out.append(h)
    return out


def runs_of(buf: np.ndarray, pieces: np.ndarray, values: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """(piece, first window, last window, anchor position, anchor, run) of the windows inside the pieces of buf.

    pieces: their lengths. Positions are those in buf.
    """
    k = max(1, depth * 2 // 5)
    w = depth - k + 1
    with np.errstate(over="ignore"):
        small, whole = window_hashes(values[buf], (k, depth))
        value = _mixed(small)
        place, n = np.arange(len(value), dtype=np.int32), 1
        kept = value
        while n * 2 <= w:  # leftmost least of n, then 2 n values
            right = kept[n:] < kept[:-n]
            place = np.where(right, place[n:], place[:-n])
            kept = np.where(right, kept[n:], kept[:-n])
            n *= 2
        if n < w:
            right = kept[w - n :] < kept[: n - w]
            place = np.where(right, place[w - n :], place[: n - w])
        ends = np.cumsum(pieces)
        fits = np.maximum(pieces - depth + 1, 0)
        q = np.arange(fits.sum()) + np.repeat(ends - pieces - (np.cumsum(fits) - fits), fits)
        owner = np.repeat(np.arange(len(pieces)), fits)
        at = place[q]
        new = np.ones(len(q), bool)
        new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
        i = np.nonzero(new)[0]
        first = q[i]
        last = q[np.append(i[1:] - 1, len(q) - 1)] if len(i) else first
        anchor = at[i].astype(np.int64)
        shape = ((last - first) * 64 + (anchor - first)).astype(np.uint64)
        run = _mixed(_mixed(whole[first] + shape * np.uint64(0xD6E8FEB86659FD93)) + whole[last])
        return owner[i], first, last, anchor, value[anchor], run


def _pack(rows: dict[str, np.ndarray]) -> bytes:
    parts = [np.diff(rows[f], prepend=rows[f].dtype.type(0)) if f in ("doc", "start", "tag") else rows[f] for f, _ in FIELDS]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(p, t).tobytes() for p, (_, t) in zip(parts, FIELDS)))


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = len(data) // sum(np.dtype(t).itemsize for _, t in FIELDS), 0, {}
    for f, t in FIELDS:
        x = np.frombuffer(data, t, n, at)
        out[f] = np.cumsum(x) if f in ("doc", "start", "tag") else x
        at += x.nbytes
    return out


def _least(doc: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Per row the smallest doc among the rows with the same keys, and per row the number of the keys' group."""
    order = np.lexsort((doc, *keys[::-1]))
    new = np.zeros(len(doc), bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    group = np.cumsum(new) - 1
    low = np.empty_like(doc)
    low[order] = doc[order][np.nonzero(new)[0]][group]
    number = np.empty(len(doc), np.int64)
    number[order] = group
    return low, number


def _joined(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of a document that touch or overlap, made one."""
    o = np.lexsort((start, tag, doc))
    doc, tag, start, stop = doc[o], tag[o], start[o], stop[o]
    if not len(o):
        return doc, tag, start, stop
    new = np.ones(len(o), bool)
    # Spans of equal widths but for a few bytes come in order of start, so the running stop of a document is its last one.
    new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > stop[:-1])
    i = np.nonzero(new)[0]
    return doc[i], tag[i], start[i], np.maximum.reduceat(stop, i)


def _chunk_runs(depth: int, buckets: int, chunk: int):
    values = _table()

    def flush(pieces: list[tuple[int, int, int, bytes]]) -> Iterator[pd.DataFrame]:
        buf = np.frombuffer(b"".join(p[3] for p in pieces), np.uint8)
        sizes = np.array([len(p[3]) for p in pieces], np.int64)
        owner, first, last, anchor, hashed, run = runs_of(buf, sizes, values, depth)
        if not len(owner):
            return
        begin = (np.cumsum(sizes) - sizes)[owner]
        base = np.array([p[2] for p in pieces], np.int64)[owner]
        rows = {
            "anchor": hashed, "run": run, "doc": np.array([p[0] for p in pieces], np.int64)[owner], "tag": np.array([p[1] for p in pieces], np.int64)[owner],
            "start": first - begin + base, "width": (last - first).astype(np.uint8), "rel": (anchor - first).astype(np.uint8),
        }
        low, _ = _least(rows["doc"], hashed, run)
        settled = rows["doc"] > low
        if settled.any():
            s = {f: rows[f][settled] for f in rows}
            doc, tag, start, stop = _joined(s["doc"], s["tag"], s["start"], s["start"] + s["width"] + depth)
            yield pd.DataFrame({"kind": 0, "bucket": (doc % buckets).astype(np.int32), "doc": doc, "tag": tag, "start": start, "stop": stop, "blob": None})
        rows = {f: rows[f][~settled] for f in rows}
        bucket = ((rows["anchor"] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        made = [(1, b, 0, 0, 0, 0, _pack({f: rows[f][order[edges[b] : edges[b + 1]]] for f in rows})) for b in range(buckets) if edges[b] < edges[b + 1]]
        yield pd.DataFrame(made, columns=[c.split()[0] for c in RUNS.split(", ")])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, size = [], 0
        for batch in batches:
            for doc, tag, data in zip(batch["doc"], batch["tag"], batch["data"]):
                at = 0
                while len(data) - at >= depth:
                    part = data[at : at + chunk + depth - 1]  # the next slice starts with the next window
                    pieces.append((doc, tag, at, part))
                    size, at = size + len(part), at + chunk
                    if size >= chunk:
                        yield from flush(pieces)
                        pieces, size = [], 0
        if pieces:
            yield from flush(pieces)

    return rows


def _bucket_spans(depth: int):
    """Passes 1 and 2 over a bucket: kind 0 spans are settled, kind 1 and 2 spans are contexts to fetch, the latter of hot
    anchors."""
    hot = HOT

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        local = pdf[pdf["kind"] == 0]
        out = [pd.DataFrame({"kind": 0, "doc": local["doc"], "tag": local["tag"], "start": local["start"], "stop": local["stop"], "anchor": 0, "rel": 0})]
        blobs = [_unpack(b) for b in pdf.loc[pdf["kind"] == 1, "blob"]]
        if blobs:
            r = {f: np.concatenate([b[f] for b in blobs]) for f, _ in FIELDS}
            del blobs
            low, group = _least(r["doc"], r["anchor"])
            n = int(group.max()) + 1
            high = np.full(n, np.iinfo(np.int64).min)
            np.maximum.at(high, group, r["doc"])
            shared = high[group] > low  # anchors that one document alone has are done
            r, group = {f: r[f][shared] for f in r}, group[shared]
            if len(group):
                low, part = _least(r["doc"], group, r["run"])
                done = r["doc"] > low
                s = {f: r[f][done] for f in r}
                out.append(pd.DataFrame({"kind": 0, "doc": s["doc"], "tag": s["tag"], "start": s["start"], "stop": s["start"] + s["width"] + depth, "anchor": 0, "rel": 0}))
                parts = np.unique(np.stack([group, part], axis=1), axis=0)[:, 0]  # different runs of each anchor
                several = np.bincount(parts, minlength=n) > 1
                ask = ~done & several[group]
                s, kind = {f: r[f][ask] for f in r}, np.where(np.bincount(group[ask], minlength=n) > hot, 2, 1)[group[ask]]
                # Equal rows of a key give equal runs: one of them asks.
                _, once = np.unique(np.stack([s["doc"], s["tag"], s["start"], s["anchor"].view(np.int64)], axis=1), axis=0, return_index=True)
                s, kind = {f: s[f][once] for f in s}, kind[once]
                out.append(pd.DataFrame({"kind": kind, "doc": s["doc"], "tag": s["tag"], "start": s["start"], "stop": s["start"] + s["width"] + depth, "anchor": s["anchor"].view(np.int64), "rel": s["rel"].astype(np.int32)}))
        return pd.concat(out)

    return settle


SUFFIXES = "kind int, doc long, tag long, start long, stop long, anchor long, off int, suffix binary"


def _sorted_bytes(depth: int, at_once: int = 50_000, least: bool = False):
    """Pass 3 over contexts sorted by anchor: suffixes refined by eight bytes a pass; spans of the repeated ones (kind 0).

    least: the contexts are some of their anchors' only; the least suffixes of these come too (kind 1), with their bytes.
    """

    def refine(ctx: pd.DataFrame) -> pd.DataFrame:
        data = ctx["data"].to_numpy()
        size = np.fromiter(map(len, data), np.int64, len(data))
        buf = np.frombuffer(b"".join(data) + bytes(8), np.uint8)
        n = size - depth + 1
        owner = np.repeat(np.arange(len(n)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pos = (np.cumsum(size) - size)[owner] + step
        doc, group = ctx["doc"].to_numpy(np.int64)[owner], None
        keys = [ctx["anchor"].to_numpy(np.int64)[owner], ctx["rel"].to_numpy(np.int64)[owner] - step]
        for at in [None, *range(0, depth, 8)]:
            if at is not None:
                digit = np.zeros(len(pos), np.uint64)
                for i in range(min(8, depth - at)):
                    digit = (digit << np.uint64(8)) | buf[pos + at + i]
                keys = [group, digit]
            low, group = _least(doc, *keys)
            if least:  # others may be elsewhere
                continue
            high = np.full(int(group.max()) + 1 if len(group) else 0, np.iinfo(np.int64).min)
            np.maximum.at(high, group, doc)
            on = high[group] > low
            pos, doc, owner, step, group, low = pos[on], doc[on], owner[on], step[on], group[on], low[on]
        hit = doc > low
        start = ctx["start"].to_numpy(np.int64)[owner[hit]] + step[hit]
        a, b, c, d = _joined(doc[hit], ctx["tag"].to_numpy(np.int64)[owner[hit]], start, start + depth)
        out = pd.DataFrame({"kind": 0, "doc": a, "tag": b, "start": c, "stop": d, "anchor": 0, "off": 0, "suffix": None})
        if not least:
            return out
        own = np.nonzero(~hit)[0]
        start, whole = ctx["start"].to_numpy(np.int64)[owner[own]] + step[own], buf.tobytes()
        rows = pd.DataFrame({
            "kind": 1, "doc": doc[own], "tag": ctx["tag"].to_numpy(np.int64)[owner[own]], "start": start, "stop": start + depth,
            "anchor": ctx["anchor"].to_numpy(np.int64)[owner[own]], "off": (ctx["rel"].to_numpy(np.int64)[owner[own]] - step[own]).astype(np.int32),
            "suffix": [whole[p : p + depth] for p in pos[own].tolist()],
        })
        return pd.concat([out, rows])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            if least:
                yield refine(batch)
                continue
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if len(held) >= at_once:
                anchor = held["anchor"].to_numpy()
                edge = int(np.searchsorted(anchor, anchor[-1]))  # sorted: the last anchor may go on
                if edge:
                    yield refine(held.iloc[:edge])
                    held = held.iloc[edge:]
        if held is not None and len(held):
            yield refine(held)

    return rows


def settled_runs(keyed: DataFrame, depth: int = DEPTH, chunk: int = CHUNK) -> DataFrame:
    """Passes 1 and 2 over documents keyed (doc, tag, data): see ``_bucket_spans``."""
    size = keyed.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    buckets = max(2 * slots(keyed.sparkSession), -(-size // BUCKET_BYTES))
    runs = keyed.select("doc", "tag", "data").mapInPandas(_chunk_runs(depth, buckets, chunk), RUNS)
    return materialise(runs.groupBy("bucket").applyInPandas(_bucket_spans(depth), SPANS), "spans")


def spans(keyed: DataFrame, depth: int = DEPTH, chunk: int = CHUNK) -> DataFrame:
    """(doc, tag, spans): flat start, stop pairs to remove, for the documents of keyed (doc, tag, data) that have any."""
    settled = settled_runs(keyed, depth, chunk)

    def contexts(kind: int) -> DataFrame:
        asked = settled.where(F.col("kind") == kind).select("doc", "tag", "start", "stop", "anchor", "rel")
        data = F.substring("data", (F.col("start") + 1).cast("int"), (F.col("stop") - F.col("start")).cast("int"))
        return asked.join(keyed.select("doc", "tag", "data"), ["doc", "tag"]).select("anchor", "rel", "doc", "tag", "start", data.alias("data"))

    span = ["doc", "tag", "start", "stop"]
    some = contexts(1).repartition("anchor").sortWithinPartitions("anchor").mapInPandas(_sorted_bytes(depth), SUFFIXES)
    both = settled.where("kind = 0").select(span).union(some.select(span))
    if not settled.where("kind = 2").isEmpty():
        # Hot anchors: what a task can settle is settled there, and each least suffix goes to the task of its own bytes.
        hot = materialise(contexts(2).mapInPandas(_sorted_bytes(depth, least=True), SUFFIXES), "hot")
        low = F.min("doc").over(Window.partitionBy("anchor", "off", "suffix"))
        more = hot.where("kind = 1").withColumn("_low", low).where("doc > _low")
        both = both.union(hot.where("kind = 0").select(span)).union(more.select(span))
    return both.groupBy("doc", "tag").agg(F.flatten(F.collect_list(F.array("start", "stop"))).alias("spans"))


def keyed_texts(docs: DataFrame, *more: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, tag, data, ...): doc is the key, null last; tag, of 64 bits, tells different texts of one key apart; data are UTF-8 bytes."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(t).alias("tag"), t.cast("binary").alias("data"), *more)


def _merged(flat) -> np.ndarray:
    """Disjoint, maximal [start, stop) rows in order."""
    if flat is None or not len(flat):
        return np.zeros((0, 2), np.int64)
    s = np.asarray(flat, np.int64).reshape(-1, 2)
    s = s[np.argsort(s[:, 0], kind="stable")]
    stop = np.maximum.accumulate(s[:, 1])
    i = np.nonzero(np.concatenate([[True], s[1:, 0] > stop[:-1]]))[0]
    return np.stack([s[i, 0], np.maximum.reduceat(s[:, 1], i)], axis=1)


def _kept(data: bytes, gone: np.ndarray) -> bytes:
    edges = [0, *gone.ravel().tolist(), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _digest(data: pd.Series, flat: pd.Series) -> pd.DataFrame:
    rows = []
    for d, f in zip(data, flat):
        gone = _merged(f)
        rows.append((len(d), int((gone[:, 1] - gone[:, 0]).sum()), len(gone), hashlib.sha256(_kept(d, gone)).hexdigest()))
    return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _remaining(data: pd.Series, flat: pd.Series) -> pd.Series:
    """The text without its spans, which shrink to whole characters."""
    out = []
    for d, f in zip(data, flat):
        gone = _merged(f)
        for g in gone:
            while g[0] < g[1] and d[g[0]] & 0xC0 == 0x80:
                g[0] += 1
            while g[0] < g[1] < len(d) and d[g[1]] & 0xC0 == 0x80:
                g[1] -= 1
        out.append(_kept(d, gone).decode("utf-8", "replace"))
    return pd.Series(out, dtype=object)


def removed(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per input row."""
    keyed = keyed_texts(docs)
    both = keyed.join(spans(keyed, depth), ["doc", "tag"], "left")
    out = both.select(F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"), F.pandas_udf(_digest, DIGEST)("data", "spans").alias("d"))
    return out.select("doc_id", "d.*")


def without_repeats(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The input rows, all columns as they came, with repeated passages cut from the text of all but the first document."""
    gone = spans(keyed_texts(docs), depth)
    rows = keyed_texts(docs, F.struct("*").alias("_row"))
    both = rows.join(gone, ["doc", "tag"], "left")
    text = F.when(F.col("spans").isNull(), F.col("_row.text")).otherwise(F.pandas_udf(_remaining, "string")("data", "spans"))
    return both.select(*[(text if c == "text" else F.col("_row")[c]).alias(c) for c in docs.columns])


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents"))
