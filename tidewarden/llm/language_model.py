"""Interpolated modified Kneser-Ney n-gram model, counted in Spark and memory-mapped by the workers that score.

Counting: workers turn chunks of whole training texts into sorted unique n-grams with counts, packed by columns into one
row for each chunk and bucket, and a bucket's task merges them: what is shuffled grows with the distinct n-grams a chunk,
not with tokens, and a very frequent word or n-gram is one entry a chunk. First the vocabulary is counted, in ranges of
the 64-bit word hash, and a word's id follows from its range and its rank by frequency there, so that frequent words have
small ids and n-grams pack well; then the highest order; every lower order counts the distinct left
extensions that the order above it found. Count-of-counts for the discounts are sums over buckets. Nothing is pruned or
capped, so the model grows with the corpus. All orders are one chain of shuffles: a bucket's task writes its shard and
hands the next lower order on, and nothing is written twice. The number of buckets follows from the bytes of the texts, so
that a bucket's task holds the n-grams of about BUCKET_BYTES of text, at any size of the corpus.

Storage: a bucket's task writes one shard into the shared folder: sorted n-gram hashes with counts of one byte, and sorted
context hashes with totals and the numbers of words seen once, twice and more often, of a byte each; rows with larger
numbers stand in a second, sorted array. A hash's first bits are the cell that it stands in and 40 more bits are stored,
so that a lookup is a short bisection inside a cell, and mistakes an unseen n-gram for a seen one once in 10^10. A shard has a fixed name and is renamed into place, so that
repeated tasks are harmless. Workers map shards on first use; of a store without local paths a shard is read into memory,
where the last used ones stay, up to HELD_BYTES.

Scoring: log10 p of every token given its history, the sums a document. Unknown words share the uniform mass at the
bottom, 1 / (V + 1) each, like an unknown class.

Defined results: null and empty texts have the end token alone; a null key counts as empty text for the folds; without
training texts every token has 1 / (V + 1) = 1; repeated rows are counted and scored each; an empty table gives an empty
result; other columns are not read; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_bucket, local_path, new_path, slots, table

ORDER = 3
FOLDS = 10
#: Bytes of text for each bucket, and bytes of shards that a worker keeps of a store that it can't map.
BUCKET_BYTES, HELD_BYTES = 1 << 24, 1 << 29
#: Tokens that a worker counts or scores at once.
CHUNK = 1 << 20
END = b"\n"  # no word holds a blank
BLOBS = "kind int, bucket int, blob binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def context_hash(columns: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = _mixed(h ^ c.astype(np.uint64))
    return h


def pair_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mixed(context ^ word.astype(np.uint64))


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length, the first ascending; bytes of equal weight stand together."""
    parts = [np.uint64(len(columns[0])).tobytes()]
    for i, c in enumerate(columns):
        d = np.diff(c, prepend=c.dtype.type(0)) if i == 0 else np.ascontiguousarray(c)
        parts += [c.dtype.str.encode().ljust(4), d.view(np.uint8).reshape(len(c), -1).T.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int(np.frombuffer(data, np.uint64, 1)[0]), 8, []
    while at < len(data):
        kind = np.dtype(data[at : at + 4].decode().strip())
        size = n * kind.itemsize
        planes = np.frombuffer(data, np.uint8, size, at + 4).reshape(kind.itemsize, n)
        c = np.ascontiguousarray(planes.T).view(kind).ravel()
        out.append(np.cumsum(c, dtype=kind) if not out else c)
        at += 4 + size
    return out


def packed_rows(columns: list[np.ndarray], counts: np.ndarray, bits: int) -> bytes:
    """Rows in order of their columns; narrow ones as one number, whose steps are small."""
    if len(columns) > 1 and bits * len(columns) <= 64:
        columns = [one_number(columns, bits)]
    return pack(*columns, counts.astype(np.min_scalar_type(int(counts.max(initial=0)))))


def unpacked_rows(blob: bytes, m: int, bits: int) -> list[np.ndarray]:
    """The m columns and the counts of ``packed_rows``."""
    *columns, counts = unpack(blob)
    return [*(several(columns[0], m, bits) if len(columns) < m else columns), counts]


def one_number(columns: list[np.ndarray], bits: int) -> np.ndarray:
    key = columns[0].astype(np.uint64)
    for c in columns[1:]:
        key = key << np.uint64(bits) | c.astype(np.uint64)
    return key


def several(key: np.ndarray, m: int, bits: int) -> list[np.ndarray]:
    low = np.uint64((1 << bits) - 1)
    return [key >> np.uint64(bits * i) & low for i in range(m - 1, -1, -1)]


def summed(columns: list[np.ndarray], counts: np.ndarray, bits: int = 64) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows in order of their columns, with summed counts. bits: what a value needs at most; narrow rows are sorted
    as one number."""
    if len(columns) > 1 and bits * len(columns) <= 64:
        (key,), counts = summed([one_number(columns, bits)], counts)
        return several(key, len(columns), bits), counts
    if len(columns) == 1:
        order = np.argsort(columns[0], kind="quicksort")
        columns, counts = [columns[0][order]], counts[order]
        i = np.nonzero(np.concatenate([[True], columns[0][1:] != columns[0][:-1]]))[0] if len(order) else order
        return [columns[0][i]], np.add.reduceat(counts, i) if len(i) else counts
    # Two columns of up to 32 bits are one key.
    keys = [one_number(columns[i : i + 2], 32) for i in range(0, len(columns), 2)] if bits <= 32 else columns
    order = np.lexsort(keys[::-1])
    columns, counts = [c[order] for c in columns], counts[order]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    i = np.nonzero(new)[0]
    return [c[i] for c in columns], np.add.reduceat(counts, i) if len(i) else counts


def write_shard(uri: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    out, root = fs.FileSystem.from_uri(uri)
    temporary = f"{root}/{name}.{TaskContext.get().taskAttemptId()}.tmp"
    head = ";".join(f"{k},{a.dtype.str},{len(a)}" for k, a in arrays.items()).encode().ljust(1016)
    with out.open_output_stream(temporary) as f:
        f.write(len(head).to_bytes(8, "little") + head)
        for a in arrays.values():
            f.write(np.ascontiguousarray(a).tobytes())
            f.write(bytes(-a.nbytes % 8))
    out.move(temporary, f"{root}/{name}")


_maps: dict[str, dict[str, np.ndarray]] = {}
_held: dict[str, int] = {}


def read_shard(uri: str, name: str) -> dict[str, np.ndarray]:
    """The shard's arrays, memory-mapped and kept for the worker's life; in memory if the store can't be mapped."""
    key = f"{uri}/{name}"
    if key in _held:
        _held[key] = _held.pop(key)  # the last used stand last
    if key not in _maps:
        if path := local_path(uri):
            whole = np.memmap(f"{path}/{name}", np.uint8, "r")
            if len(_maps) > 4096:
                _maps.clear()
        else:
            store, root = fs.FileSystem.from_uri(uri)
            with store.open_input_stream(f"{root}/{name}") as f:
                whole = np.frombuffer(f.read(), np.uint8)
            _held[key] = len(whole)
            while sum(_held.values()) > HELD_BYTES and len(_held) > 1:
                gone = next(iter(_held))
                del _held[gone], _maps[gone]
        n = int(whole[:8].view(np.uint64)[0])
        arrays, at = {}, 8 + n
        for part in bytes(whole[8 : 8 + n]).decode().strip().split(";"):
            k, kind, size = part.split(",")
            end = at + int(size) * np.dtype(kind).itemsize
            arrays[k] = whole[at:end].view(kind)
            at = end + (-(end - at) % 8)
        _maps[key] = arrays
    return _maps[key]


def narrow(a: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest unsigned type."""
    return a.astype(np.min_scalar_type(int(a.max(initial=0))))


STORED = 40


def celled(name: str, h: np.ndarray) -> dict[str, np.ndarray]:
    """Sorted hashes as cells of about 16: where each begins, and STORED bits of each hash after those of its cell."""
    k = min(24, max(0, len(h).bit_length() - 5))
    t = h >> np.uint64(64 - k - STORED)
    at = np.searchsorted(t >> np.uint64(STORED), np.arange((1 << k) + 1, dtype=np.uint64))
    return {f"{name}_at": at.astype(np.uint32 if len(h) < 1 << 32 else np.uint64), f"{name}_high": (t >> np.uint64(8)).astype(np.uint32), f"{name}_low": t.astype(np.uint8)}


def in_cells(shard: dict[str, np.ndarray], name: str, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hit) of each wanted hash."""
    at, high, low = shard[f"{name}_at"], shard[f"{name}_high"], shard[f"{name}_low"]
    if not len(high):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    k = (len(at) - 1).bit_length() - 1
    t = wanted >> np.uint64(64 - k - STORED)
    cell = (t >> np.uint64(STORED)).astype(np.int64)
    rest = t & np.uint64((1 << STORED) - 1)
    a, end = at[cell].astype(np.int64), at[cell + 1].astype(np.int64)
    b, last = end.copy(), len(high) - 1

    def stored(i: np.ndarray) -> np.ndarray:
        i = np.minimum(i, last)
        return high[i].astype(np.uint64) << np.uint64(8) | low[i]

    while (a < b).any():
        mid = (a + b) >> 1
        less = (stored(mid) < rest) & (a < b)
        b = np.where(less, b, np.minimum(mid, b))
        a = np.where(less, mid + 1, a)
    return np.minimum(a, last), (a < end) & (stored(a) == rest)


def in_bytes(name: str, *columns: np.ndarray, stored: int = 1, whole: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """The first ``stored`` columns as a byte each; of rows with larger numbers, and of those marked ``whole``, the places and
    all numbers, and 255 in the first column."""
    large = np.max(columns, axis=0) >= 255
    large = large if whole is None else large | whole
    small = [np.minimum(c, 255).astype(np.uint8) for c in (np.where(large, 255, columns[0]), *columns[1:stored])]
    big = np.nonzero(large)[0]
    out = {f"{name}{i}": c for i, c in enumerate(small)} | {f"{name}_big": narrow(big)}
    return out | {f"{name}_big{i}": narrow(c[big]) for i, c in enumerate(columns)}


def of_bytes(shard: dict[str, np.ndarray], name: str, n: int, at: np.ndarray) -> list[np.ndarray]:
    """The n numbers of the rows at these places; zero where a column isn't stored for the row."""
    out = [shard[f"{name}{i}"][at].astype(np.int64) if f"{name}{i}" in shard else np.zeros(len(at), np.int64) for i in range(n)]
    big = np.nonzero(out[0] == 255)[0]
    if len(big):
        j = np.searchsorted(shard[f"{name}_big"], at[big])
        for i in range(n):
            out[i][big] = shard[f"{name}_big{i}"][j]
    return out


def found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hit) of each wanted value in sorted keys."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return i, keys[i] == wanted


def by_bucket(bucket: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n + 1))
    for b in range(n):
        if edges[b] < edges[b + 1]:
            yield b, order[edges[b] : edges[b + 1]]


def hash_range(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def token_hashes(text: bytes) -> list[int]:
    h = xxhash.xxh64_intdigest
    return [h(w) for w in text.lower().split()] + [h(END)]


def chunks(batches: Iterator[pd.DataFrame], size: int = CHUNK) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(rows before their text, token hashes, tokens a document) of about ``size`` tokens."""
    rows, parts, lengths, n = [], [], [], 0
    for batch in batches:
        for *m, data in batch.itertuples(index=False, name=None):
            h = np.array(token_hashes(data), np.uint64)
            rows.append(m)
            parts.append(h)
            lengths.append(len(h))
            n += len(h)
            if n >= size:
                yield rows, np.concatenate(parts), np.array(lengths)
                rows, parts, lengths, n = [], [], [], 0
    if rows:
        yield rows, np.concatenate(parts), np.array(lengths)


@dataclass
class Model:
    """What workers need: places of the shards, totals and discounts. A few numbers a bucket.

    Of rank r in bucket b, the id is r * buckets + b.
    """

    uri: str
    order: int
    buckets: int
    sizes: np.ndarray
    vocabulary: int
    tokens: int
    discounts: dict[int, np.ndarray] = field(default_factory=dict)
    #: of the lowest order: sum of continuation counts, and how many words have one, two and more
    lowest: np.ndarray = field(default_factory=lambda: np.zeros(4))

    @property
    def bits(self) -> int:
        """What an id needs."""
        return self.unknown.bit_length()

    @property
    def start(self) -> int:
        return int(self.sizes.max(initial=0)) * self.buckets

    @property
    def unknown(self) -> int:
        return self.start + 1

    def ids(self, hashes: np.ndarray, *fields: str) -> tuple[np.ndarray, ...]:
        """Ids of words, and further fields of the vocabulary (0 for unknown words)."""
        words, back = np.unique(hashes, return_inverse=True)
        out = [np.full(len(words), self.unknown, np.int64)] + [np.zeros(len(words), np.int64) for _ in fields]
        for b, rows in by_bucket(hash_range(words, self.buckets), self.buckets):
            if not self.sizes[b]:
                continue
            shard = read_shard(self.uri, f"words-{b:06d}")
            i, hit = found(shard["hash"], words[rows])
            rank = shard["rank"][i[hit]].astype(np.int64)
            out[0][rows[hit]] = rank * self.buckets + b
            for o, f in zip(out[1:], fields):
                o[rows[hit]] = shard[f][i[hit]] if f in shard else read_shard(self.uri, f"before-{b:06d}")[f][rank]
        return tuple(o[back] for o in out)


def histories(ids: np.ndarray, lengths: np.ndarray, order: int, start: int) -> list[np.ndarray]:
    """order columns; the last is the token, those before it its history, padded with starts within the document."""
    place = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = [ids]
    for k in range(1, order):
        shifted = np.full(len(ids), start, ids.dtype)
        shifted[k:] = ids[:-k]
        out.insert(0, np.where(place >= k, shifted, start))
    return out


def _count_words(buckets: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, h, _ in chunks(batches, 4 * CHUNK):
            words, n = np.unique(h, return_counts=True)
            made = [(0, b, pack(words[r], n[r].astype(np.uint32))) for b, r in by_bucket(hash_range(words, buckets), buckets)]
            yield pd.DataFrame(made, columns=["kind", "bucket", "blob"])

    return rows


def _write_words(uri: str):
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        b = int(pdf["bucket"].iloc[0])
        parts = [unpack(x) for x in pdf["blob"]]
        (words,), n = summed([np.concatenate([p[0] for p in parts])], np.concatenate([p[1] for p in parts]).astype(np.int64))
        rank = np.empty(len(n), np.int64)
        rank[np.argsort(-n, kind="stable")] = np.arange(len(n))
        write_shard(uri, f"words-{b:06d}", {"hash": words, "count": narrow(n), "rank": narrow(rank)})
        return pd.DataFrame({"bucket": [b], "words": [len(words)], "tokens": [int(n.sum())]})

    return merge


def _blobs(columns: list[np.ndarray], counts: np.ndarray, model: Model) -> list[tuple[int, int, bytes]]:
    """Distinct n-grams of one order, packed by bucket: by context, or by the word itself for the lowest order."""
    if len(columns) == 1:
        bucket = columns[0].astype(np.int64) % model.buckets
    else:
        bucket = (context_hash(columns[:-1]) % np.uint64(model.buckets)).astype(np.int64)
    return [(len(columns), b, packed_rows([c[r].astype(np.uint32) for c in columns], counts[r], model.bits)) for b, r in by_bucket(bucket, model.buckets)]


def _count_ngrams(model: Model):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, h, lengths in chunks(batches):
            (ids,) = model.ids(h)
            columns, n = summed(histories(ids, lengths, model.order, model.start), np.ones(len(ids), np.int64), model.bits)
            yield pd.DataFrame(_blobs(columns, n, model), columns=["kind", "bucket", "blob"])

    return rows


def _numbers(*numbers) -> bytes:
    return np.array(numbers, np.int64).tobytes()


def _write_ngrams(model: Model):
    """Writes a bucket's shard; the next lower order goes on, and the numbers of each order (kind: less its order) with it."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        b = int(pdf["bucket"].iloc[0])
        told = list(pdf[pdf["kind"] < 0].itertuples(index=False, name=None))
        blobs = pdf[pdf["kind"] > 0]
        if not len(blobs):
            return pd.DataFrame(told, columns=["kind", "bucket", "blob"])
        m = int(blobs["kind"].iloc[0])
        parts = [unpacked_rows(x, m, model.bits) for x in blobs["blob"]]
        columns, n = [np.concatenate([p[i] for p in parts]) for i in range(m)], np.concatenate([p[m].astype(np.int64) for p in parts])
        del parts, pdf, blobs
        columns, n = summed(columns, n, model.bits)
        contexts = context_hash(columns[:-1])
        hashes = pair_hash(contexts, columns[-1])
        o = np.argsort(hashes)
        arrays = celled("hash", hashes[o]) | in_bytes("count", n[o])
        o = np.argsort(contexts, kind="stable")
        contexts, at = contexts[o], n[o]
        i = np.nonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]]))[0]
        seen = [np.add.reduceat(((at == k) if k < 3 else (at >= 3)).astype(np.int64), i) for k in (1, 2, 3)]
        # Without words seen more than twice, the total follows from the others.
        arrays |= celled("context", contexts[i]) | in_bytes("sums", seen[0], seen[1], seen[2], np.add.reduceat(at, i), stored=2, whole=seen[2] > 0)
        write_shard(model.uri, f"order-{m}-{b:06d}", arrays)
        told.append((-m, b, _numbers(*[(n == k).sum() for k in (1, 2, 3, 4)])))
        del arrays, contexts, hashes, at, o, seen
        shorter, left = summed(columns[1:], np.ones(len(n), np.int64), model.bits)
        return pd.DataFrame([*told, *_blobs(shorter, left, model)], columns=["kind", "bucket", "blob"])

    return merge


def _write_before(model: Model):
    """Of the lowest order: writes the numbers of left extensions of a bucket's words, and tells sum, words and counts."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        b = int(pdf["bucket"].iloc[0])
        told = list(pdf[pdf["kind"] < 0].itertuples(index=False, name=None))
        parts = [unpacked_rows(x, 1, model.bits) for x in pdf.loc[pdf["kind"] > 0, "blob"]]
        if parts:
            (ids,), n = summed([np.concatenate([p[0] for p in parts])], np.concatenate([p[1] for p in parts]).astype(np.int64))
            dense = np.zeros(int(model.sizes[b]), np.int64)
            dense[ids.astype(np.int64) // model.buckets] = n
            write_shard(model.uri, f"before-{b:06d}", {"before": narrow(dense)})
            told.append((-1, b, _numbers(*[(n == k).sum() for k in (1, 2, 3, 4)], n.sum(), len(n))))
        return pd.DataFrame(told, columns=["kind", "bucket", "blob"])

    return merge


def discounts(of: np.ndarray) -> np.ndarray:
    """D(0), D(1), D(2), D(3+) from the numbers of n-grams with counts 1 to 4; a half, one, one and a half if undefined."""
    n1, n2, n3, n4 = (float(x) for x in of)
    out = np.array([0.0, 0.5, 1.0, 1.5])
    if n1 and n2:
        y = n1 / (n1 + 2 * n2)
        out[1] = 1 - 2 * y * n2 / n1
        out[2] = 2 - 3 * y * n3 / n2 if n3 else out[2]
        out[3] = 3 - 4 * y * n4 / n3 if n3 and n4 else out[3]
    return np.clip(out, 0, [0, 1, 2, 3])


def train(texts: DataFrame, order: int = ORDER, bucket_bytes: int = BUCKET_BYTES) -> Model:
    """texts (data): UTF-8 bytes of whole texts."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    uri, buckets = new_path(spark, "kneser-ney"), max(slots(spark), -(-size // bucket_bytes))
    store, root = fs.FileSystem.from_uri(uri)
    store.create_dir(root, recursive=True)

    def merged(blobs: DataFrame, merge, schema: str) -> DataFrame:
        """One task for each bucket, over its rows."""

        def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = [b for b in batches if len(b)]
            if held:
                yield merge(pd.concat(held, ignore_index=True))

        return blobs.repartitionById(buckets, F.col("bucket")).mapInPandas(rows, schema)

    counted = merged(texts.mapInPandas(_count_words(buckets), BLOBS), _write_words(uri), "bucket int, words long, tokens long").collect()
    sizes = np.zeros(buckets, np.int64)
    for r in counted:  # one row a bucket
        sizes[r.bucket] = r.words
    model = Model(uri, order, buckets, sizes, int(sizes.sum()), sum(r.tokens for r in counted))
    blobs = texts.mapInPandas(_count_ngrams(model), BLOBS)
    for _ in range(order, 1, -1):
        blobs = merged(blobs, _write_ngrams(model), BLOBS)
    told: dict[int, np.ndarray] = {}
    for r in merged(blobs, _write_before(model), BLOBS).collect():  # a few numbers for each order and bucket
        told[-r.kind] = told.get(-r.kind, 0) + np.frombuffer(bytes(r.blob), np.int64)
    for m in range(1, order + 1):
        model.discounts[m] = discounts(told[m][:4] if m in told else np.zeros(4))
    if 1 in told:
        n1, n2, _, _, total, words = told[1]
        model.lowest = np.array([total, n1, n2, words - n1 - n2], float)
    return model


def token_log10(model: Model, hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log10 p, training count) of each token."""
    if not model.tokens:
        return np.zeros(len(hashes)), np.zeros(len(hashes), np.int64)
    ids, count, before = model.ids(hashes, "count", "before")
    total, *seen = model.lowest
    d = model.discounts[1]
    p = np.maximum(before - d[np.minimum(before, 3)], 0) / total + (d[1:] @ np.array(seen)) / total / (model.vocabulary + 1)
    columns = histories(ids, lengths, model.order, model.start)
    for m in range(2, model.order + 1):
        context = context_hash(columns[-m:-1])
        key = pair_hash(context, columns[-1])
        d = model.discounts[m]
        for b, r in by_bucket((context % np.uint64(model.buckets)).astype(np.int64), model.buckets):
            try:
                shard = read_shard(model.uri, f"order-{m}-{b:06d}")
            except FileNotFoundError:  # no n-gram fell into this bucket
                continue
            ctx, back = np.unique(context[r], return_inverse=True)
            i, hit = in_cells(shard, "context", ctx)
            i, hit = i[back], hit[back]
            r, i = r[hit], i[hit]
            if not len(r):
                continue
            *seen, t = of_bytes(shard, "sums", 4, i)
            t = np.where(seen[2] > 0, t, seen[0] + 2 * seen[1])
            back_off = (d[1] * seen[0] + d[2] * seen[1] + d[3] * seen[2]) / t
            o = np.argsort(key[r])  # sorted probes walk the mapped pages once
            j, known = in_cells(shard, "hash", key[r[o]])
            c = np.empty(len(r), np.int64)
            c[o] = np.where(known, of_bytes(shard, "count", 1, j)[0], 0)
            p[r] = np.maximum(c - d[np.minimum(c, 3)], 0) / t + back_off * p[r]
    return np.log10(p), count


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs (doc_id, held_out, data) -> per document n_tokens, n_known, train_tokens, base_score, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few numbers a bucket

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m: Model = shared.value
        for meta, h, lengths in chunks(batches):
            logs, count = token_log10(m, h, lengths)
            base = np.log10((count + 0.1) / (m.tokens + 0.1 * (m.vocabulary + 1)))
            at = np.cumsum(lengths) - lengths
            known = np.add.reduceat((count > 0).astype(np.int64), at)
            out = pd.DataFrame(meta, columns=["doc_id", "held_out"]).astype({"doc_id": "Int64"})
            yield out.assign(n_tokens=lengths, n_known=known, train_tokens=m.tokens, base_score=np.add.reduceat(base, at), score=np.add.reduceat(logs, at))

    return docs.select("doc_id", "held_out", "data").mapInPandas(rows, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def split(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_bucket(F.col("doc_id"), folds) == 0).alias("held_out"), data.alias("data"))


def perplexity(scored: DataFrame) -> DataFrame:
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = split(table(spark, sf_dir, "documents"))
    return perplexity(score(docs, train(docs.where("NOT held_out").select("data"))))
