"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are majorities over the 64-bit hashes of a text's word shingles. For a threshold of t bits over m partitions
of the bits, thresholds t_i >= -1 that sum to t - m + 1 suffice: two fingerprints within t bits are within t_i bits in
some partition. Bits are grouped by their correlation over all fingerprints, into partitions of about equal information;
for each grouping the number of candidates of every partition and threshold is estimated from a dependence tree over its
bits (the tree's pairwise counts come from all fingerprints, 64 x 64 sums a word), and dynamic programming allocates the
thresholds of least cost; -1 leaves a partition out.

Two forms. For few differing bits the thresholds sum up as above and all pairs are found. For a similarity of shingle sets
(0.8: 15 % of the bits differ) sums of thresholds that make every pair certain select next to nothing; there the thresholds
have to meet a chance of missing a pair instead, over a fingerprint of more words. The same groups, estimates and dynamic
programme allocate them, and the links are verified on the shingle sets.

Probing: every distinct fingerprint is filed under its partition's value with each choice of t_i bits struck out, so that
those within t_i bits meet in some file. A file is searched breadth-first over the fingerprints not yet reached, in numpy:
it yields a spanning forest of the true links, never all pairs (files of at most SMALL rows are compared at once and give
their few links as they are). Files above FILE_ROWS are cut into blocks, and each pair of blocks is a task of its own. Exact copies share a fingerprint and are one node from the start.

Classes of a fingerprint, links and components stay in tables; the driver sees 64 x 64 sums, the plan and counts.

Defined results: null, empty and blank texts have fingerprint zero and link like any other; repeated rows are in one
component; a component of null keys alone has a null component_id; an empty table gives an empty result; other columns,
whatever their names, come along untouched where the operator keeps rows. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import ceil, comb

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table
from .components import components

SEED = 42
BITS = 64
FILE_ROWS = 32_768
#: Costs of a filed row and of a comparison, in microseconds, as measured on one core; and how much more a comparison
#: costs in one file of all fingerprints, which few tasks share.
ROW_COST, PAIR_COST, ALONE = 5.0, 0.005, 8.0
LANES = np.uint64(0x0101010101010101)
#: Sets of up to so many shingles are too small for the binomial model of the bits. They are found by prefixes: of two sets
#: as similar as asked, the least shingles share one. Their bounds are four standard deviations above the largest mean that
#: small sets have at a similarity of 0.8 (4 of 5 shingles: 0.1875 of the bits).
SHORT, SHORT_BOUNDS = 64, (25, 73)
#: Shingles of a component that are compared at once.
VERIFIED_AT_ONCE = 1 << 21


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not w:
        return np.zeros(0, np.uint64)
    joined = b" ".join(w)
    end = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    start = np.concatenate([[0], end[:-1] + 1])
    n = max(1, len(w) - k + 1)
    h = xxhash.xxh64_intdigest
    ends = end[min(k, len(w)) - 1 :].tolist()
    return np.fromiter((h(joined[a:b], SEED) for a, b in zip(start[:n].tolist(), ends)), np.uint64, n)


def _spread(h: np.ndarray, j: int) -> np.ndarray:
    """An independent 64-bit value of each hash for the j-th further word."""
    if not j:
        return h
    x = h + np.uint64((0x9E3779B97F4A7C15 * j) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def majorities(hashes: list[np.ndarray], n_words: int = 1) -> np.ndarray:
    """(texts, n_words) of unsigned words: a bit is set in over half of a text's hashes. Texts without hashes are zero.

    Eight bits of a hash at a time are spread over the bytes of a word; up to 255 of them add up without a carry.
    """
    out = np.zeros((len(hashes), n_words), np.uint64)
    size = np.fromiter(map(len, hashes), np.int64, len(hashes))
    full = np.nonzero(size)[0]
    if not len(full):
        return out
    size, h = size[full], np.concatenate([hashes[i] for i in full])
    parts = -(-size // 255)
    first = np.cumsum(parts) - parts
    edges = np.repeat(np.cumsum(size) - size, parts) + 255 * (np.arange(parts.sum()) - np.repeat(first, parts))
    for j in range(n_words):
        x = _spread(h, j)
        ones = np.empty((len(full), 8, 8), np.int64)
        for b in range(8):
            lanes = np.add.reduceat((x >> np.uint64(b)) & LANES, edges)
            ones[:, :, b] = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        bits = 2 * ones.reshape(len(full), BITS) > size[:, None]
        out[full, j] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


#: Shingles that are counted at once.
AT_ONCE = 1 << 17


def _prefix(held: np.ndarray, similarity: float) -> np.ndarray:
    """The least shingles of a set: sets as similar as that share one of them."""
    return held[: len(held) - ceil(similarity * len(held) - 1e-9) + 1].view(np.int64)


def fingerprints(docs: DataFrame, k: int, n_words: int = 1, more: str = "", similarity: float | None = None) -> DataFrame:
    """(doc_id, fp array<long>, n) of docs (doc_id, text): n shingles. more: a further column to carry, with its type.

    similarity: count each shingle once, and add ``node``, a hash of the set of shingles, and ``prefix``, shingles by which
    sets of up to SHORT / similarity are found.
    """
    other = more.split()[0] if more else None

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made, held, n, nodes, prefix = [], [], 0, [], []
            for i, t in enumerate(batch["text"]):
                held.append(np.unique(shingle_hashes(t, k)) if similarity else shingle_hashes(t, k))
                if similarity:
                    nodes.append(xxhash.xxh64_intdigest(held[-1].tobytes(), SEED))
                    prefix.append(_prefix(held[-1], similarity) if 0 < len(held[-1]) <= SHORT / similarity else np.zeros(0, np.int64))
                n += len(held[-1])
                if n >= AT_ONCE or i + 1 == len(batch):
                    made.append((majorities(held, n_words), [len(h) for h in held]))
                    held, n = [], 0
            if not made:
                continue
            words = np.concatenate([x for x, _ in made])
            out = pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "fp": list(words.view(np.int64)), "n": [c for _, y in made for c in y]})
            if similarity:
                out["prefix"], out["node"] = prefix, np.array(nodes, np.uint64).view(np.int64)
            if other:
                out[other] = batch[other].to_numpy()
            yield out

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *([other] if other else []))
    schema = "doc_id long, fp array<long>, n long" + (", prefix array<long>, node long" if similarity else "") + (f", {more}" if more else "")
    return src.mapInPandas(rows, schema)


@dataclass
class Part:
    """A partition of the bits of one word of the fingerprint, and its threshold."""

    bits: list[int]
    threshold: int
    word: int = 0

    def masks(self) -> list[int]:
        """The partition's bits with each choice of ``threshold`` of them struck out."""
        if self.threshold >= len(self.bits):
            return [0]
        whole = sum(1 << b for b in self.bits)
        return [whole & ~sum(1 << b for b in out) for out in combinations(self.bits, self.threshold)]


def information(ones: np.ndarray, joint: np.ndarray, n: float) -> tuple[np.ndarray, np.ndarray]:
    """(entropy of each bit, mutual information of each two), in bits; the latter's diagonal is zero."""
    p = np.clip(ones / max(n, 1), 1e-9, 1 - 1e-9)
    both = np.clip(joint / max(n, 1), 1e-12, 1)
    mutual = np.zeros_like(both)
    for x, px in ((1, p), (0, 1 - p)):
        for y, py in ((1, p), (0, 1 - p)):
            t = both if x and y else (p[:, None] - both if x else p[None, :] - both) if x or y else 1 - p[:, None] - p[None, :] + both
            t = np.clip(t, 1e-12, 1)
            mutual += t * np.log2(t / np.outer(px, py))
    np.fill_diagonal(mutual, 0)
    return -(p * np.log2(p) + (1 - p) * np.log2(1 - p)), np.maximum(mutual, 0)


def grouped_bits(entropy: np.ndarray, mutual: np.ndarray, m: int) -> list[list[int]]:
    """m groups of about equal information: each takes on the bits that tell most about it, and closes when it holds its
    share. Bits that tell about each other add little, so that a group of correlated bits has more of them."""
    left, groups = set(range(len(entropy))), []
    for i in range(m):
        group = [max(left, key=lambda b: (mutual[b, list(left)].sum(), -b))]
        left.discard(group[0])
        if i == m - 1:
            group += left
            groups.append(sorted(group))
            break
        # What is left to share: each bit's entropy less what it has in common with the bit nearest to it.
        rest = sorted(left)
        share = (entropy[group[0]] + sum(entropy[b] - max((mutual[b, x] for x in rest if x < b), default=0.0) for b in rest)) / (m - i)
        held = entropy[group[0]]
        while len(left) > m - i - 1:
            b = max(left, key=lambda x: (mutual[x, group].sum(), -x))
            gain = max(entropy[b] - mutual[b, group].max(), 0.0)
            if held + gain / 2 > share:
                break
            held += gain
            group.append(b)
            left.discard(b)
        groups.append(sorted(group))
    return groups


def distances(bits: list[int], ones: np.ndarray, joint: np.ndarray, n: float, most: int) -> np.ndarray:
    """P(distance = 0..most) of two fingerprints over these bits, under the tree of largest mutual information."""
    p = np.clip(ones / n, 1e-9, 1 - 1e-9)

    def pair(a: int, b: int) -> np.ndarray:
        both = joint[a, b] / n
        t = np.array([[1 - p[a] - p[b] + both, p[b] - both], [p[a] - both, both]])
        t = np.maximum(t, 1e-12)
        return t / t.sum()

    def information(a: int, b: int) -> float:
        t = pair(a, b)
        return float((t * np.log(t / np.outer(t.sum(1), t.sum(0)))).sum())

    children: dict[int, list[int]] = {b: [] for b in bits}
    best = {b: (information(bits[0], b), bits[0]) for b in bits[1:]}
    order = [bits[0]]
    while best:
        b = max(best, key=lambda x: best[x][0])
        children[best.pop(b)[1]].append(b)
        order.append(b)
        for c in best:
            if (i := information(b, c)) > best[c][0]:
                best[c] = (i, b)
    poly: dict[int, np.ndarray] = {}
    for b in reversed(order):
        f = np.zeros((2, 2, most + 1))
        f[:, :, 0] = np.eye(2)
        if most:
            f[:, :, 1] = 1 - np.eye(2)
        for c in children[b]:
            t = pair(b, c)
            given = t / t.sum(1, keepdims=True)
            g = np.einsum("xu,yv,uvd->xyd", given, given, poly[c])
            f = np.array([[np.convolve(f[x, y], g[x, y])[: most + 1] for y in (0, 1)] for x in (0, 1)])
        poly[b] = f
    root = np.array([1 - p[bits[0]], p[bits[0]]])
    return np.einsum("x,y,xyd->d", root, root, poly[bits[0]])


def _met(g: list[int], ones: np.ndarray, joint: np.ndarray, n: float, most: int) -> list[float]:
    """For thresholds 0..most: how often two fingerprints meet in the files of the partition, counted by their files."""
    d = distances(g, ones, joint, max(n, 1), min(most, len(g)))
    return [sum(d[i] * comb(len(g) - i, t - i) for i in range(min(t, len(d) - 1) + 1)) for t in range(most + 1)]


def allocate(ones: np.ndarray, joint: np.ndarray, n: int, limit: int) -> list[Part]:
    """The partitions and thresholds of least estimated cost that find all pairs within ``limit`` bits."""
    pairs = n * n / 2
    entropy, mutual = information(ones, joint, n)
    best, plan = pairs * PAIR_COST * ALONE + n * (1 + n / FILE_ROWS) * ROW_COST, [Part(list(range(BITS)), BITS)]
    for m in range(1, limit + 2):
        groups, total = grouped_bits(entropy, mutual, m), limit - m + 1
        costs = []
        for g in groups:
            most = min(total + m - 1, len(g) - 1)
            costs.append([0.0, *(comb(len(g), t) * n * ROW_COST + pairs * x * PAIR_COST for t, x in enumerate(_met(g, ones, joint, n, most)))])  # [t + 1]
        reach = {0: (0.0, [])}  # sum of (t_i + 1) -> least cost
        for row in costs:
            step: dict[int, tuple[float, list[int]]] = {}
            for s, (c, ts) in reach.items():
                for t1, x in enumerate(row):
                    if s + t1 <= total + m and (s + t1 not in step or c + x < step[s + t1][0]):
                        step[s + t1] = (c + x, ts + [t1 - 1])
            reach = step
        if total + m in reach and reach[total + m][0] < best:
            best, ts = reach[total + m]
            plan = [Part(g, t) for g, t in zip(groups, ts) if t >= 0]
    return plan


def differing(similarity: float) -> float:
    """The part of its bits in which two fingerprints differ at this Jaccard similarity."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


#: Steps in which the dynamic programme counts the chance of a miss.
STEPS = 400


def allocate_likely(counts: np.ndarray, n: int, similarity: float, missed: float, corpus: int) -> list[Part]:
    """The partitions and thresholds of least estimated cost that miss at most ``missed`` of the pairs at the similarity.

    counts: (words, 64, 64) joint ones of n fingerprints. A partition of s bits and threshold t finds a pair with the chance
    that at most t of its s bits differ; the chances of missing it multiply. Costs are those of a corpus of ``corpus``
    fingerprints, a stated number: the plan does not follow the size of the input.
    """
    p, goal = differing(similarity), -np.log(missed)
    best, plan = np.inf, []
    for m in range(2, 7):  # partitions a word
        options = []
        for w, joint in enumerate(counts):
            ones = np.diag(joint).copy()
            for g in grouped_bits(*information(ones, joint, n), m):
                row = []
                for t, x in enumerate(_met(g, ones, joint, n, 2)):
                    found = sum(comb(len(g), i) * p**i * (1 - p) ** (len(g) - i) for i in range(t + 1))
                    row.append((-np.log1p(-min(found, 1 - 1e-12)) / goal * STEPS, comb(len(g), t) * ROW_COST + corpus / 2 * x * PAIR_COST, Part(g, t, w)))
                options.append(row)
        cost = np.full(STEPS + 1, np.inf)
        cost[0], choice = 0.0, []
        for row in options:
            new, pick = cost.copy(), np.zeros(STEPS + 1, np.int64)  # 0: left out
            for j, (gain, c, _) in enumerate(row):
                to = np.minimum(np.arange(STEPS + 1) + int(gain), STEPS)
                for s in range(STEPS + 1):
                    if cost[s] + c < new[to[s]]:
                        new[to[s]], pick[to[s]] = cost[s] + c, (j + 1) * (STEPS + 1) + s
            choice.append(pick)
            cost = new
        if cost[STEPS] < best:
            best, plan, s = cost[STEPS], [], STEPS
            for row, pick in zip(options[::-1], choice[::-1]):
                if pick[s]:
                    j, s = divmod(int(pick[s]), STEPS + 1)
                    plan.append(row[j - 1][2])
    if not plan:
        raise ValueError("fingerprints of so few words can't find that many of the pairs: ask for more words")
    return plan[::-1]


def bit_counts(nodes: DataFrame, n_words: int = 1) -> tuple[np.ndarray, int]:
    """Of all nodes (fp): (words, 64, 64) joint ones of two bits of a word, on the diagonal the ones; and how many there are.

    One row a task, added up in two rounds, so that no task adds up very many.
    """
    size = n_words * BITS * BITS

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((n_words, BITS, BITS), np.int64), 0
        for batch in batches:
            for a in range(0, len(batch), 16384):
                x = np.stack(batch["fp"].iloc[a : a + 16384].to_numpy()).astype(np.int64)
                bits = np.unpackbits(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), n_words, 8), axis=2, bitorder="little").astype(np.float32)
                for w in range(n_words):
                    total[w] += (bits[:, w].T @ bits[:, w]).astype(np.int64)
            n += len(batch)
        if n:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId() % 64], "c": [np.append(total.ravel(), n).tobytes()]})

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for c in batch["c"]:
                total += np.frombuffer(c, np.int64)
        yield pd.DataFrame({"part": [0], "c": [total.tobytes()]})

    kind, flat = "part int, c binary", np.zeros(size + 1, np.int64)
    sums = nodes.select(F.slice("fp", 1, n_words).alias("fp")).mapInPandas(partial, kind).repartition(16, "part").mapInPandas(added, kind)
    for r in sums.repartition(1).mapInPandas(added, kind).collect():  # one row
        flat += np.frombuffer(bytes(r.c), np.int64)
    return flat[:-1].reshape(n_words, BITS, BITS).astype(float), int(flat[-1])


def _forest(fp: np.ndarray, limit: int, full: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (row, row) of the fingerprints within ``limit`` bits in the first word and ``full`` in all."""
    left, a, b = np.arange(len(fp)), [], []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(fp[left, 0] ^ fp[x, 0]) <= limit
            if fp.shape[1] > 1 and near.any():
                at = np.nonzero(near)[0]
                near[at] = np.bitwise_count(fp[left[at]] ^ fp[x]).sum(axis=1) <= full
            if near.any():
                got = left[near]
                a.append(np.full(len(got), x))
                b.append(got)
                front += got.tolist()
                left = left[~near]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _pairs(group: np.ndarray, fp: np.ndarray, limit: int, full: int, widest: int) -> tuple[np.ndarray, np.ndarray]:
    """All links (row, row) inside groups of at most ``widest`` adjacent rows."""
    a, b = [], []
    for d in range(1, widest):
        i = np.nonzero(group[d:] == group[:-d])[0]
        if not len(i):
            break
        i = i[np.bitwise_count(fp[i, 0] ^ fp[i + d, 0]) <= limit]
        if fp.shape[1] > 1:
            i = i[np.bitwise_count(fp[i] ^ fp[i + d]).sum(axis=1) <= full]
        a.append(i)
        b.append(i + d)
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


#: Files of up to so many rows are compared all at once, larger ones breadth-first.
SMALL = 16


def _links(limit: int, full: int, keys: list[str], file_rows: int = FILE_ROWS):
    """A mapInPandas function over rows sorted by keys: links, and a mark (kind 1) for each file above file_rows."""
    cut = len(keys) == 2  # files of blocks are no larger than they were made

    def closed(ks: np.ndarray, ids: np.ndarray, fp: np.ndarray) -> list[pd.DataFrame]:
        """Links of whole files."""
        new = np.ones(len(ks), bool)
        new[1:] = (ks[1:] != ks[:-1]).any(axis=1)
        start, group = np.nonzero(new)[0], np.cumsum(new) - 1
        size = np.diff(np.append(start, len(ks)))
        small = (size > 1) & (size <= SMALL)
        rows = np.nonzero(small[group])[0]
        i, j = _pairs(group[rows], fp[rows], limit, full, SMALL)
        out = [pd.DataFrame({"kind": 0, "a": ids[rows[i]], "b": ids[rows[j]]})]
        for g in np.nonzero(size > SMALL)[0]:
            s, e = start[g], start[g] + size[g]
            if cut and size[g] > file_rows:
                out.append(pd.DataFrame({"kind": [1], "a": [ks[s, 0]], "b": [ks[s, 1]]}))
                continue
            i, j = _forest(fp[s:e], limit, full)
            out.append(pd.DataFrame({"kind": 0, "a": ids[s + i], "b": ids[s + j]}))
        return [x for x in out if len(x)]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []  # parts of the file that is open
        n, hot = 0, None
        for batch in batches:
            if not len(batch):
                continue
            ks = np.stack([batch[c].to_numpy(np.int64) for c in keys], axis=1)
            ids = batch["node"].to_numpy(np.int64)
            fp = np.stack(batch["fp"].to_numpy()).astype(np.int64).view(np.uint64)
            last = int(np.nonzero((ks != ks[-1]).any(axis=1))[0].max(initial=-1)) + 1  # where the batch's last file begins
            for a, b, ends in ((0, last, True), (last, len(ks), False)):
                if a == b:
                    continue
                if held and (ks[a] != held[-1][0][-1]).any() or hot is not None and (ks[a] != hot).any():
                    yield from closed(*map(np.concatenate, zip(*held))) if held else []
                    held, n, hot = [], 0, None
                if hot is not None:
                    if not ends:
                        continue
                    keep = (ks[a:b] != hot).any(axis=1)
                    a, hot = a + int(np.argmax(keep)) if keep.any() else b, None
                    if a == b:
                        continue
                held.append((ks[a:b], ids[a:b], fp[a:b]))
                n += b - a
                if ends:
                    yield from closed(*map(np.concatenate, zip(*held)))
                    held, n = [], 0
                elif cut and n > 2 * file_rows and (held[0][0][0] == held[-1][0][-1]).all():
                    hot = held[-1][0][-1]  # far too many rows of one file to hold: it is marked now, and the rest passed over
                    yield pd.DataFrame({"kind": [1], "a": [hot[0]], "b": [hot[1]]})
                    held, n = [], 0
        if held:
            yield from closed(*map(np.concatenate, zip(*held)))

    return search


def filed_by(nodes: DataFrame, plan: list[Part], kept: int = 1) -> DataFrame:
    """(node, fp, mask_id, part): nodes (node, fp) under their partitions' values; fp has the first ``kept`` words."""
    masks = [(p.word, m - (1 << 64) if m >= 1 << 63 else m) for p in plan for m in p.masks()]
    values = F.array(*[F.col("fp")[w].bitwiseAND(F.lit(m).cast("long")) for w, m in masks])
    filed = nodes.select("node", F.slice("fp", 1, kept).alias("fp"), F.posexplode(values).alias("mask_id", "part"))
    return filed.withColumn("mask_id", F.col("mask_id").cast("long"))


def links(nodes: DataFrame, limit: int, file_rows: int = FILE_ROWS) -> DataFrame:
    """Links (a, b) that span the components of nodes (node, fp) within ``limit`` bits of one word."""
    counts, n = bit_counts(nodes)
    return _searched(filed_by(nodes, allocate(np.diag(counts[0]).copy(), counts[0], n, limit)), limit, BITS, file_rows)


def similar_links(nodes: DataFrame, similarity: float, n_words: int, missed: float, corpus: int, file_rows: int = FILE_ROWS) -> DataFrame:
    """Links of nodes (node, fp, n) of more than SHORT shingles that meet in a file of the planned partitions and lie within
    ``bit_bounds`` in the first word and in the first VERIFIED_WORDS."""
    counts, n = bit_counts(nodes, n_words)
    long = nodes.where(F.col("n") > SHORT)
    plan = allocate_likely(counts, n, similarity, missed, corpus)
    return _searched(filed_by(long, plan, VERIFIED_WORDS), *bit_bounds(similarity), file_rows)


def short_links(nodes: DataFrame, file_rows: int = FILE_ROWS) -> DataFrame:
    """Links of nodes (node, fp, prefix) that share a shingle of their prefixes and lie within SHORT_BOUNDS."""
    filed = nodes.select("node", F.slice("fp", 1, VERIFIED_WORDS).alias("fp"), F.lit(0).cast("long").alias("mask_id"), F.explode("prefix").alias("part"))
    return _searched(filed, *SHORT_BOUNDS, file_rows)


def _similar(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Spanning links (row, row) of the sets of at least that Jaccard similarity, by the rows of each element."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    enough = lambda both, x, y: both >= similarity * (size[x] + size[y] - both) - 1e-9
    if len(sets) == 2:
        return [(0, 1)] if enough(len(np.intersect1d(*sets, assume_unique=True)), 0, 1) else []
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)[np.argsort(code, kind="stable")]
    count = np.bincount(code)
    begin, edge = np.cumsum(count) - count, np.cumsum(size) - size
    left, out = np.ones(len(sets), bool), []
    for first in range(len(sets)):
        if not left[first]:
            continue
        front, left[first] = [first], False
        while front and left.any():
            x = front.pop()
            c = code[edge[x] : edge[x] + size[x]]
            n = count[c]
            rows = owner[np.repeat(begin[c] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            both = np.bincount(rows, minlength=len(sets))
            got = np.nonzero(left & enough(both, x, slice(None)))[0]
            left[got] = False
            out += [(x, y) for y in got.tolist()]
            front += got.tolist()
    return out


def _verified(similarity: float):
    """A mapInPandas function over rows (root, lo, hi, node, held) sorted by the first three: the links of each group."""

    def links_of(group: list[tuple]) -> list[tuple[int, int]]:
        held = dict(group)
        nodes = list(held)
        return [(nodes[i], nodes[j]) for i, j in _similar([np.frombuffer(x, np.uint64) for x in held.values()], similarity)] if len(nodes) > 1 else []

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, at = [], None
        for batch in batches:
            out = []
            for *key, node, held in batch[["root", "lo", "hi", "node", "held"]].itertuples(index=False):
                if key != at:
                    out += links_of(group)
                    group, at = [], key
                group.append((node, held))
            yield pd.DataFrame(out, columns=["a", "b"])
        yield pd.DataFrame(links_of(group), columns=["a", "b"])

    return search


def verified_links(ids: DataFrame, fps: DataFrame, candidates: DataFrame, k: int, similarity: float, at_once: int = VERIFIED_AT_ONCE) -> DataFrame:
    """Links that span the components of similar nodes, by the sets themselves, inside each component of the candidates.

    A component's nodes are compared with each other, so that no link is lost with a candidate that another one replaced.
    Components of more than at_once shingles are cut into blocks; each pair of blocks is one group.
    """
    per = fps.join(components(candidates), "node").groupBy("node", "root").agg(F.min(F.struct("doc_id", "tag")).alias("one"), F.first("n").alias("n"))
    per = materialise(per.select("node", "root", "n", F.col("one.doc_id").alias("_id"), F.col("one.tag").alias("_tag")), "asked")
    sizes = per.groupBy("root").agg(F.ceil(F.sum("n") / F.lit(at_once // 2 * 0.9)).cast("int").alias("blocks"), F.sum("n").alias("all"))
    sizes = sizes.select("root", F.when(F.col("all") <= at_once, 1).otherwise(F.col("blocks")).alias("blocks"))

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "root": batch["root"], "blocks": batch["blocks"], "held": [np.unique(shingle_hashes(t, k)).tobytes() for t in batch["text"]]})

    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag"))
    held = ids.join(per.join(sizes, "root"), same).select("node", "root", "blocks", F.col("text").cast("string").alias("text"))
    held = held.mapInPandas(sets, "node long, root long, blocks int, held binary")
    i = F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int")
    cut = held.select("node", "root", "held", i.alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    cut = cut.select("node", "root", "held", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"))
    keys = ["root", "lo", "hi"]
    return cut.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(_verified(similarity), "a long, b long")


def _searched(filed: DataFrame, limit: int, full: int, file_rows: int) -> DataFrame:
    """Links inside the files (mask_id, part) of filed (node, fp, mask_id, part)."""
    near = filed.repartition("mask_id", "part").sortWithinPartitions("mask_id", "part").mapInPandas(_links(limit, full, ["mask_id", "part"], file_rows), "kind int, a long, b long")
    near = materialise(near, "near")
    out, hot = near.where("kind = 0").select("a", "b"), near.where("kind = 1").select(F.col("a").alias("mask_id"), F.col("b").alias("part")).distinct()
    if not hot.isEmpty():
        in_hot = filed.join(hot, ["mask_id", "part"])
        # Blocks of half a file, as many as the hot file needs; each pair of blocks is one group.
        sizes = in_hot.groupBy("mask_id", "part").agg(F.ceil(F.count(F.lit(1)) / F.lit(file_rows // 2 * 0.9)).cast("int").alias("blocks"))
        cut = in_hot.join(sizes, ["mask_id", "part"]).withColumn("i", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
        cut = cut.select("node", "fp", "mask_id", "part", "i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
        cut = cut.select("node", "fp", "mask_id", "part", F.least("i", "j").cast("long").alias("lo"), F.greatest("i", "j").cast("long").alias("hi"))
        keys = ["mask_id", "part", "lo", "hi"]
        more = cut.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(_links(limit, full, keys, file_rows), "kind int, a long, b long")
        out = out.union(materialise(more.select("a", "b"), "near"))
    return out


def classes(fps: DataFrame, find) -> DataFrame:
    """(node, component_id) for each distinct fingerprint of fps (doc_id, node, ...); find: nodes -> links."""
    other = [c for c in ("fp", "n", "prefix") if c in fps.columns]
    per = fps.groupBy("node").agg(*[F.first(c).alias(c) for c in other], F.min("doc_id").alias("low"))
    per = materialise(per, "nodes")
    roots = components(find(per.select("node", *other)))
    joined = per.select("node", "low").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    joined = materialise(joined, "roots")
    # Written, so that the join's sides are plain shuffles, of which a very large component's can be split.
    lows = materialise(joined.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    return joined.join(lows, "root").select("node", "component_id")


def near_duplicates(docs: DataFrame, k: int = 3, limit: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row: links at ``limit`` bits of a 64-bit fingerprint."""
    fps = materialise(fingerprints(docs, k).withColumn("node", F.col("fp")[0]), "fingerprints")
    out = fps.join(classes(fps, lambda nodes: links(nodes, limit)), "node")
    return out.select("doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")


#: The similarity form. Its fingerprints have SIMILAR_WORDS words; its plan misses at most MISSED of the pairs at the
#: similarity itself, fewer above it, and is the cheapest for a corpus of CORPUS different texts. Candidates are within bounds
#: on 256 bits, and are then verified by the Jaccard similarity itself.
SIMILAR_WORDS, VERIFIED_WORDS, MISSED, CORPUS = 16, 4, 0.005, 10_000_000


def bit_bounds(similarity: float, n_words: int = VERIFIED_WORDS) -> tuple[int, int]:
    """Bounds on the first word and on all: the mean at the similarity and four standard deviations on top."""
    p = differing(similarity)
    sd = lambda n: (n * p * (1 - p)) ** 0.5
    return int(BITS * p + 4 * sd(BITS)), int(BITS * n_words * p + 4 * sd(BITS * n_words))


def keep_one(docs: DataFrame, k: int = 5, similarity: float = 0.8, key: str = "doc_id", n_words: int = SIMILAR_WORDS, missed: float = MISSED, corpus: int = CORPUS) -> DataFrame:
    """The input rows with one row of each group of near copies: the one of smallest key, null ones last (all columns as
    they came). Of a group's different texts of that key, the one of smallest hash stays.

    Near copies are texts whose sets of k-word shingles have at least the given Jaccard similarity, and a group is all that
    such pairs connect. Repeated rows of that key are one row. Texts without words are left as they are, repeated rows as one.
    No pair below the similarity is a link. A pair at or above it is missed with a chance of at most ``missed`` by the
    partitions and some 0.0001 by the bounds, unless other links connect its texts. ``n_words`` and ``corpus`` shape the plan:
    much larger corpora need more words for wider partitions.
    """
    tag = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    ids = docs.select(F.col(key).cast("long").alias("doc_id"), "text", tag.alias("tag"))
    fps = materialise(fingerprints(ids, k, n_words, "tag long", similarity), "fingerprints")
    ranked = fps.withColumn("doc_id", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag"))

    def find(nodes: DataFrame) -> DataFrame:
        return verified_links(ids, fps, similar_links(nodes, similarity, n_words, missed, corpus).union(short_links(nodes)), k, similarity)

    groups = classes(ranked.where("n > 0"), find)
    kept = groups.select("component_id.*").union(ranked.where("n = 0").select("doc_id.*"))
    # Plain keys, so that the rows are dealt out once for both: repeated ones go before the shuffle, and no key is hot after it.
    at, given = ["_none", "_key", "_tag"], F.col(key).cast("long")
    kept = kept.select(F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("_key"), F.col("tag").alias("_tag")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), given.isNull().alias("_none"), F.coalesce(given, F.lit(0).cast("long")).alias("_key"), tag.alias("_tag"))
    nth = F.row_number().over(Window.partitionBy(*at).orderBy(F.lit(0)))
    return rows.withColumn("_n", nth).where("_n = 1").join(kept, at, "left_semi").select("_row.*")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
