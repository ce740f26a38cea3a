"""Each operator against a plain restatement of what it returns."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
import xxhash
from conftest import SF, same
from pyspark.sql import functions as F

from tests.llm.conftest import EDGE, make
from tidewarden.llm import classifier, components, language_model, licenses, mixing, neighbours, packing, quality_rules, queries, sequences, simhash, suffixes, tokens
from tidewarden.llm.common import new_path, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").toPandas()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, duck, name):
    same(queries.QUERIES[name](spark, SF).toPandas(), duck.sql(queries.SQL[name]).df())


# quality rules


def plain_measures(text):
    text = text or ""
    w = WORD.findall(text)
    seen = defaultdict(list)
    for i in range(len(w) - 7):
        seen[tuple(w[i : i + 8])].append(i)
    inside = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_quality_measures(spark, edge, empty):
    got = quality_rules.measure(edge).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert Counter(map(tuple, got)) == Counter((i, *plain_measures(t)) for i, t in EDGE)
    assert quality_rules.apply_policy(quality_rules.ledger(empty)).count() == 0


def test_quality_policies_and_ablation(spark):
    led = quality_rules.ledger(table(spark, SF, "documents")).cache()
    for policy in quality_rules.POLICIES:
        kept = {(r.doc_id, r.failures & quality_rules.mask(policy) == 0) for r in led.collect()}
        assert {(r.doc_id, r.kept) for r in quality_rules.apply_policy(led, policy).collect()} == kept
    rows = led.collect()
    for r in quality_rules.ablation(led, "v2").collect():
        assert r.failed == sum(bool(x.failures & r.bit) for x in rows) and r.failed_alone == sum(x.failures == r.bit for x in rows)


# mixing


def plain_targets(sizes, weights, epochs=3.0):
    left, fixed, total = dict(sizes), {}, float(sum(sizes.values()))
    while left:
        w = sum(weights[s] for s in left)
        share = {s: (total - sum(fixed.values())) * weights[s] / w for s in left}
        over = [s for s in left if share[s] > epochs * left[s]]
        if not over:
            return fixed | share
        for s in over:
            fixed[s] = epochs * left.pop(s)
    return fixed


@pytest.mark.parametrize("seed", range(3))
def test_mixing(spark, seed):
    rng = np.random.default_rng(seed)
    names = ["b", None, "a", "é", "c", "", "z"]
    rows = [(int(i), "w " * int(rng.integers(0, 60)), names[min(6, int(rng.exponential(1.5)))]) for i in range(600)]
    out = mixing.mix(make(spark, rows)).toPandas()
    sizes = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in {r[2] for r in rows}}
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    want = plain_targets(sizes, {s: i % 3 + 1 for i, s in enumerate(order)})
    assert len(out) == len(rows) and (out.epochs <= 3).all()
    for s in order:
        g = out[out.source.isna()] if s is None else out[out.source == s]
        assert np.allclose(g.target, want[s]) and (g.source_size == sizes[s]).all()
        assert abs((g["size"] * g.epochs).sum() - want[s]) <= 30
    again = mixing.mix(make(spark, rows[::-1])).toPandas()
    assert dict(zip(out.doc_id, out.epochs)) == dict(zip(again.doc_id, again.epochs))


def test_mixed_rows(spark, edge, empty):
    out = mixing.mix(edge)
    assert out.count() == len(EDGE) and mixing.mix(empty).count() == 0
    times = {(r.doc_id, r["size"]): r.epochs for r in out.collect() if r.doc_id not in (None, 11)}
    rows = mixing.repeated(edge)
    assert rows.columns == edge.columns and mixing.repeated(empty).count() == 0
    got = Counter(r.doc_id for r in rows.collect())
    assert all(got[i] == n for (i, _), n in times.items())


# licences


def test_licence_forms(spark, empty):
    mit = licenses.FULL_TEXTS["MIT"]
    rows = [
        (1, "Copyright (c) 2020 Some One\n\n" + mit.upper()), (2, "// " + mit.replace(",", " ,\n//")), (3, mit.replace("sublicense", "sub-licence") + "\n(c) Me"), (4, "Some prose.\nReleased under the MIT License."),
        (5, "Licensed under the Apache Licence, version 2.0"), (6, mit + " And more."), (7, None), (8, "This work is licensed under the GNU General Public License, version 3.\nLicensed under CC BY-NC 4.0."), (9, ""), (9, ""),
    ]
    known = licenses.known_digests(spark)
    got = {r.doc_id: (r.text_licence, r.licences, r.n_matches, r.restricted) for r in licenses.scan(make(spark, rows), known, 2000).collect()}
    assert [got[i][0] for i in range(1, 4)] == ["MIT"] * 3
    assert got[4] == (None, "MIT", 1, False) and got[5] == ("Apache-2.0", "Apache-2.0", 1, False) and got[6] == (None, "", 0, False) and got[7] == (None, "", 0, False)
    assert got[8] == (None, "CC-BY-NC-4.0,GPL-3.0", 2, True)
    assert licenses.scan(make(spark, rows), known, 2000).count() == len(rows)
    assert licenses.scan(empty, known, 2000).count() == 0
    assert known.count() <= licenses.MAX_KNOWN


ZLIB = """Copyright (c) 1999 Some One

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.
"""


def test_licences_by_their_whole_texts(spark, tmp_path):
    found = {n: Path("/usr/share/common-licenses", n) for n in ("GPL-2", "MPL-2.0")}
    rows = [(1, ZLIB), (2, "MIT License\n\nCopyright (c) 2020 Some One\n\n" + licenses.FULL_TEXTS["MIT"])] + [(3 + i, p.read_text()) for i, p in enumerate(found.values()) if p.exists()]
    make(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.text_licence, r.restricted) for r in licenses.op1_license_scan(spark, str(tmp_path)).collect()}
    want = {1: ("Zlib", False), 2: ("MIT", False), 3: ("GPL-2.0", True), 4: ("MPL-2.0", True)}
    assert got == {i: want[i] for i, _ in rows}
    assert {*licenses.FULL_TEXTS, *licenses.FULL_DIGESTS} >= set(licenses.NAMES) - {"AGPL-3.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0"}


def test_licence_edges(spark, edge):
    out = licenses.scan(edge, licenses.known_digests(spark), 2000).toPandas()
    assert len(out) == len(EDGE) and out.text_digest.notna().all()


# classifier


def test_classifier_on_held_out_labels(spark):
    sf = SF.replace("0.001", "0.01")
    out = classifier.op5_quality_classifier(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    assert len(out) == 1000 and out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.3)).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    both = out.merge(labels, on="doc_id")
    both = both[both.held_out]
    assert (both.predicted == both.quality).mean() > 0.95 and both.predicted[both.quality == 1].mean() > 0.97


def test_classifier_equals_plain_densities(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    stats, names = classifier.statistics(docs.select("doc_id", "text"))
    known = stats.join(classifier.clean_labels(labels), "doc_id")
    model = classifier.fit(known, names, to_pooled=0.1, to_identity=0.02)
    x = known.select("label", *names, model.score().alias("s")).toPandas()
    z = ((x[names] - x[names].mean()) / x[names].std(ddof=0).clip(lower=1e-3)).to_numpy()
    y = x.label.to_numpy()
    cov = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    pooled = sum((y == k).mean() * cov[k] for k in (0, 1))
    dens = []
    for k in (0, 1):
        c = 0.9 * cov[k] + 0.1 * pooled
        c = 0.98 * c + 0.02 * np.trace(c) / len(names) * np.eye(len(names))
        d = z - z[y == k].mean(axis=0)
        dens.append(np.log((y == k).mean()) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * (d @ np.linalg.inv(c) * d).sum(axis=1))
    assert np.allclose(x.s, 1 / (1 + np.exp(-np.clip(dens[1] - dens[0], -500, 500))), atol=1e-6)


def test_classifier_edges(spark, edge, empty):
    labels = spark.createDataFrame([(1, 0), (2, None), (3, 2), (6, 1), (6, 0), (7, 1)], "doc_id long, quality int")
    out = classifier.classify(edge, labels).toPandas()
    assert len(out) == len(EDGE) and out.score.between(0, 1).all()
    assert classifier.classify(empty, labels).count() == 0
    assert set(classifier.classify(edge, labels.limit(0)).toPandas().score) == {0.5}
    good = classifier.keep_good(edge, labels)
    assert good.columns == edge.columns


# tokens, packing, sequences


def plain_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_ids_are_the_vocabularys_own(spark):
    texts = [t for _, t in EDGE] + documents(spark).text.tolist()[:60] + ["a" * 5000, " " * 3000, "\n" * 999, "x1 " * 4000]
    assert tokens.quick_is_equal(tokens.vocabulary())
    for quick in (True, False):
        encode = tokens.encoder(tokens.vocabulary(), quick)
        for text, ids in zip(texts, plain_ids(texts)):
            assert encode(text or "").tolist() == ids and encode.count(text or "") == len(ids)


def check_packing(out, ids_of, capacity):
    """ids_of: (doc_id, ids) per document, the closing id included."""
    out = out.sort_values(["sequence_id", "offset"])
    ends = (out.offset + out.length).groupby(out.sequence_id).shift(fill_value=0)
    assert (ends == out.offset).all() and (out.offset + out.length <= capacity).all() and (out.length > 0).all()
    want = Counter()
    for i, ids in ids_of:
        first = len(ids) % capacity
        edges = ([0, first] if first else [0]) + list(range(first + capacity, len(ids) + 1, capacity))
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    got = Counter((None if pd.isna(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out.itertuples())
    assert got == want


def test_packing(spark):
    d = documents(spark)
    out = packing.op2_packing(spark, SF).toPandas()
    check_packing(out, [(i, x + [0]) for i, x in zip(d.doc_id, plain_ids(d.text))], 2048)
    assert out.sequence_id.nunique() <= 1.01 * math.ceil(out.length.sum() / 2048) + 1


def test_packing_edges(spark, edge, empty):
    for capacity in (64, 2048):
        out = packing.pack(edge, capacity).toPandas()
        check_packing(out, [(i, x + [0]) for (i, _), x in zip(EDGE, plain_ids([t for _, t in EDGE]))], capacity)
    assert packing.pack(empty).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_packing_plan(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(5, 1.2, 5000).astype(int), 1, 1000)
    hist = dict(Counter(lengths.tolist()))
    plan = packing.plan(hist, 1000, groups=[32, 64, 256, 1024][seed], large=[8, 4, 3, 2][seed])
    fill, ranks = Counter(), Counter()
    for r in plan.itertuples():
        ranks[r.length] += r.rank_to - r.rank_from
        for k in range(r.rank_to - r.rank_from):
            fill[r.first_sequence + k] += r.length
    assert ranks == hist and max(fill.values()) <= 1000 and len(fill) <= 1.08 * lengths.sum() / 1000 + 2
    assert packing.plan({}, 1000).empty and packing.cut(0 + 1, 4) == [(0, 1)]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(n):
    p = sequences.permute(np.arange(n), n)
    assert sorted(p.tolist()) == list(range(n))
    assert n < 64 or (p.tolist() != sequences.permute(np.arange(n), n, key=1).tolist() and p.tolist() != list(range(n)))


def test_sequences_round_trip(spark, edge, empty):
    for docs, texts in ((edge, [t for _, t in EDGE]), (table(spark, SF, "documents"), documents(spark).text)):
        uri = new_path(spark, "test")
        out = sequences.write_shards(docs, uri, length=128, per_shard=16).toPandas().sort_values("slot")
        assert out.slot.tolist() == list(range(len(out)))
        rows = list(sequences.read_slots(uri))
        assert [zlib.crc32(r[:n].astype("<u4").tobytes()) for r, n in zip(rows, out.n_tokens)] == out.ids_crc32.tolist()
        assert all(np.array_equal(a, b) for a, b in zip(sequences.read_slots(uri, 37), rows[37:]))
        order = out.sort_values("sequence_id")
        stream = np.concatenate([rows[s][:n] for s, n in zip(order.slot, order.n_tokens)])
        ids = [x + [0] for x in plain_ids(texts)]
        assert stream.tolist() == [i for x in ids for i in x]  # in order, as the tasks follow the rows
        again = sequences.write_shards(docs, uri, length=128, per_shard=16).toPandas().sort_values("slot")
        assert again.reset_index(drop=True).equals(out.reset_index(drop=True))
    uri = new_path(spark, "test")
    assert sequences.write_shards(empty, uri).count() == 0 and list(sequences.read_slots(uri)) == []


def test_sequences_replace_those_of_another_corpus(spark):
    uri = new_path(spark, "test")
    for word, key in (("one ", 1), ("two ", 1), ("two ", 2)):
        docs = make(spark, [(i, word * (100 + i)) for i in range(20)])
        out = sequences.write_shards(docs, uri, length=16, per_shard=8, key=key).toPandas().sort_values("slot")
        rows = list(sequences.read_slots(uri))
        assert [zlib.crc32(r[:n].astype("<u4").tobytes()) for r, n in zip(rows, out.n_tokens)] == out.ids_crc32.tolist()


def changing(docs, marker):
    """docs, whose texts become others of as many rows once the marker is there, and whose last row is missing once it says so."""
    return docs.mapInPandas(lambda bs: (b if not marker.exists() else b[b.doc_id < 19] if marker.read_text() else b.assign(text="two") for b in bs), docs.schema)


def test_sequences_are_tokenised_once(spark, monkeypatch, tmp_path):
    kept, marker, folder = tmp_path / "kept", tmp_path / "marker", new_path(spark, "test")
    monkeypatch.setattr(sequences, "new_path", lambda spark, label: f"file://{kept}")
    docs = changing(make(spark, [(i, "one " * (100 + i)) for i in range(20)]), marker)
    lazy = sequences.write_shards(docs, folder, length=16, per_shard=8)
    assert any(kept.iterdir())
    marker.touch()
    out = lazy.toPandas().sort_values("sequence_id")  # ids of the first reading, as the second doesn't tokenise
    rows = list(sequences.read_slots(folder))
    stream = np.concatenate([rows[s][:n] for s, n in zip(out.slot, out.n_tokens)])
    assert Counter(stream.tolist()) == Counter(i for x in plain_ids(["one " * (100 + i) for i in range(20)]) for i in [*x, 0])
    assert not any(kept.iterdir())
    with pytest.raises(Exception, match="split in another way"):  # used up: tokenised anew, and not what was counted
        lazy.select("*").toPandas()
    marker.unlink()
    assert lazy.select("*").toPandas().sort_values("sequence_id").reset_index(drop=True).equals(out.reset_index(drop=True))
    lazy = sequences.write_shards(docs, folder, length=16, per_shard=8)
    marker.write_text("less")
    with pytest.raises(Exception, match="split in another way"):
        lazy.toPandas()


def test_sequences_of_tasks_without_rows(spark):
    docs, folder = make(spark, [(1, "one two"), (2, None)]).repartition(7), new_path(spark, "test")
    out = sequences.write_shards(docs, folder, length=4, per_shard=2).toPandas()
    ids = Counter(i for r, n in zip(sequences.read_slots(folder), out.sort_values("slot").n_tokens) for i in r[:n].tolist())
    assert ids == Counter(i for x in plain_ids(["one two", ""]) for i in [*x, 0])


def test_sequences_refuse_ids_that_do_not_fit(spark):
    with pytest.raises(Exception, match="does not fit 1 bytes"):
        sequences.write_shards(make(spark, [(1, "one two größe")]), new_path(spark, "test"), bytes_per_id=1)


# near duplicates


def plain_print(text, k=3):
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[j : j + k]), 42) for j in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_classes(rows, limit=3, k=3):
    """Fingerprint and smallest key reachable of each (key, text)."""
    prints = [plain_print(t, k) for _, t in rows]
    left, comp = set(range(len(rows))), {}
    while left:
        seen = {left.pop()}
        front = list(seen)
        while front:
            x = front.pop()
            near = {y for y in left if (prints[x] ^ prints[y]).bit_count() <= limit}
            left -= near
            seen |= near
            front += near
        ids = [rows[i][0] for i in seen if rows[i][0] is not None]
        comp |= {i: min(ids, default=None) for i in seen}
    return Counter((rows[i][0], f"{prints[i]:016x}", comp[i]) for i in range(len(rows)))


def as_counter(df):
    return Counter((r.doc_id, r.fingerprint, r.component_id) for r in df.collect())


def test_simhash(spark, edge, empty):
    d = documents(spark)
    assert as_counter(simhash.op4_simhash(spark, SF)) == plain_classes(list(zip(d.doc_id, d.text)))
    small = [(i, (t or "")[:3000]) for i, t in EDGE]
    assert as_counter(simhash.near_duplicates(make(spark, small))) == plain_classes(small)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.near_duplicates(edge).count() == len(EDGE)


def nodes_of(spark, prints):
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    return spark.createDataFrame([(p, [p], 10) for p in signed], "node long, fp array<long>, n long"), signed


@pytest.mark.parametrize("file_rows,limit", [(4096, 3), (8, 3), (4096, 6), (8, 1)])
def test_links_span_the_true_components(spark, file_rows, limit):
    """Dense balls of fingerprints, also with files far above their size."""
    rng = np.random.default_rng(limit)
    prints = set()
    for _ in range(12):
        centre = int(rng.integers(0, 1 << 63)) * 2 + 1
        for _ in range(25):
            prints.add(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)))
    prints |= {int(x) for x in rng.integers(0, 1 << 63, 200)}
    df, signed = nodes_of(spark, sorted(prints))
    found = components.components(simhash.links(df, limit, file_rows=file_rows))
    got = {r.node: r.root for r in found.collect()}
    u = [s & (1 << 64) - 1 for s in signed]
    parent = list(range(len(u)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(u)):
        for j in range(i):
            if (u[i] ^ u[j]).bit_count() <= limit:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(u)):
        groups[root(i)].append(signed[i])
    want = {x: min(g) for g in groups.values() if len(g) > 1 for x in g}
    assert got == want


def test_links_with_unequal_thresholds(spark, monkeypatch):
    """Correlated bits make partitions of unequal sizes; where filed rows cost little, thresholds are unequal too."""
    rng = np.random.default_rng(5)
    bits = rng.integers(0, 2, (1500, 64))
    for b in range(1, 24):
        bits[:, b] = np.where(rng.random(len(bits)) < 0.03, bits[:, b], bits[:, 0])
    prints = {int(x) for x in np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view(np.uint64).ravel()}
    prints |= {x ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)) for x in list(prints)[:400]}
    df, signed = nodes_of(spark, sorted(prints))
    counts, n = simhash.bit_counts(df)
    assert n == len(prints)

    def plan(cost):
        monkeypatch.setattr(simhash, "ROW_COST", cost)
        return simhash.allocate(np.diag(counts[0]).copy(), counts[0], n, 3)

    sizes = [len(p.bits) for p in plan(0.5)]
    assert max(sizes) >= 2 * min(sizes)
    assert any(len({p.threshold for p in plan(c)}) > 1 for c in (0.1, 0.03, 0.01, 0.003, 0.001, 0.0003, 0.0001))
    got = {r.node: r.root for r in components.components(simhash.links(df, 3)).collect()}
    u = np.array([x & (1 << 64) - 1 for x in signed], np.uint64)
    root = np.array(signed)
    near = [np.nonzero(np.bitwise_count(u ^ x) <= 3)[0] for x in u]
    changed = True
    while changed:
        low = np.array([root[a].min() for a in near])
        changed, root = (low != root).any(), low
    assert got == {s: int(r) for s, r, a in zip(signed, root, near) if len(a) > 1}


def test_plans_for_a_similarity(spark):
    """The chance of a miss at the similarity is as asked; the plan leaves out what it doesn't need, and correlated bits first."""
    rng = np.random.default_rng(6)
    bits = rng.integers(0, 2, (4000, 64)).astype(float)
    tied = bits.copy()
    tied[:, 1:32] = np.where(rng.random((4000, 31)) < 0.02, bits[:, 1:32], bits[:, :1])
    counts = np.stack([b.T @ b for b in [bits] * 12 + [tied] * 4])
    for missed, corpus in ((0.005, 10**7), (0.02, 10**6)):
        plan = simhash.allocate_likely(counts, 4000, 0.8, missed, corpus)
        p, miss = simhash.differing(0.8), 1.0
        for part in plan:
            s, t = len(part.bits), part.threshold
            miss *= 1 - sum(math.comb(s, i) * p**i * (1 - p) ** (s - i) for i in range(t + 1))
        assert missed / 2 < miss <= missed and len({(q.word, b) for q in plan for b in q.bits}) == sum(len(q.bits) for q in plan)
        assert not any(q.word >= 12 and len(set(q.bits) & set(range(32))) > 16 for q in plan)
    with pytest.raises(ValueError):
        simhash.allocate_likely(counts[:1], 4000, 0.8, 1e-6, 10**7)


@pytest.mark.parametrize("others", [0, 1500])
def test_recall_of_near_copies(spark, others):
    """Pairs just above the similarity are found, with any number of other texts around; none below is."""
    rng = np.random.default_rng(8)
    draw = lambda n: [f"q{x}" for x in rng.integers(0, 10**6, n)]
    rows, above = [], 0
    for i in range(300):
        w = draw(int(rng.integers(90, 260)))
        n = len(w) - 4
        v = w + draw(math.floor(n / 0.8) + (i % 2 == 0) - n)
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
        same = n / (len(v) - 4) >= 0.8
        above += same
        assert same == bool(i % 2)
    rows += [(10_000 + i, " ".join(draw(80))) for i in range(others)]
    kept = {r.doc_id for r in simhash.keep_one(make(spark, rows)).collect()}
    assert all(i in kept and i + 1 in kept for i in range(0, 600, 4)) and all(10_000 + i in kept for i in range(others))
    assert sum(2 * i + 1 not in kept for i in range(1, 300, 2)) >= 0.97 * above


@pytest.mark.parametrize("n", [100, 10**5, 10**7, 10**10])
def test_thresholds_are_those_of_the_pigeonhole(n):
    rng = np.random.default_rng(1)
    bits = (rng.random((2000, 64)) < rng.uniform(0.3, 0.7, 64)).astype(float)
    joint = bits.T @ bits * (n / 2000)
    plan = simhash.allocate(np.diag(joint).copy(), joint, n, 3)
    if plan[0].threshold < simhash.BITS:
        m = len(plan)
        used = [b for p in plan for b in p.bits]
        assert len(used) == len(set(used))
        # partitions left out count as -1: m of any size must reach limit - m + 1
        assert sum(p.threshold + 1 for p in plan) >= 3 + 1 or m == 1 and plan[0].threshold >= 3
    for _ in range(300):  # two within three bits always share a file
        x = int(rng.integers(0, 1 << 62))
        y = x ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(x & m == y & m for p in plan for m in p.masks())


def test_one_of_each_near_copy(spark, edge, empty):
    rng = np.random.default_rng(3)
    vocab = [f"t{i}" for i in range(4000)]
    rows, originals = [], []
    for i in range(60):
        w = [vocab[j] for j in rng.integers(0, 4000, rng.integers(80, 400))]
        rows.append((i * 10, " ".join(w)))
        originals.append(i * 10)
        for c in range(i % 4):  # copies with few words changed: similarity well above 0.8
            v = list(w)
            for j in rng.choice(len(v), max(1, len(v) // 100), replace=False):
                v[j] = "changed"
            rows.append((i * 10 + 1 + c, " ".join(v)))
    rows += [(1000, rows[0][1]), (1000, rows[0][1])]
    kept = simhash.keep_one(make(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == originals and len(kept.columns) == len(edge.columns)
    assert simhash.keep_one(empty).count() == 0
    few = {(r.doc_id, r.text) for r in simhash.keep_one(edge).collect()}
    assert {i for i, _ in few} >= {1, 2, 3, 4, 5, 6, 7, 12, 13} and sum(i == 11 for i, _ in few) == 1


def plain_groups(rows, similarity=0.8, k=5):
    """The rows' groups of near copies by brute force: lists of indices."""
    sets = [set(simhash.shingle_hashes(t, k).tolist()) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9 and group[i] != group[j]:
                old = group[i]
                group = [group[j] if g == old else g for g in group]
    found = defaultdict(list)
    for i, g in enumerate(group):
        found[g].append(i)
    return list(found.values())


def near_rows(seed):
    """Texts of all sizes with copies that lie on both sides of the similarity, and texts that repeat a passage."""
    rng = np.random.default_rng(seed)
    draw = lambda n: [f"v{x}" for x in rng.integers(0, 100_000, n)]
    texts = []
    for n in [*range(1, 40), 64, 68, 72, 84, 90, *([120, 300] * 20)]:
        w = draw(n)
        texts.append(w)
        for share in (0.71, 0.75, 0.79, 0.81, 0.85):  # words are put after a text: the Jaccard similarity is near to share
            texts.append(w + draw(max(1, round((n - 4) / share) - (n - 4))))
    for _ in range(10):
        w, other = draw(60), draw(60)
        texts += [w * 20 + other, w * 20, other]  # alike if shingles are counted as often as they come
    return [(int(i), " ".join(w)) for i, w in zip(rng.permutation(len(texts)), texts)]


@pytest.mark.parametrize("seed,at_once", [(0, 1 << 21), (1, 1 << 21), (1, 2000)])
def test_near_copies_are_those_of_the_similarity(spark, monkeypatch, seed, at_once):
    monkeypatch.setattr(simhash.verified_links, "__defaults__", (at_once,))
    rows = near_rows(seed)
    want = {min(rows[i][0] for i in g) for g in plain_groups(rows)}
    got = [r.doc_id for r in simhash.keep_one(make(spark, rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_one_near_copy_stays_of_null_and_repeated_keys(spark):
    words = [[f"{g}n{i}" for i in range(150)] for g in "abcde"]
    a, b, c, d, e = ([" ".join(w[:n]) for n in (150, 148, 146, 144)] for w in words)
    rows = [(None, x) for x in a] + [(None, a[0])] + [(7, x) for x in b] + [(9, b[0])] + [(None, c[0]), (11, c[1]), (12, c[2])] + [(13, d[0]), (13, d[0]), (None, d[0])] + [(None, e[0] + x) for x in ("", " ")]
    got = simhash.keep_one(make(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter([None, 7, 11, 13, None])
    assert {r.text.strip() for r in got if r.doc_id is None} & set(a) and all(r.text in b for r in got if r.doc_id == 7)


@pytest.mark.parametrize("seed, links_a_task", [(0, components.LINKS_A_TASK), (1, components.LINKS_A_TASK), (0, 40), (1, 300)])
def test_components(spark, seed, links_a_task):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(i, i + 1) for i in range(1000, 1120)] + [(2000, i) for i in range(2001, 2200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long"), links_a_task).collect()}
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    assert got == {x: r for x, r in label.items() if any(x in e and e[0] != e[1] for e in edges)}


# repeated passages


def plain_removed(rows, depth):
    key = lambda i: math.inf if i is None else i
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in texts:
        for p in range(len(b) - depth + 1):
            w = b[p : p + depth]
            first[w] = min(first.get(w, math.inf), key(i))
    out = Counter()
    for i, b in texts:
        m = np.zeros(len(b) + 2, int)
        for p in range(len(b) - depth + 1):
            if first[b[p : p + depth]] < key(i):
                m[p + 1 : p + 1 + depth] = 1
        kept = bytes(np.frombuffer(b, np.uint8)[m[1:-1] == 0])
        out[i, len(b), int(m.sum()), int((np.diff(m) == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_removed_passages(spark, edge, empty):
    d = documents(spark)
    got = Counter(map(tuple, suffixes.op8_suffix_dedup(spark, SF).collect()))
    assert got == plain_removed(list(zip(d.doc_id, d.text)), 50)
    small = [(i, (t or "")[:20_000]) for i, t in EDGE]
    assert Counter(map(tuple, suffixes.removed(make(spark, small)).collect())) == plain_removed(small, 50)
    assert suffixes.removed(empty).count() == 0


@pytest.mark.parametrize("seed,depth,chunk", [(0, 50, 100), (1, 7, 64), (2, 12, 1000), (3, 3, 10), (4, 50, 1 << 20)])
def test_removed_from_few_letters(spark, monkeypatch, seed, depth, chunk):
    """Texts of few letters: long and short repeats everywhere, over slices of any size."""
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("ab "), rng.integers(1, depth + 5))) for _ in range(25)]
    rows = [(int(rng.integers(0, 30)) if i % 9 else None, "".join(rng.choice(words, rng.integers(0, 12)))) for i in range(60)]
    docs = make(spark, rows)
    keyed = suffixes.keyed_texts(docs)
    spans = {(r.doc, r.tag): r.spans for r in suffixes.spans(keyed, depth, chunk).collect()}
    got = Counter()
    for (i, t), k in zip(rows, keyed.select("doc", "tag").collect()):
        b = t.encode()
        gone = suffixes._merged(spans.get((k.doc, k.tag)))
        got[i, len(b), int((gone[:, 1] - gone[:, 0]).sum()), len(gone), hashlib.sha256(suffixes._kept(b, gone)).hexdigest()] += 1
    assert got == plain_removed(rows, depth)


def test_hot_anchors_are_split(spark, monkeypatch):
    """A passage in every document, each time between other words: its anchors have a context a document."""
    monkeypatch.setattr(suffixes, "HOT", 20)
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 9))
    passage = " ".join(word() for _ in range(9))
    rows = [(i if i % 7 else None, f"{word()} {word()} {passage[: 60 + i % 25]} {word()} {passage[i % 11 :]}{word()}") for i in range(150)]
    docs = make(spark, rows)
    settled = suffixes.settled_runs(suffixes.keyed_texts(docs))
    assert settled.where("kind = 2").count() > 100
    assert Counter(map(tuple, suffixes.removed(docs).collect())) == plain_removed(rows, 50)


def test_many_equal_rows(spark):
    """Equal rows of one key ask for their contexts once."""
    one = "a text that comes very many times under the same key, and shares this much with another"
    rows = [(5, one)] * 4_000 + [(3, "before it stands " + one[20:])]
    docs = make(spark, rows)
    assert suffixes.settled_runs(suffixes.keyed_texts(docs)).where("kind = 1").count() < 20
    assert Counter(map(tuple, suffixes.removed(docs).collect())) == plain_removed(rows, 50)


def test_texts_of_the_null_key_with_equal_32_bit_hashes(spark):
    passage = "a passage of more than fifty bytes that an earlier document has as well"
    numbers = spark.range(300_000).select(F.col("id").cast("string").alias("n"))
    long, short = (numbers.select(F.concat(F.lit(t), "n").alias(c)).select(c, F.hash(c).alias("h")) for c, t in (("a", passage + " and number "), ("b", "another one, no. ")))
    pair = long.join(short, "h").orderBy("h").first()
    rows = [(1, passage), (None, pair.a), (None, pair.b), (None, pair.b + " whose rest " + passage)]
    assert Counter(map(tuple, suffixes.removed(make(spark, rows)).collect())) == plain_removed(rows, 50)


def test_texts_without_repeats(spark, edge, empty):
    passage = "é" * 40 + " a passage that two documents share, word by word, to its end"
    docs = make(spark, [(1, passage + " one"), (2, "two " + passage), (3, None), (4, "x" * 60), (4, "x" * 60)])
    out = {r.doc_id: r.text for r in suffixes.without_repeats(docs).collect()}
    assert out[1] == passage + " one" and out[2].strip() == "two" and out[3] is None and out[4] == "x" * 60
    assert suffixes.without_repeats(docs).columns == docs.columns and suffixes.without_repeats(empty).count() == 0
    assert suffixes.without_repeats(edge).count() == len(EDGE)


# language model


def plain_model(rows, order):
    docs = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    out_of = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    train = [w for i, w in docs if not out_of(i)]
    c = Counter(w for t in train for w in t)
    total, v = sum(c.values()), len(c)
    levels = {order: Counter()}
    for t in train:
        p = ["<s>"] * (order - 1) + t
        levels[order].update(tuple(p[j : j + order]) for j in range(len(t)))
    for m in range(order - 1, 0, -1):
        levels[m] = Counter(g[1:] for g in levels[m + 1])
    d = {m: language_model.discounts(np.array([sum(n == k for n in levels[m].values()) for k in (1, 2, 3, 4)])) for m in levels}
    state = {m: defaultdict(lambda: [0, 0.0]) for m in levels}
    for m in levels:
        for g, n in levels[m].items():
            state[m][g[:-1]][0] += n
            state[m][g[:-1]][1] += d[m][min(n, 3)]
    out = []
    for i, t in docs:
        p, logs = ["<s>"] * (order - 1) + t, 0.0
        for j in range(len(t)):
            pr = 1 / (v + 1)
            for m in range(1, order + 1):
                g = tuple(p[j + order - m : j + order])
                if g[:-1] in state[m]:
                    n, back = state[m][g[:-1]]
                    pr = max(levels[m][g] - d[m][min(levels[m][g], 3)], 0) / n + back / n * pr
            logs += math.log10(pr)
        out.append((i, out_of(i), len(t), sum(w in c for w in t), total, sum(math.log10((c[w] + 0.1) / (total + 0.1 * (v + 1))) for w in t), logs))
    return out


@pytest.mark.parametrize("order", [2, 3])
def test_language_model(spark, edge, order):
    d = documents(spark)
    for docs, rows in ((table(spark, SF, "documents"), list(zip(d.doc_id, d.text))), (edge, EDGE)):
        q = language_model.split(docs)
        got = language_model.score(q, language_model.train(q.where("NOT held_out").select("data"), order)).toPandas()
        key = lambda r: (-1 if r[0] is None or r[0] != r[0] else r[0], r[2])
        got = sorted(([None if pd.isna(x) else x for x in r] for r in got.itertuples(index=False)), key=key)
        want = sorted(plain_model(rows, order), key=key)
        assert [tuple(r[:5]) for r in got] == [r[:5] for r in want]
        assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


def test_language_model_is_a_distribution(spark):
    docs = make(spark, [(i, "the cat sat on the mat the cat ran " + "dog " * i) for i in range(1, 12)])
    q = language_model.split(docs)
    model = language_model.train(q.where("NOT held_out").select("data"))
    words = [b"the", b"cat", b"sat", b"on", b"mat", b"ran", b"dog", language_model.END, b"unseen"]
    for before in (b"the", b"dog", b"unseen", None):
        total = 0.0
        for w in words:
            h = [xxhash.xxh64_intdigest(x) for x in ([before] if before else []) + [w]]
            logs, _ = language_model.token_log10(model, np.array(h, np.uint64), np.array([len(h)]))
            total += 10 ** logs[-1]
        assert np.isclose(total, 1)


def test_language_model_edges(spark, empty):
    q = language_model.split(empty)
    model = language_model.train(q.select("data"))
    assert model.tokens == 0 and language_model.score(q, model).count() == 0
    only = language_model.split(make(spark, [(1, "a b")]))
    assert [r.score for r in language_model.score(only, model).collect()] == [0.0]


def test_language_model_beats_the_base(spark):
    out = language_model.op6_language_model(spark, SF.replace("0.001", "0.01")).where("held_out").toPandas()
    assert out.score.sum() > 0.9 * out.base_score.sum() and (out.perplexity > 1).all()


# nearest neighbours


def plain_nearest(rows, k, every):
    ok = {(i, tuple(float(x) for x in v)) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = set()
    for i, q in {(i, v) for i, v in ok if i % every == 0}:
        cand = [(-sum_of(q, v), j) for j, v in ok if j != i and len(v) == len(q)]
        out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(cand)[:k])}
    return out


def sum_of(a, b):
    s = 0.0
    for x, y in zip(a, b):
        s += x * y
    return s


@pytest.mark.parametrize("seed,shard_rows", [(0, 4096), (1, 40), (2, 300)])
def test_nearest_is_exact(spark, seed, shard_rows):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(size=6).astype(np.float32).tolist()) for i in range(500)]
    rows += [(600 + i, rows[3][1]) for i in range(150)] + [(i, [float(x) for x in rng.integers(-1, 2, 6)]) for i in range(800, 1000)] + [rows[20]] * 3
    rows += [(2000, None), (2020, [0.0] * 6), (2040, [float("nan")] + [1.0] * 5), (2060, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2080, [1.0, 2.0]), (2081, [3.0, 1.0]), (None, [1.0] * 6), (2100, []), (2120, [float("inf")] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).withColumn("dim", F.lit(1))
    got = {tuple(r) for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, 20, shard_rows=shard_rows).collect()}
    assert got == plain_nearest(rows, 20, 20)
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_query_ids_of_several_vectors_search_with_each(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)] + [(i, rng.normal(size=6).tolist()) for i in (0, 0, 20, 40, 41)] + [(60, [1.0, 2.0]), (61, [3.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, 20, shard_rows=40).collect()]
    want = set()
    for i in {i for i, _ in rows if i % 20 == 0}:  # the best of all the id's vectors, as in SQL
        best = sorted((-sum_of(q, v), j) for x, q in rows if x == i for j, v in rows if j != i and len(v) == len(q))[:20]
        want |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    assert len(got) == len(want) and set(got) == want


def test_relaxed_search_trades_recall():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 8))
    tree = neighbours.build(np.arange(3000), x, float((x * x).sum(1).max()))
    exact, _ = neighbours.search(tree, np.arange(50), x[:50])
    recall = [np.mean([len(set(a) & set(b)) / 20 for a, b in zip(exact, neighbours.search(tree, np.arange(50), x[:50], relax=r)[0])]) for r in (1.0, 1.3, 4.0)]
    assert recall[0] == 1 and recall[0] >= recall[1] >= recall[2] and recall[1] > 0.8
