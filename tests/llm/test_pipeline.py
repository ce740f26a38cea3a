"""The stages of the corpus pipeline on the smallest tables."""

import numpy as np
from conftest import SF

import corpus_pipeline
from tests.llm.test_operators import check_packing, plain_groups, plain_ids
from tidewarden.llm import classifier, mixing
from tidewarden.llm.common import materialise, table


def test_stages(spark):
    docs = table(spark, SF, "documents")
    seen = {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, before, SF), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        seen[name] = (before.toPandas(), out.toPandas())
        before = out

    a, b = seen["quality_classifier"]
    want = classifier.classify(docs, table(spark, SF, "labels"), folds=1 << 62).where("predicted = 1")
    labels = table(spark, SF, "labels").toPandas()
    good = set(labels.doc_id[labels.quality == 1])
    assert len(good & set(b.doc_id)) >= 0.97 * len(good & set(a.doc_id)) and want.count() > 0

    a, b = seen["simhash_near_dedup"]
    text, kept, gone = dict(zip(a.doc_id, a.text)), set(b.doc_id), set(a.doc_id) - set(b.doc_id)
    groups = plain_groups(list(zip(a.doc_id, a.text)))  # by brute force, at 0.8
    assert gone and kept == {min(int(a.doc_id.iloc[i]) for i in g) for g in groups}

    a, b = seen["suffix_dedup"]
    assert set(a.doc_id) == set(b.doc_id) and (b.n_chars == b.text.str.len()).all()
    texts, first = {i: t.encode() for i, t in zip(a.doc_id, a.text)}, {}
    for i in sorted(texts):
        for p in range(len(texts[i]) - 49):
            first.setdefault(texts[i][p : p + 50], i)
    for i, t in zip(b.doc_id, b.text):
        data = texts[i]
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < i:
                gone[p : p + 50] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(int)))
        for x, y in zip(edge[::2], edge[1::2]):  # a character that isn't covered as a whole stays
            while x < y and data[x] & 0xC0 == 0x80:
                gone[x], x = False, x + 1
            while x < y < len(data) and data[y] & 0xC0 == 0x80:
                gone[y - 1], y = False, y - 1
        assert t.encode() == bytes(c for c, g in zip(data, gone) if not g)

    a, b = seen["mixing"]
    words = lambda d: d.text.str.split().str.len()
    assert set(b.doc_id) <= set(a.doc_id) and b.groupby("doc_id").size().max() <= 3
    assert abs(words(b).sum() / words(a).sum() - 1) < 0.1
    targets = mixing.mix(spark.createDataFrame(a)).toPandas().groupby("source").target.first()
    got = words(b).groupby(b.source).sum()
    assert np.allclose(got.reindex(targets.index).fillna(0), targets, atol=words(a).max())

    a, b = seen["packing"]
    check_packing(b, [(i, x + [0]) for i, x in zip(a.doc_id, plain_ids(a.text))], 2048)


def test_run_is_the_chain_of_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and (out.groupBy("sequence_id").agg({"length": "sum"}).agg({"sum(length)": "max"}).first()[0]) <= 2048


def test_stages_on_hard_rows(spark, edge, empty, tmp_path):
    """Nulls, empty, blank and long texts, repeated rows, clashing names; and a table without rows."""
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (edge.select(*cols), empty.select(*cols)):
        docs.write.parquet(str(tmp_path / f"{docs.count()}/documents.parquet"))
        spark.createDataFrame([(i, int(i % 2), 0) for i in range(1, 15)] if docs.count() else [], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / f"{docs.count()}/labels.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path / str(docs.count())))
        assert out.count() >= 0 and {"doc_id", "piece", "sequence_id"} <= set(out.columns)
