"""Importance resampling: held-out accuracy, exact top-k, odd and empty tables."""

import numpy as np

from conftest import SF
from pyspark.sql import functions as F

from corvid.llm import importance, queries
from corvid.llm.common import kth_largest
from corvid.llm.tokens import tokenise, windows


def test_top_k_is_exact(spark):
    values = [5, 5, -3, 10**15, 0, 7, 7, 7, -10**12]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k in range(1, len(values) + 1):
        assert kth_largest(df, "v", k, bins=4) == sorted(values, reverse=True)[k - 1]
    assert kth_largest(df, "v", 10) is None
    assert kth_largest(df.limit(0), "v", 1) is None


def test_token_hash_depends_on_bytes_alone():
    a = tokenise(["one two", "two one\nthree", "", "x" * 1_200_000 + " two"])
    assert a.counts.tolist() == [2, 3, 0, 2]
    assert a.hash[0] == a.hash[3] and a.hash[1] == a.hash[2] == a.hash[6]
    assert len(set(a.hash.tolist())) == 4
    assert len(windows(a.hash[:2], 5)) == 0


def test_held_out_accuracy(documents, labels):
    got = importance.resample(documents, labels).select("doc_id", "kept").toPandas()
    both = got.merge(labels.toPandas(), on="doc_id")
    good, bad = both[both.quality == 1], both[both.quality == 0]
    assert good.kept.mean() > 0.97 and bad.kept.mean() < 0.2


def test_share_takes_exactly_k_and_reruns_agree(documents, labels):
    a = importance.resample(documents, labels, share=0.25).select("doc_id", "kept").toPandas()
    b = importance.resample(documents.repartition(5), labels, share=0.25).select("doc_id", "kept").toPandas()
    assert a.kept.sum() == 50
    assert set(a[a.kept].doc_id) == set(b[b.kept].doc_id)


def test_raw_model_counts_all_documents(documents):
    counts = importance.ngram_counts(documents).toPandas()
    want = np.zeros(importance.BUCKETS, dtype=int)
    for text in documents.toPandas()["text"]:
        np.add.at(want, importance.ngram_buckets([text])[0], 1)
    assert counts.n.sum() == want.sum() and (want[counts.bucket] == counts.n).all()


def test_odd_rows(odd, empty, labels):
    out = importance.resample(odd, labels)
    assert out.columns == odd.columns + ["log_weight", "gumbel_key", "_kept"]
    got = out.toPandas()
    assert len(got) == 12 and got["_kept"].notna().all()
    assert (got[got.text.isna() | (got.text == "")].log_weight == 0).all()
    assert importance.resample(empty, labels).count() == 0
    assert importance.resample(odd, labels.limit(0)).where("_kept").count() == 12


def test_kth_largest_of_the_whole_range(spark):
    values = [-(1 << 63), (1 << 63) - 1, 0, -1, 1, 1 << 62, -(1 << 62), 12345]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k in range(1, len(values) + 1):
        assert kth_largest(df, "v", k, bins=16) == sorted(values, reverse=True)[k - 1]


def test_copies_of_a_labelled_row_weigh_nothing(documents, labels):
    """The cut and the verdict of the labelled rows stay when one of them is there a thousand times."""
    some = labels.where("quality = 0").limit(1)
    again = documents.join(some.select("doc_id"), "doc_id").select(documents.columns)
    more = documents
    for _ in range(5):
        again = again.unionByName(again)
    more = documents.unionByName(again)
    sample = importance.labelled_sample(labels)
    held = more.join(sample, more.doc_id == sample._label_id)
    assert held.count() > sample.join(documents, documents.doc_id == sample._label_id).count()
    a = importance.resample(documents, labels).select("doc_id", "kept").toPandas().drop_duplicates()
    b = importance.resample(more, labels).select("doc_id", "kept").toPandas().drop_duplicates()
    assert len(a) == len(b) and (a.set_index("doc_id").kept == b.set_index("doc_id").kept).mean() > 0.97


def brute(spark, rows, labels):
    """(log weight, key, kept) of every row (id, text), worked out text by text; labels: (id, quality)."""
    quality = {}
    for i, q in labels:
        if i is not None and q is not None:
            quality[i] = min(quality.get(i, 1), q)
    places = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n long, id long, text string")
    drawn = places.select("n", importance.gumbel(places.id).alias("g"), F.xxhash64(F.lit(5), "id").alias("d"),
                          F.xxhash64("text").alias("h"))
    drawn = {r.n: r for r in drawn.collect()}
    buckets = [importance.ngram_buckets([text or ""])[0] for _, text in rows]
    one = {}  # the row that stands for a labelled id
    for n, (i, text) in enumerate(rows):
        if i in quality:
            one[i] = min(one.get(i, (drawn[n].h, text or "", n)), (drawn[n].h, text or "", n))
    raw, target = np.zeros(importance.BUCKETS), np.zeros(importance.BUCKETS)
    for b in buckets:
        np.add.at(raw, b, 1)
    for i, (_, _, n) in one.items():
        if quality[i] and drawn[n].d % 2 == 0:
            np.add.at(target, buckets[n], 1)
    if not target.sum():
        return [(0.0, drawn[n].g, True) for n in range(len(rows))]
    ratio = np.log((target + 32) / (raw * target.sum() / raw.sum() + 32))
    weight = [ratio[b].sum() for b in buckets]
    key = [w + drawn[n].g for n, w in enumerate(weight)]
    held = sorted((key[n], bool(quality[i])) for i, (_, _, n) in one.items() if drawn[n].d % 2)
    cut = -np.inf
    if held and len({g for _, g in held}) == 2:
        costs = [(sum(2 if g else 0 for _, g in held[:n]) + sum(not g for _, g in held[n:]), n) for n in range(len(held) + 1)]
        n = min(costs)[1]
        cut = -np.inf if n == 0 else (held[n - 1][0] + held[min(n, len(held) - 1)][0]) / 2
    return [(weight[n], key[n], bool(key[n] >= cut)) for n in range(len(rows))]


def test_query_against_brute_force(spark, documents, labels):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = {i: w for (i, _), w in zip(rows, brute(spark, rows, [(r.doc_id, r.quality) for r in labels.collect()]))}
    got = queries.QUERIES["op1_importance"](spark, SF).collect()
    assert len(got) == len(want)
    for r in got:
        weight, key, kept = want[r.doc_id]
        assert abs(r.log_weight - weight) < 1e-6 and abs(r.gumbel_key - key) < 1e-6 and r.kept == kept
