"""Mixing: targets and apportionment against brute force, whole taken words, reruns."""

import re
from fractions import Fraction

import pytest

from corvid.llm import mixing

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """sizes: {source: words} in order; exact water filling."""
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sizes)}
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_weight = sum(weights[s] for s in sizes if s not in full)
        target = {s: Fraction(3 * sizes[s]) if s in full else Fraction(weights[s] * rest, open_weight) for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def ordered(rows):
    sizes = {}
    for source in sorted({r[0] for r in rows}, key=lambda s: (s is None, s or "")):
        sizes[source] = sum(n for s, n in rows if s == source)
    return sizes


def test_targets_and_taken(documents):
    got = mixing.mix_report(documents).collect()
    rows = {r.doc_id: r for r in documents.collect()}
    sizes = ordered([(rows[r.doc_id].source, len(WORD.findall(rows[r.doc_id].text))) for r in got])
    target = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        source = rows[r.doc_id].source
        assert r["size"] == len(WORD.findall(rows[r.doc_id].text)) and r.source_size == sizes[source]
        assert r.target == pytest.approx(float(target[source]))
        assert 0 <= r.taken <= 3 * r["size"]
        taken[source] += r.taken
    for source, want in target.items():
        assert abs(taken[source] - want) <= 1.5 * mixing.BLOCK_WORDS


def test_many_shards_come_near_and_reruns_agree(documents):
    kw = {"shard_words": 2000, "block_words": 64}
    a = {(r.doc_id, r.taken) for r in mixing.mix_report(documents, **kw).collect()}
    got = mixing.mix_report(documents.repartition(5), **kw).toPandas()
    assert a == set(zip(got.doc_id, got.taken))
    per = got.groupby("source_size").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((per.taken - per.target).abs() <= 0.06 * per.target + 64).all()


def test_quotas_are_highest_quotients(spark):
    votes = [3.2, 0.4, 7.7, 12.1, 0.05, 5.0, 5.0]
    cells = spark.createDataFrame([(i, 0, v, 100) for i, v in enumerate(votes)],
                                  "rank int, shard long, votes double, blocks long")
    got = {r["rank"]: r.quota for r in mixing._quotas(cells, 3, 1).collect()}
    quotients = sorted(((v / (2 * k + 1), i) for i, v in enumerate(votes) for k in range(50)), reverse=True)
    want = dict.fromkeys(range(len(votes)), 0)
    for _, i in quotients[:round(sum(votes))]:
        want[i] += 1
    assert got == want


def test_mix_gives_the_taken_words(documents):
    taken = {r.doc_id: r.taken for r in mixing.mix_report(documents).collect()}
    rows = {r.doc_id: r.text for r in documents.collect()}
    words = dict.fromkeys(taken, 0)
    out = mixing.mix(documents)
    assert out.columns == documents.columns
    for r in out.collect():
        found = WORD.findall(r.text)
        assert set(found) <= set(WORD.findall(rows[r.doc_id]))
        words[r.doc_id] += len(found)
    assert words == taken


def test_odd_rows(odd, empty):
    got = mixing.mix_report(odd).collect()
    assert len(got) == 12
    assert [(r["size"], r.taken) for r in got if r.doc_id in (3, 4, 5)] == [(0, 0)] * 3
    rows = [(r.source, len(WORD.findall(r.text or ""))) for r in odd.collect()]
    target = {float(t) for t in brute_targets(ordered(rows)).values()}
    assert {round(r.target, 6) for r in got} == {round(t, 6) for t in target}
    assert mixing.mix(odd).columns == odd.columns and mixing.mix(odd).count() > 0
    assert mixing.mix_report(empty).count() == 0 and mixing.mix(empty).count() == 0
    assert mixing.mix(odd.where("text IS NULL")).count() == 0


def test_no_python_in_the_plan(documents):
    plan = mixing.mix(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_copies_of_a_row_are_dealt_apart(spark):
    """One row 20,000 times, beside others: its copies spread evenly, and reruns agree."""
    text = "ten words that are all the same in every copy"
    rows = [(1, text, "a")] * 20_000 + [(i, f"w{i} " * 10, "b") for i in range(2, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    kw = {"shard_words": 5000, "block_words": 50}
    held = mixing.materialise(mixing._rows(docs, "doc_id", "text", "source", mixing.F.monotonically_increasing_id(), 31), "t")
    full, _ = mixing._plan(held, mixing.WEIGHTS, 3, 50, 5000, 31)
    per_shard = [r["count"] for r in full.where("source = 'a'").groupBy("shard").count().collect()]
    assert len(per_shard) == 40 and max(per_shard) < 1.5 * 20_000 / 40
    a, b = (sorted((r.doc_id, r.taken) for r in mixing.mix_report(d, **kw).collect()) for d in (docs, docs.repartition(3)))
    assert a == b


def test_many_sources(spark):
    """A source for each document: ranks and targets by spread scans, equal to water filling."""
    rows = [(i, "w " * (i % 50 + 1), f"s{i:04d}" if i else None) for i in range(600)]
    got = mixing.mix_report(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    target = brute_targets(ordered([(r[2], r[0] % 50 + 1) for r in rows]))
    assert all(r.target == pytest.approx(float(target[rows[r.doc_id][2]])) for r in got) and len(got) == 600
