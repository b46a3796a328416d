"""Source divergence against plain Python integers and against DuckDB."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF

from corvid.llm import divergence, queries
from corvid.plans.verify import duck_connect

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=30, top=50):
    """rows: (lang, source, text)"""
    df, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, text = lang or "", source or "", text or ""
        words = [t.translate(LOWER) for t in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        groups[lang].add(source)
        df[lang].update(set(words))
        held[lang, source].update(words)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        v = len(kept)
        p, count = {}, {}
        for source in [*sources, None]:
            count[source] = {t: held[lang, source][t] if source is not None else sum(held[lang, s][t] for s in sources)
                             for t in kept}
            n = sum(count[source].values())
            p[source] = {t: 1 + 10**9 * (c + 5) // (n + 5 * v) for t, c in count[source].items()}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources - {s}]
            told = [(p[None][t] - p[s][t], t) for t in kept if count[s][t] and p[s][t] > p[None][t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(told)[:top])):
                out += [(lang, s, part, item, -value, i) for i, (value, item) in enumerate(found, 1)]
    return sorted(out)


def run(docs, **kw):
    return sorted(map(tuple, divergence.audit(docs, **kw).collect()))


def test_query(spark, documents):
    got = queries.QUERIES["op13_source_divergence"](spark, SF)
    assert got.dtypes[-2:] == [("value", "bigint"), ("rank", "int")]
    got = sorted(map(tuple, got.collect()))
    assert got == brute([(r.lang, r.source, r.text) for r in documents.collect()])
    assert got == sorted(duck_connect(SF).execute(queries.ORACLES["op13_source_divergence"]).fetchall())


@pytest.mark.parametrize("held,cells,portion", [(400_000, 1 << 20, 4_000_000), (50, 8, 1500), (5000, 64, 3000)])
def test_spills_and_portions(documents, monkeypatch, held, cells, portion):
    monkeypatch.setattr(divergence, "HELD", held)
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "PORTION", portion)
    docs = documents.repartition(5)
    assert run(docs, min_docs=3) == brute([(r.lang, r.source, r.text) for r in docs.collect()], min_docs=3)


def test_odd_rows(spark):
    long_text = "Stone é漢 _x" * 20_000
    rows = [("en", "a", long_text), ("en", "b", "stone Stone\x00water é漢"), ("en", None, "water water fire"),
            ("en", "", "fire stone"), (None, "a", "alone"), ("", "b", None), ("de", "a", ""), ("de", "b", None),
            ("fr", "only", "un deux un"), ("fr", "only", "un deux un"), (None, None, None),
            *[("es", f"s{i}", " ".join(f"w{chr(97 + j)}" for j in range(i % 7))) for i in range(40)]]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, value long, term string")
    assert run(docs, min_docs=2) == brute(rows, min_docs=2)
    assert run(docs.limit(0)) == []


def test_shares_are_exact():
    counts = np.array([5, 7, 123_456_789_012, 999_999_999_999, 1_000_000_000_007], dtype=np.int64)
    total = np.array(1_000_000_000_007, dtype=np.int64)
    assert divergence.shares(counts, total).tolist() == [1 + 10**9 * int(c) // int(total) for c in counts]


@pytest.mark.parametrize("rows", [1, 2, 5, 1000])
def test_merge_goes_on_over_batches(rows):
    """A key's stripes over many batches, in one batch, and at the borders; rare terms end there."""
    texts = [("en", f"s{i % 3}", "often often " + "now " * (i % 2) + f"rare{chr(97 + i % 26)}") for i in range(60)]
    texts += [("de", "s0", "often nie"), ("de", "s1", "often")]
    stripes = []
    for i in range(0, len(texts), 4):
        held = divergence.Stripes()
        for lang, source, text in texts[i: i + 4]:
            held.add(lang, source, divergence.terms(text))
        stripes += [r for batch in held.rows() for r in batch.to_pylist()]
    stripes.sort(key=lambda r: (r["lang"], r["term"]))
    schema = pa.schema([("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()),
                        ("counts", pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())])))])
    batches = [pa.RecordBatch.from_pylist(stripes[i: i + rows], schema) for i in range(0, len(stripes), rows)]
    got = [r for b in divergence._merged(iter(batches), 2) for r in b.to_pylist()]
    want = {}
    for lang, source, text in texts:
        for term, n in Counter(text.lower().split()).items():
            df, counts = want.setdefault((lang, term), (set(), Counter()))
            df.add((lang, source, text, len(df)))
            counts[source] += n
    want = {k: (len(df), dict(c)) for k, (df, c) in want.items() if len(df) >= 2}
    assert {(r["lang"], r["term"]): (r["df"], {c["source"]: c["n"] for c in r["counts"]}) for r in got} == want
    assert len(got) == len(want)
