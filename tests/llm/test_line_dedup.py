"""Line deduplication against brute force, with several batches and compactions."""

import hashlib

import pytest

from corvid.llm import line_dedup, queries

SPACE = "\t\n\x0b\x0c\r "
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(SPACE).translate(LOWER)


def brute(rows, min_chars=10):
    """rows: (id, text); null ids come last."""
    last = 1 << 63
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(last if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        keep = [ln for ln in lines if len(key(ln)) < min_chars or min(holders[key(ln)]) == (last if i is None else i)]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches,fanout", [(1, 3), (4, 3), (7, 2)])
def test_matches_brute_force(documents, batches, fanout):
    got = line_dedup.dedup_lines(documents, batches=batches, fanout=fanout)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()), key=str) == brute(rows)


def test_odd_rows(odd, empty):
    got = line_dedup.dedup_lines(odd)
    assert got.columns == odd.columns + ["n_lines", "n_dropped"]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()), key=str) == brute(rows)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_one_line_in_most_documents(spark):
    rows = [(i, f"the very common line\n{i}") for i in range(3000)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert got.where("n_dropped = 0").select("doc_id").collect()[0][0] == 0
    assert got.where("n_dropped = 1").count() == 2999


def test_query_digest(spark, documents):
    got = {r.doc_id: r for r in queries.QUERIES["op2_line_dedup"](spark, "/root/testdata/sf0.001").collect()}
    for i, n, dropped, text in brute([(r.doc_id, r.text) for r in documents.collect()]):
        assert (got[i].n_lines, got[i].n_dropped) == (n, dropped)
        assert got[i].kept_sha256 == hashlib.sha256(text.encode()).hexdigest()
