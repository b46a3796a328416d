"""Similarity join against all pairs, with groups that span many blocks."""

import random
from math import comb

from corvid.llm import jaccard


def shingle_set(text):
    words = (text or "").encode().split()
    n = min(5, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute(texts):
    sets = [shingle_set(t) for t in texts]
    links = [set() for _ in texts]
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 10 * len(a & b) >= 8 * len(a | b):
                links[i].add(j)
                links[j].add(i)
    comp = list(range(len(texts)))
    for i in range(len(texts)):
        todo = [i] if comp[i] == i else []
        while todo:
            for k in links[todo.pop()]:
                if comp[k] > i:
                    comp[k] = i
                    todo.append(k)
    return [(i, comp[i], len(links[i]), comp[i] == i) for i in range(len(texts))]


def check(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard.similarity_join(df, **kw).collect())
    assert got == brute(texts)


def test_documents(spark, documents):
    rows = {r.doc_id: r.text for r in documents.collect()}
    check(spark, [rows[i] for i in range(len(rows))])


def test_large_group_of_near_copies(spark):
    """Distinct near copies of one text, exact copies, and texts around the threshold."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(900):
        copy = list(words)
        for _ in range(rng.choice([0, 1, 1, 2, 4, 8])):
            copy[rng.randrange(150)] = f"x{rng.randrange(1000)}"
        texts.append(" ".join(copy))
    texts += [" ".join(words)] * 50 + [" ".join(words[:n]) for n in range(100, 150)] + ["a b", "a b", "b a", ""]
    check(spark, texts)


def test_blocks_and_pruning_lose_nothing():
    # the tail of a Beta(m + 1, n - m + 1) distribution is a head of a binomial one
    for n in (32, 64, 192):
        m = jaccard.fewest_matches(n, 0.8, 1e-6)
        tail = [sum(comb(n + 1, k) * 0.8 ** k * 0.2 ** (n + 1 - k) for k in range(j + 1)) for j in (m - 1, m)]
        assert tail[0] < 1e-6 <= tail[1]
    assert jaccard.fewest_matches(32, 0.8, 1e-6) <= jaccard.fewest_matches(64, 0.8, 1e-6)


def test_odd_rows(odd, empty):
    got = jaccard.similarity_join(odd).collect()
    assert len(got) == 12
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.n_links for r in by[3] + by[4] + by[5]] == [0, 0, 0]
    assert sorted(r.n_links for r in by[7]) == [0, 1, 1]
    assert by[None][0].kept and by[None][0].class_id is None
    one = jaccard.keep_one(odd)
    assert one.columns == odd.columns and one.count() == 11
    assert jaccard.similarity_join(empty).count() == 0 and jaccard.keep_one(empty).count() == 0


def test_keep_one_keeps_the_smallest_id_of_each_class(documents):
    kept = {r.doc_id for r in jaccard.keep_one(documents).select("doc_id").collect()}
    rows = {r.doc_id: r.text for r in documents.collect()}
    assert kept == {i for i, _, _, keep in brute([rows[i] for i in range(len(rows))]) if keep}
