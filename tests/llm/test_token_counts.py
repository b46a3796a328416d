"""Token counts against the library on whole texts."""

import public_tokenizers
import pytest
import sentencepiece
from conftest import SF

from corvid.llm import queries, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_query(spark, documents, library):
    got = queries.QUERIES["op12_token_counts"](spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = sorted((r.doc_id, len((r.text or "").encode()), n := len(library.encode(r.text or "")), n > 4096)
                  for r in documents.collect())
    assert sorted(map(tuple, got.collect())) == want


TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b   c", "\n", "a\n b\n\n c ", "tab\tand\r\nline", "▁a▁▁b", "a ▁ b",
         "<s>x</s><unk><0x0A>", "\x00a\x01 b", "漢字 かな 한국어", "\U0001f600\U0001f600 é é", "don't. (yes) -- 3.14159,26",
         "naïve café ÀÉÎ", "​   x", "word" * 50_000, " " * 100_000, "漢" * 50_000, "x y\n" * 50_000]


@pytest.mark.parametrize("hot", [1, 400_000])
def test_any_text(spark, library, monkeypatch, hot):
    """Whether pre-tokens are broadcast or joined."""
    monkeypatch.setattr(token_counts, "HOT", hot)
    rows = [(i % 9, t, -1, "r") for i, t in enumerate(TEXTS)] + [(None, None, None, None), (1, "a  b", -1, "r"), (1, "a  b", -1, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, row string").repartition(3)
    got = token_counts.count_tokens(docs, PATH, max_tokens=10)
    assert got.columns == ["doc_id", "text", "n_tokens", "row", "n_bytes", "_n_tokens", "over_limit"]
    want = [(*r, len((r[1] or "").encode()), n := len(library.encode(r[1] or "")), n > 10) for r in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_cuts_add_up(library):
    model = token_counts.PreTokens(open(PATH, "rb").read())
    for text in TEXTS[:-4]:
        pieces = model.split(text)
        assert "".join(pieces) == (" " + text.replace("▁", " ") if text else "")
        assert sum(model.count(pieces)) == len(library.encode(text))


def test_spills(spark, documents, library, monkeypatch):
    monkeypatch.setattr(token_counts, "HELD_CHARS", 5_000)
    got = token_counts.count_tokens(documents.select("doc_id", "text"), PATH)
    assert all(r.n_tokens == len(library.encode(r.text or "")) for r in got.collect())


def test_empty(empty):
    got = token_counts.count_tokens(empty, PATH, keep_text=False)
    assert got.columns == ["doc_id", "source", "kept", "node", "n_bytes", "n_tokens", "over_limit"] and got.collect() == []
