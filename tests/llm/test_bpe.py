"""Byte-level BPE against the tiktoken library; exact round trips."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from corvid.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(open(PATH, "rb").read(), PATTERN)


def test_documents(spark, documents, library):
    got = bpe.round_trip(documents.select("doc_id", "text"), PATH, PATTERN, with_ids=True).collect()
    for r in got:
        want = library.encode_ordinary(r.text)
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60), max_size=5))
def test_any_text(codec, library, texts):
    ids = [[int(x) for x in joined.split(",")] if joined else [] for joined in codec.encode(texts)]
    assert ids == [library.encode_ordinary(t) for t in texts]
    assert codec.decode([bpe._id_array(",".join(map(str, i))) for i in ids]) == [t.encode() for t in texts]


def test_long_pieces(codec, library):
    texts = ["=" * 3000, "ab" * 2000, "0123456789" * 300, "\n" * 500 + "x", "<|endoftext|>", "it's   we'll  　 x\x1cy\x85z"]
    assert codec.encode(texts) == [",".join(map(str, library.encode_ordinary(t))) for t in texts]


@pytest.mark.parametrize("kind", ["letters", "signs", "spaces", "words", "one"])
def test_pieces_of_200_000_bytes(codec, library, kind):
    draw = random.Random(7)
    text = {"letters": "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=200_000)),
            "signs": "".join(draw.choices("=-*/.,;:!?", k=200_000)), "spaces": " " * 200_000 + "x",
            "words": "".join(draw.choices(["the", "inter", "nation", "al", "ing", "über", "ß"], k=50_000))[:200_000],
            "one": "=" * 200_000}[kind]
    # the library's split has a limit of its own on runs of white space
    pieces = codec.split(text)
    want = [i for p in pieces for i in library._encode_single_piece(p)]
    assert max(map(len, pieces)) > 150_000
    assert codec.encode([text]) == [",".join(map(str, want))]


def test_long_pieces_of_odd_merges(library):
    """Small vocabularies of drawn tokens, whose pairs can have lower ranks than their tokens."""
    draw = random.Random(3)
    for _ in range(60):
        tokens = {bytes([i]): i for i in range(256)}
        drawn = list({bytes(draw.choices(b"abc", k=draw.randint(2, 5))) for _ in range(40)})
        draw.shuffle(drawn)
        tokens |= {t: 256 + i for i, t in enumerate(drawn)}
        small = "\n".join(f"{base64.b64encode(t).decode()} {r}" for t, r in tokens.items()).encode()
        own, other = bpe.Codec(small, PATTERN), tiktoken.Encoding("odd", pat_str=PATTERN, mergeable_ranks=tokens,
                                                                  special_tokens={})
        texts = ["".join(draw.choices("abc", k=k)) for k in (49, 50, 70, 90)]
        assert own.encode(texts) == [",".join(map(str, other.encode_ordinary(t))) for t in texts]


def test_odd_rows_and_decode(spark, odd, empty):
    out = bpe.encode(odd, PATH, PATTERN)
    back = bpe.decode(out, PATH, PATTERN)
    assert back.columns == odd.columns + ["ids", "decoded"]
    for r in back.collect():
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.round_trip(empty, PATH, PATTERN).count() == 0
    none = spark.createDataFrame([(None,)], "ids array<long>")
    assert bytes(bpe.decode(none, PATH, PATTERN).first().decoded) == b""
    with pytest.raises(Exception, match="no token"):
        bpe.decode(spark.createDataFrame([([99_999_999],)], "ids array<long>"), PATH, PATTERN).collect()
