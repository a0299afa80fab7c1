import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from zonalis.llm.byte_bpe import ByteBpe, encode_texts, load_ranks

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = load_ranks(PATH)
OURS = ByteBpe(RANKS, P.PATTERN)
THEIRS = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(text):
    return np.frombuffer(OURS.encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=200), st.text("ab \n\x1c\x85'sÉ9²½漢", max_size=200),
                 st.text("aeinorst", min_size=20, max_size=400)))
def test_equals_the_library(text):
    assert ids(text) == THEIRS.encode_ordinary(text)
    assert OURS.decode(ids(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 30001, "\n" * 7001, " " * 5000 + "x", "ab" * 9000 + "!" * 8000,
                                  "the" * 7000, "=-" * 3000, "é" * 4001, "漢字" * 3000])
def test_long_pieces(text):
    assert ids(text) == THEIRS.encode_ordinary(text)
    assert OURS.decode(ids(text)) == text.encode()


def test_seams_equal_one_pass():
    rng = np.random.default_rng(5)
    for n in (17, 33, 65, 200, 1000):
        for letters in (b"ab", b"etaoin", bytes(range(256))):
            piece = bytes(rng.choice(list(letters), n).astype(np.uint8))
            assert OURS._tree(piece) == OURS._merge_long(piece)


def test_rows(spark):
    texts = [(1, "One two.", "x"), (None, None, "x"), (3, "", None), (3, "", None), (4, "a b" * 50000, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string, ids string")
    got = sorted((r.doc_id or 0, bytes(r.ids), bytes(r.decoded)) for r in encode_texts(df, PATH, P.PATTERN).collect())
    want = sorted((d or 0, np.array(THEIRS.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode())
                  for d, t, _ in texts)
    assert got == want
    assert encode_texts(df.limit(0), PATH, P.PATTERN).count() == 0


def test_query(spark):
    from zonalis.llm.queries import op10_byte_bpe
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in op10_byte_bpe(spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        want = THEIRS.encode_ordinary(r.text or "")
        assert got[r.doc_id] == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest(),
                                 hashlib.sha256((r.text or "").encode()).hexdigest())
