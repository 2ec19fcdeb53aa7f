import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.llm import tokens as T

PATH = T.vocabulary_path()
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary here")


@pytest.fixture(scope="module")
def reference():
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=T.read_ranks(PATH), special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet="ab cé’ \n1<|endoftext|>ß🤦", max_size=80)))
def test_equal_to_the_reference(s):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = T.read_ranks(PATH)
    s = s.encode("utf-8", "replace").decode()
    want = tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(s)
    assert T.Encoder(ranks)(s) == want


def test_long_parts_and_round_trip(reference):
    e = T.Encoder(T.read_ranks(PATH))
    back = {i: b for b, i in T.read_ranks(PATH).items()}
    for s in ("a" * 30_000, "ab" * 9_000 + "ü" * 3_000, " " * 5_000, "x\n" * 4_000):
        ids = e(s)
        assert ids == reference.encode_ordinary(s)
        assert b"".join(back[i] for i in ids).decode() == s


def test_rows(spark):
    df = spark.createDataFrame([(1, "Hello <|endoftext|>", "a"), (2, None, "b"), (3, "", "c")], "doc_id long, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in T.encoded(df, PATH).collect()}
    assert got[2] == [] and got[3] == [] and 50256 not in got[1] and len(got[1]) > 3
    assert T.encoded(df.limit(0), PATH).collect() == []
