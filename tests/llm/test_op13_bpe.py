import hashlib
from functools import lru_cache

import pytest
from hypothesis import given, settings, strategies as st

from lumenfold.llm.op13_bpe import Codec, decode, default_path, encode, op13

ODD = ["a", "e", "q", "x", "z", "'", "s", "t", "re", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "　", " ", " ", "é", "×", "ß", "日", "本",
       "😀", "!", "?", "1", "９", "²", "<|endoftext|>", "<|endof", "|>", "́", "\x00", "\x01", "’", "don't", "‍"]


@lru_cache(1)
def parts():
    from tokenizers import Tokenizer
    return Codec(open(default_path(), encoding="utf-8").read()), Tokenizer.from_file(default_path())


def same(text):
    own, library = parts()
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text.encode()).tolist() == ids
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=1500, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(ODD), max_size=40).map("".join), st.text(max_size=60)))
def test_any_text(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 50300), max_size=20))
def test_any_ids(ids):
    own, library = parts()
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["qx" * 100_000, "zq!" * 50_000, " " * 50_000 + "x", "ab" * 20_000, "日本" * 20_000, "\n" * 50_000, "x" * 50_000 + "'s"])
def test_long_runs(text):
    same(text)


def test_fragments_are_short_and_cover():
    own, _ = parts()
    text = "The quick brown fox doesn't jump over 13 lazy dogs; qxqxqxqx zqzq.\nNext line."
    at = own.bounds(text.encode(), __import__("numpy").frombuffer(text.encode(), "uint8"))
    assert at[0] == 0 and at[-1] == len(text) and len(at) > 20


def test_whole_small_table(spark, small):
    _, library = parts()
    want = {}
    for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in op13(spark, small).collect()} == want


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (None, "a<|endoftext|> b"), (3, "x"), (3, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as decoded_", "'k' as n_tokens")
    got = decode(encode(docs)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.decoded, r.n_tokens) for r in got] == [(None, "a<|endoftext|> b", "k"), (1, "", "k"), (2, "", "k"), (3, "x", "k"), (3, "x", "k")]
    assert got[0].ids == [64, 50256, 275]
    assert decode(encode(docs.where("false"))).count() == 0
    with pytest.raises(ValueError):
        encode(docs.selectExpr("*", "1 as IDS"))
    lost = decode(spark.createDataFrame([(None,), ([50300, 64, None],), ([],)], "ids array<int>"))
    assert sorted(r.decoded for r in lost.collect()) == ["", "", "a"]
