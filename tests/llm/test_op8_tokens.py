import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.llm.op8_tokens import LONG_BLANK, TOKENIZER, attribute, encoding, lines, op8, token_ids


def brute(text, spans, rule):
    """Tokens of each section by decoding every token alone and asking each of its characters."""
    encoder = encoding(TOKENIZER)[0]
    data, owner = (text or "").encode(), []
    for i, c in enumerate(text or ""):
        owner += [i] * len(c.encode())
    own, at = [0.0] * len(spans), 0
    for t in encoder.encode_ordinary(text or ""):
        n = len(encoder.decode_single_token_bytes(t))
        chars = owner[at:at + n]
        at += n
        where = next((i for i, (a, b) in enumerate(spans) if a <= chars[0 if rule == "start" else -1] < b), None)
        if where is not None:
            own[where] += 1
    assert at == len(data)
    return own


def test_small_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {}
    for r in op8(spark, small).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.start, r.end, r.tokens))
    encoder = encoding(TOKENIZER)[0]
    for d, text in texts.items():
        rows = sorted(got[d])
        assert [x[1:3] for x in rows] == [tuple(x) for x in np.stack(lines(text), 1).tolist()]
        assert sum(x[3] for x in rows) == len(encoder.encode_ordinary(text))
    for d in list(texts)[:25]:
        spans = [x[1:3] for x in sorted(got[d])]
        assert [x[3] for x in sorted(got[d])] == brute(texts[d], spans, "start")


def test_rules_and_edges(spark):
    rows = [(1, "one two three\nfour\n\nfive é😀ü <|endoftext|>"), (2, None), (3, ""), (4, "\n"), (5, "日本語テキスト 😀😀"), (5, "日本語テキスト 😀😀")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as tokens", "2 as sections")
    got = [(r.doc_id, r.section, r.tokens) for r in attribute(docs).collect()]
    assert [x for x in got if x[0] in (2, 3)] == [(2, 0, 0.0), (3, 0, 0.0)]
    assert sum(d == 5 for d, _, _ in got) == 2
    cut = F.expr("array(named_struct('start', 0, 'end', 2), named_struct('start', 2, 'end', 6), named_struct('start', 6, 'end', 7))")
    one = docs.where("doc_id = 1")
    tokens = {rule: [r.tokens for r in sorted(attribute(one, cut, rule).collect(), key=lambda r: r.section)] for rule in ("start", "end", "majority", "split")}
    for rule in ("start", "end"):
        assert tokens[rule] == brute(rows[0][1], [(0, 2), (2, 6), (6, 7)], rule)
    assert abs(sum(tokens["split"]) - 2) < 1e-9 and sum(tokens["majority"]) == 2
    assert attribute(docs.where("false")).count() == 0


@pytest.mark.parametrize("blank", [" ", "\n", "\t ", "\u3000 ", " \xa0\n"])
def test_long_blank_runs(blank):
    """As the whole text through the pattern, where that is still able to read it."""
    encoder = encoding(TOKENIZER)[0]
    run = blank * 5000
    for text in (run, "a" + run, run + "b", f"a b{run}c {run}'s{run}1", f"{run} x{run}\u0301", "x" + run[:999] + "y" + run[:1000] + "z", f"a{run}\x1c{run}!"):
        assert token_ids(text, TOKENIZER).tolist() == encoder.encode_ordinary(text)


def test_a_million_blanks_and_more(spark):
    rows = [(1, "one " + " " * 1_000_000 + "two"), (2, "one\n" + "\n" * 10_000_000 + "two"), (3, " " * 10_000_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = F.expr("array(named_struct('start', 0, 'end', char_length(text)))")
    got = {r.doc_id: r.tokens for r in attribute(docs, whole).collect()}
    for d, text in rows:
        ids = token_ids(text, TOKENIZER)
        assert got[d] == len(ids) and encoding(TOKENIZER)[0].decode(ids.tolist()) == text


def test_blanks_are_those_of_the_pattern():
    """Every character that the pattern counts as white space, and no other, may be part of a long run."""
    encoder = encoding(TOKENIZER)[0]
    for c in [chr(i) for i in (*range(0x3100), 0xfeff) if chr(i).isspace() or LONG_BLANK.fullmatch(chr(i) * 1000) or i in (0x200b, 0x180e, 0xfeff)]:
        together = encoder.encode_ordinary(f"x{c * 1001}y")
        assert token_ids(f"x{c * 1001}y", TOKENIZER).tolist() == together
