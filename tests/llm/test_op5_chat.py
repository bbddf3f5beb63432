from lumenfold.llm.op5_chat import ORACLES, QUERIES, SEGMENT, rotate
from tools.oracle_check import compare, connect


def test_matches_sql(spark, small):
    ok, note = compare(spark, connect(small), "op5", QUERIES["op5_perspectives"], ORACLES["op5_perspectives"], small)
    assert ok, note


def check_masks(out):
    for r in out:
        runs = [tuple(map(int, x.split(":"))) for x in r.mask.split(",")]
        assert sum(n for _, n in runs) == len(r.rendered)
        assert sum(n for flag, n in runs if flag) == r.n_train


def test_edge_rows(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi é"), (1, 2, "bob", None), (1, 2, "bob", None), (1, 3, None, "who"), (1, None, "ann", "first"),
            (2, 0, "system", "alone"), (None, 0, "eve", "x"), (None, 1, "ann", "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as speaker", "2 as a", "3 as segment")
    out = rotate(turns).collect()
    check_masks(out)
    assert sorted({(r.conv_id, r.speaker) for r in out}, key=str) == sorted([(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann"), (None, "eve")], key=str)
    bob = sorted((r for r in out if r.speaker == "bob"), key=lambda r: r.segment)
    assert "".join(r.rendered for r in bob).startswith("<|user name=ann|>\nfirst\n<|system|>\nbe kind\n<|user name=ann|>\nhi é\n<|assistant|>\n\n")
    assert sum(r.n_turns for r in bob) == 6 and sum(r.n_train for r in bob) == 2
    assert rotate(turns.where("false")).count() == 0


def test_long_conversation_is_cut(spark):
    rows = [(1, i, "ab"[i % 2], f"t{i}") for i in range(3 * SEGMENT)] + [(1, 5, "a", f"again {i}") for i in range(6 * SEGMENT)]
    out = rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    check_masks(out)
    for speaker in "ab":
        own = sorted((r for r in out if r.speaker == speaker), key=lambda r: r.segment)
        assert [r.segment for r in own] == list(range(len(own)))
        assert sum(r.n_turns for r in own) == len(rows)
        assert max(r.n_turns for r in own) <= 5 * SEGMENT
        text = "".join(r.rendered for r in own)
        assert text.index("\nt4\n") < text.index("\nt5\n") < text.index("\nt6\n") < text.index("\nt700\n")
