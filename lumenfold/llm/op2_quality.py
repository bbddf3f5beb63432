"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a condition on a text under which it is rejected. On a sample every rule's cost (seconds to evaluate it alone)
and the sets of rules that its texts fail are measured; the order is then chosen greedily: next comes the rule that rejects
most of what the rules before it let through, per second. The verdict is a CASE over the rules in that order, so a text is
only read until its first failing rule. The order changes the work and never the verdict.

Cases: null text has no words; a text without words fails. Rows stay as they are, repeated or not, and an empty table gives
an empty result (rules then keep their given order). No helper columns are added, so none clash.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lumenfold.llm.common import stored, table, words

SAMPLE_ROWS = 2000
SHINGLE = 5
HAS_WORD = "[^ \\x09-\\x0D]"


def removed_chars(text: Column, pattern: str) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(HAS_WORD))


@dataclass(frozen=True)
class Rule:
    """name, and the condition that rejects, from the text (never null) and its words; both are columns."""
    name: str
    rejects: object


def default_rules() -> list[Rule]:
    """Symbols, shouting, exclamation marks, repeated lines, and words too short or too long on average."""
    return [
        Rule("symbols", lambda text, w: 4 * removed_chars(text, "[#*$%&|<>]") > F.size(w)),
        Rule("shouting", lambda text, w: 2 * removed_chars(text, "[A-Z]") > F.char_length(F.array_join(w, ""))),
        Rule("exclamation", lambda text, w: 2 * removed_chars(text, "!") > F.size(w)),
        Rule("repeated_lines", lambda text, w: 2 * (F.size(worded_lines(text)) - F.size(F.array_distinct(worded_lines(text))))
             > F.size(worded_lines(text))),
        Rule("word_length", lambda text, w: ~F.char_length(F.array_join(w, "")).between(2 * F.size(w), 20 * F.size(w)) | (F.size(w) < 1)),
    ]


def measured_order(docs: DataFrame, rules: Sequence[Rule], text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second on a sample of about sample_rows rows, each counted on what the earlier ones let through."""
    n = docs.count()
    if not n or len(rules) < 2:
        return list(rules)
    text = F.coalesce(F.col(text_col), F.lit(""))
    sample = docs.select(text.alias("text"))
    sample = stored(sample.sample(sample_rows / n, seed=7) if n > sample_rows else sample, "rule_sample")
    sample = sample.withColumn("w", words(F.col("text")))
    fails = [r.rejects(F.col("text"), F.col("w")) for r in rules]
    groups = [(tuple(r[:-1]), r[-1]) for r in sample.groupBy(*[f.alias(f"f{i}") for i, f in enumerate(fails)]).count().collect()]
    cost = []
    for f in fails:
        start = time.perf_counter()
        sample.agg(F.sum(f.cast("int"))).collect()
        cost.append(time.perf_counter() - start)
    order, left = [], list(range(len(rules)))
    while left:
        best = max(left, key=lambda i: (sum(c for g, c in groups if g[i] and not any(g[j] for j in order)) / cost[i], -i))
        order.append(best)
        left.remove(best)
    return [rules[i] for i in order]


def first_failed(text: Column, w: Column, rules: Sequence[Rule]) -> Column:
    """The name of the first rule that rejects; null for a kept text. Later rules are not evaluated."""
    case = None
    for r in rules:
        case = (F if case is None else case).when(r.rejects(text, w), F.lit(r.name))
    return case if case is not None else F.lit(None).cast("string")


def let(value: Column, use) -> Column:
    """use(value), with value evaluated once per row however often use refers to it and wherever the optimizer moves it."""
    return F.get(F.transform(F.array(value), use), 0)


def repeat_words(w: Column) -> Column:
    """The words of array w inside five-word windows found twice or more.

    Windows are compared by 64-bit hashes; only texts with a repeated hash sort them with their places.
    """
    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)), lambda i: F.xxhash64(F.slice(w, i, SHINGLE)))

    def places(p: Column) -> Column:
        twice = F.filter(p, lambda x, i: (x["h"] == F.get(p, i - 1)["h"]) | (x["h"] == F.get(p, i + 1)["h"]))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-SHINGLE).alias("last")),
                           lambda s, i: F.struct((s["n"] + F.least(F.lit(SHINGLE), i - s["last"])).alias("n"), i.alias("last")),
                           lambda s: s["n"])

    def count(h: Column) -> Column:
        paired = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(paired, lambda p: let(places(p), covered)))

    return F.when(F.size(w) < SHINGLE, 0).otherwise(let(hashes, count))


def dup_lines(text: Column) -> Column:
    return let(worded_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x)))


def base_failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < 10) | (100 * n_repeat > 20 * n_words)


def quality(docs: DataFrame, rules: Sequence[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts and verdict of each row."""
    rules = measured_order(docs, default_rules() if rules is None else rules, text_col)
    counts = {"n_words": lambda t, w: F.size(w), "word_chars": lambda t, w: F.char_length(F.array_join(w, "")),
              "n_symbols": lambda t, w: removed_chars(t, "[#*$%&|<>]"), "n_dup_lines": lambda t, w: dup_lines(t),
              "n_repeat_words": lambda t, w: repeat_words(w)}

    def measured(t: Column, w: Column) -> Column:
        base = F.struct(*[f(t, w).cast("long").alias(n) for n, f in counts.items()])
        return let(base, lambda m: F.struct(m.alias("m"), failing(t, w, m).alias("reason")))

    def failing(t: Column, w: Column, m: Column) -> Column:
        return F.when(base_failed(m["n_words"], m["n_repeat_words"]), F.lit("")).otherwise(first_failed(t, w, rules))

    text = F.coalesce(F.col(text_col), F.lit(""))
    found = let(text, lambda t: let(words(t), lambda w: measured(t, w)))
    rows = docs.select(F.col(id_col).alias("doc_id"), found.alias("f"))
    return rows.select("doc_id", *[F.col(f"f.m.{n}").alias(n) for n in counts],
                       F.coalesce(F.col("f.reason") == "", F.lit(False)).alias("base_failed"), F.col("f.reason").isNull().alias("kept"))


def kept_rows(docs: DataFrame, rules: Sequence[Rule] | None = None, text_col: str = "text") -> DataFrame:
    """The rows of docs that the base rule and the cascade keep, with their own columns.

    The repeated windows, the dearest measure, are only looked for in what all other rules let through.
    """
    rules = measured_order(docs, default_rules() if rules is None else rules, text_col)

    def keep(t: Column, w: Column) -> Column:
        return F.when(F.size(w) < 10, False).when(first_failed(t, w, rules).isNotNull(), False).otherwise(
            ~base_failed(F.size(w).cast("long"), repeat_words(w).cast("long")))

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.where(let(text, lambda t: let(words(t), lambda w: keep(t, w))))


def op2(spark, sf_dir) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, list_filter(regexp_split_to_array(text, '[ \t\n\x0b\x0c\r]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0b\x0c\r]')) AS lines FROM t),
g AS (SELECT r, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(words[i:i + 4], ' ')) AS n FROM g),
p AS (SELECT r, i, least(5, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 5)) AS cover FROM h WHERE n > 1),
s AS (SELECT r, sum(cover)::BIGINT AS n_repeat_words FROM p GROUP BY r),
b AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS upper_chars,
        length(text) - length(regexp_replace(text, '!', '', 'g')) AS marks, len(lines) AS n_lines
      FROM w LEFT JOIN s USING (r)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR 4 * n_symbols > n_words OR 2 * upper_chars > word_chars OR 2 * marks > n_words OR 2 * n_dup_lines > n_lines
         OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM f"""

QUERIES = {"op2_quality_rules": op2}
ORACLES = {"op2_quality_rules": SQL}
