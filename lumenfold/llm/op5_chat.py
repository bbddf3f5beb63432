"""Multi-party perspective rotation, in DataFrame functions only.

For every participant of a conversation the dialogue is rendered once with this speaker as the assistant and all others as
named users; context roles (system) keep their place in every rendering and are nobody's perspective. The mask lists runs
of characters with a flag, 1 where the assistant's words are to be learned, 0 elsewhere, so the runs add up to the text.

A conversation is cut into segments of SEGMENT turn numbers, so no conversation is gathered into one row; a segment in
which turns repeat so often that it has over 4 * SEGMENT rows is cut by turn, and a turn with more rows than that by hash.
Segments are numbered without gaps.

Cases: a null text is empty; a null role is the participant `unknown`; null turns come first, in a segment of their own; equal turns stand in the order
of role and text; rows with a null conv_id form one conversation. A conversation of context roles only has no rows; nor has
an empty table. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumenfold.llm.common import table

SEGMENT, CONTEXT = 256, ("system",)


def _header(role: Column, speaker: Column, context: Sequence[str]) -> Column:
    kind = F.when(role == speaker, F.lit("assistant")).when(role.isin(*context), role).otherwise(F.concat(F.lit("user name="), role))
    return F.concat(F.lit("<|"), kind, F.lit("|>\n"))


def segments(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) in bounded rows: conv_id, segment, turns array<struct<turn, role, text>>."""
    limit = 4 * SEGMENT
    part = turns.withColumn("a", F.floor(F.col("turn") / SEGMENT))

    def crowded(keys: list[str], name: str) -> DataFrame:
        n = part.groupBy("conv_id", *keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > limit)
        return n.select(*[F.col(k).alias(f"_{k}") for k in ("conv_id", *keys)], name)

    def joined(df: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
        cond = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in ("conv_id", *keys)]
        return df.join(small, cond, "left").drop(*[f"_{k}" for k in ("conv_id", *keys)])

    rows = joined(part, crowded(["a"], "n_a"), ["a"])
    rows = joined(rows, crowded(["a", "turn"], "n_b"), ["a", "turn"])
    rows = rows.withColumn("b", F.when(F.col("n_a").isNotNull(), F.col("turn"))).withColumn(
        "c", F.when(F.col("n_b").isNotNull(), F.pmod(F.xxhash64("role", "text"), F.ceil(F.col("n_b") / limit))).otherwise(F.lit(0)))
    seg = rows.groupBy("conv_id", "a", "b", "c").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("a", "b", "c")) - 1
    return seg.select("conv_id", number.cast("long").alias("segment"), "turns")


def rotate(conversations: DataFrame, context: Sequence[str] = CONTEXT) -> DataFrame:
    """conv_id, speaker, segment, n_turns, rendered, mask, n_train: one row for each participant and segment."""
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    people = turns.where(~F.col("role").isin(*context)).select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")).distinct()
    rows = segments(turns).join(people, F.col("conv_id").eqNullSafe(F.col("_conv")))

    def header(t):
        return _header(t["role"], F.col("speaker"), context)

    def runs(t):
        return F.concat(F.lit("0:"), F.char_length(header(t)), F.when(t["role"] == F.col("speaker"), ",1:").otherwise(",0:"),
                        F.char_length(t["text"]) + F.lit(1))

    own = F.filter("turns", lambda t: t["role"] == F.col("speaker"))
    return rows.select(
        "conv_id", "speaker", "segment", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(header(t), t["text"], F.lit("\n"))), "").alias("rendered"),
        F.array_join(F.transform("turns", runs), ",").alias("mask"),
        F.aggregate(own, F.lit(0).cast("long"), lambda n, t: n + F.char_length(t["text"]) + 1).alias("n_train"))


def op5(spark, sf_dir) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text, turn // 256 AS a FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
r AS (SELECT t.conv_id, speaker, a, turn, role, text, '<|' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN role
        ELSE 'user name=' || role END || '|>' || chr(10) AS header FROM t JOIN p ON t.conv_id = p.conv_id),
s AS (SELECT conv_id, speaker, a, count(*) AS n_turns, string_agg(header || text || chr(10), '' ORDER BY turn, role, text) AS rendered,
        string_agg('0:' || length(header) || CASE WHEN role = speaker THEN ',1:' ELSE ',0:' END || (length(text) + 1), ','
                   ORDER BY turn, role, text) AS mask,
        sum(CASE WHEN role = speaker THEN length(text) + 1 ELSE 0 END)::BIGINT AS n_train FROM r GROUP BY conv_id, speaker, a)
SELECT conv_id, speaker, row_number() OVER (PARTITION BY conv_id, speaker ORDER BY a) - 1 AS segment, n_turns, rendered, mask, n_train FROM s"""

QUERIES = {"op5_perspectives": op5}
ORACLES = {"op5_perspectives": SQL}
