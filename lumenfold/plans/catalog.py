"""Registry of the named queries and the table bindings they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lumenfold.functions.hashing import hash_share

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Add a query under its inventory key, with the SQL that must give the same rows."""
    def keep(fn):
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    """Round double columns: the last digits of floating sums depend on the order of addition."""
    names = set(columns) or {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if c in names else F.col(f"`{c}`")
                       for c in df.columns])


def sql_hash(text: str) -> str:
    """The oracle's form of functions.hashing.key_hash."""
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT)"


# --- bindings: regression, binary, tie-heavy binary, multiclass -------------------------------------------------

REGRESSION_SQL = """(SELECT p_brand, l_extendedprice AS y, l_quantity * p_retailprice AS p, l_quantity AS w
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def regression_rows(spark, sf_dir) -> DataFrame:
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "p_brand", F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * F.col("p_retailprice")).alias("p"),
        F.col("l_quantity").alias("w"))


BINARY_SQL = """(SELECT o_orderkey AS id, o_orderpriority AS grp, o_custkey,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
    1 / (1 + exp(-(o_totalprice - (SELECT avg(o_totalprice) FROM orders))
                 / (SELECT stddev_samp(o_totalprice) FROM orders))) AS p,
    1.0 + o_custkey % 3 AS w, o_totalprice AS price FROM orders)"""


def binary_rows(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    stats = orders.agg(F.avg("o_totalprice").alias("m"), F.stddev_samp("o_totalprice").alias("s"))
    mean, std = stats.select("m").scalar(), stats.select("s").scalar()
    return orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("grp"), "o_custkey",
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y"),
        (1 / (1 + F.exp(-(F.col("o_totalprice") - mean) / std))).alias("p"),
        (1.0 + F.col("o_custkey") % 3).alias("w"), F.col("o_totalprice").alias("price"))


TIED_SQL = """(SELECT l_linestatus AS grp, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_discount * 10 AS p
    FROM lineitem)"""


def tied_rows(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("grp"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
        (F.col("l_discount") * 10).alias("p"))


STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _class_sql(truth: str, group: str, classes: list[str]) -> str:
    raw = ", ".join(f"{sql_hash(f'o_orderkey::VARCHAR || chr(124) || {c!r}')} / 4294967296.0 AS b{i}"
                    for i, c in enumerate(classes))
    total = " + ".join(f"b{i}" for i in range(len(classes)))
    share = ", ".join(f"b{i} / ({total}) AS p{i}" for i in range(len(classes)))
    return f"""(SELECT id, y, grp, w, {share} FROM (SELECT o_orderkey AS id, {truth} AS y, {group} AS grp,
        1.0 + o_custkey % 3 AS w, {raw} FROM orders) r0)"""


def _class_rows(spark, sf_dir, truth: str, group: str, classes: list[str]) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    raw = orders.select(F.col("o_orderkey").alias("id"), F.col(truth).alias("y"), F.col(group).alias("grp"),
                        (1.0 + F.col("o_custkey") % 3).alias("w"),
                        *[hash_share("o_orderkey", F.lit(c)).alias(f"b{i}") for i, c in enumerate(classes)])
    total = sum((F.col(f"b{i}") for i in range(1, len(classes))), F.col("b0"))
    return raw.select("id", "y", "grp", "w", *[(F.col(f"b{i}") / total).alias(f"p{i}") for i in range(len(classes))])


STATUS_SQL = _class_sql("o_orderstatus", "o_orderpriority", STATUSES)
PRIORITY_SQL = _class_sql("o_orderpriority", "o_orderstatus", PRIORITIES)


def status_rows(spark, sf_dir) -> DataFrame:
    return _class_rows(spark, sf_dir, "o_orderstatus", "o_orderpriority", STATUSES)


def priority_rows(spark, sf_dir) -> DataFrame:
    return _class_rows(spark, sf_dir, "o_orderpriority", "o_orderstatus", PRIORITIES)


def class_probs(classes: list[str]) -> dict[str, str]:
    return {c: f"p{i}" for i, c in enumerate(classes)}
