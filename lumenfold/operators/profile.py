"""Column profiles, feature types, correlations and the reports built on them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lumenfold.functions.ranking import exact_percentiles
from lumenfold.functions.skew import spread
from lumenfold.functions.text import explode_words, tokens
from lumenfold.operators.roles import ColumnRoles, is_null_value

ORDINAL_MAX_DISTINCT = 20
TEXT_MIN_TOKENS = 5
TEXT_MIN_DISTINCT_SHARE = 0.5
#: Pairs of columns computed in one pass over the table.
WIDE_CORRELATION = 300

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REALS = (T.FloatType, T.DoubleType, T.DecimalType)
_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _INTEGERS + _REALS)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def unpivot(df: DataFrame, columns: Sequence[str], kind: str, keep: Sequence[str] = ()) -> DataFrame:
    """Long form (keep, feature, value), null values (NULL, NaN, 'null') left out."""
    cells = [F.struct(F.lit(c).alias("feature"), F.when(~is_null_value(df, c), F.col(c)).cast(kind).alias("value"))
             for c in columns]
    return df.select(*keep, F.explode(F.array(*cells)).alias("e")).select(*keep, "e.feature", "e.value") \
        .where(F.col("value").isNotNull())


def to_rows(wide: DataFrame, lines: Sequence[Sequence[Column]]) -> DataFrame:
    """Turn a one-row aggregate into one row per line of aliased columns."""
    return wide.select(F.explode(F.array(*[F.struct(*line) for line in lines])).alias("e")).select("e.*")


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """missing, count, min, max, mean, std, median per numeric column: one wide aggregate plus exact medians."""
    columns = list(columns or numeric_columns(df))
    sums, lines = [F.count(F.lit(1)).alias("rows")], []
    for i, c in enumerate(columns):
        v = F.when(~is_null_value(df, c), F.col(c)).cast("double")
        sums += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"a{i}"), F.max(v).alias(f"b{i}"), F.avg(v).alias(f"m{i}"),
                 F.stddev_samp(v).alias(f"s{i}")]
        lines.append([F.lit(c).alias("feature"), (F.col("rows") - F.col(f"n{i}")).alias("missing"),
                      F.col(f"n{i}").alias("count"), F.col(f"a{i}").alias("min"), F.col(f"b{i}").alias("max"),
                      F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std")])
    medians = exact_percentiles(unpivot(df, columns, "double"), F.col("value"), [0.5], ["feature"], "median")
    return to_rows(df.agg(*sums), lines).join(medians.withColumnRenamed("median_0", "median"), "feature", "left")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n) with values as text; counted before the shuffle."""
    return unpivot(df, columns, "string").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def top_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """First n rows per group (at most n rows per group and task reach the shuffle)."""
    part = [F.col(g) for g in groups] or [F.lit(0)]
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*part).orderBy(*order))).where(F.col(name) <= n)


def categorical_profile(df: DataFrame, columns: Sequence[str] | None = None, top_n: int = 10) -> DataFrame:
    """Most frequent values per column with count, share of the set values, and rank."""
    columns = list(columns or string_columns(df))
    counts = value_counts(df, columns)
    totals = to_rows(df.agg(*[F.count(F.when(~is_null_value(df, c), 1)).alias(f"n{i}") for i, c in enumerate(columns)]),
                     [[F.lit(c).alias("feature"), F.col(f"n{i}").alias("total")] for i, c in enumerate(columns)])
    top = top_per_group(counts, ["feature"], [F.desc("n"), F.asc("value")], top_n)
    return top.join(F.broadcast(totals), "feature") \
        .select("feature", "value", "n", (F.col("n") / F.col("total")).alias("frequency"), "rank")


def text_profile(df: DataFrame, text: str, top_n: int = 10, groups: Sequence[str] = ()) -> DataFrame:
    """Most frequent tokens (per group)."""
    words = explode_words(spread(df.select(*groups, text)), tokens(text), *groups, name="token")
    counts = words.groupBy(*groups, "token").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(counts, groups, [F.desc("n"), F.asc("token")], top_n)


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct values per column. Long texts travel as digests."""
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, n_distinct bigint")
    texts = set(string_columns(df))
    slim = df.select(*[(F.when(~is_null_value(df, c), F.md5(c)) if c in texts else F.col(c)).alias(c) for c in columns])
    return value_counts(slim, columns).groupBy("feature").agg(F.count(F.lit(1)).alias("n_distinct"))


def infer_feature_types(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """(feature, type): linear, categorical, ordinal, textual or date.

    Dates by type; reals are linear; integers with at most 20 distinct values ordinal, else linear; strings with at
    least 5 tokens on average and more than half of the values distinct textual, else categorical.
    """
    columns = list(columns or df.columns)
    kinds = {c: df.schema[c].dataType for c in columns}
    counted = [c for c in columns if isinstance(kinds[c], _INTEGERS + (T.StringType,))]
    texts = [c for c in counted if isinstance(kinds[c], T.StringType)]
    sums = [F.count(F.lit(1)).alias("rows")]
    for c in texts:
        v = F.when(~is_null_value(df, c), F.col(c))
        sums += [F.count(v).alias(f"n_{c}"), F.avg(F.regexp_count(v, F.lit(r"\S+"))).alias(f"t_{c}")]
    if approximate:
        sums += [F.approx_count_distinct(c).alias(f"d_{c}") for c in counted]
    wide, lines = df.agg(*sums), []
    for c in columns:
        line = [F.lit(c).alias("feature"),
                F.lit("date" if isinstance(kinds[c], _DATES) else "linear" if isinstance(kinds[c], _REALS)
                      else "integer" if isinstance(kinds[c], _INTEGERS) else "string" if c in texts
                      else "categorical").alias("kind")]
        line += [(F.col(f"n_{c}") if c in texts else F.lit(0).cast("bigint")).alias("n_set"),
                 (F.col(f"t_{c}") if c in texts else F.lit(0.0)).alias("mean_tokens")]
        if approximate:
            line.append((F.col(f"d_{c}") if c in counted else F.lit(0).cast("bigint")).alias("n_distinct"))
        lines.append(line)
    rows = to_rows(wide, lines)
    if not approximate:
        rows = rows.join(distinct_counts(df, counted), "feature", "left")
    many = F.coalesce(F.col("n_distinct"), F.lit(0))
    textual = (F.col("mean_tokens") >= TEXT_MIN_TOKENS) & (many / F.nullif(F.col("n_set"), F.lit(0)) > TEXT_MIN_DISTINCT_SHARE)
    return rows.select("feature", F.when(F.col("kind") == "integer", F.when(many <= ORDINAL_MAX_DISTINCT, "ordinal")
                                         .otherwise("linear"))
                       .when(F.col("kind") == "string", F.when(textual, "textual").otherwise("categorical"))
                       .otherwise(F.col("kind")).alias("type"))


def feature_type_distribution(types: DataFrame) -> DataFrame:
    return types.groupBy("type").agg(F.count(F.lit(1)).alias("n_features"))


def dropped_features(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, reason): all_null, constant, unique_id (a string that differs in every row) or duplicate.

    Duplicates of an earlier column are found by an order-free fingerprint and then confirmed row by row, so only
    candidate pairs cost a comparison.
    """
    columns = list(columns or df.columns)
    sums = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        v = F.when(~is_null_value(df, c), F.col(c))
        sums += [F.count(v).alias(f"n{i}"), F.min(v).eqNullSafe(F.max(v)).alias(f"c{i}"),
                 F.sum(F.xxhash64(v).cast("decimal(38,0)")).alias(f"h{i}")]
    facts = df.agg(*sums).first()
    kinds = {c: df.schema[c].dataType for c in columns}
    pairs = [(a, b) for (i, a), (j, b) in combinations(enumerate(columns), 2)
             if kinds[a] == kinds[b] and facts[f"h{i}"] == facts[f"h{j}"] and facts[f"n{i}"] == facts[f"n{j}"]]
    same = {}
    if pairs:
        checks = df.agg(*[F.bool_and(F.col(a).eqNullSafe(F.col(b))).alias(f"p{k}") for k, (a, b) in enumerate(pairs)]).first()
        for k, (a, b) in enumerate(pairs):
            if checks[f"p{k}"]:
                same.setdefault(b, a)
    unset = [c for i, c in enumerate(columns) if facts[f"n{i}"] == 0]
    fixed = [c for i, c in enumerate(columns) if c not in unset and facts[f"c{i}"]]
    full = [c for i, c in enumerate(columns) if isinstance(kinds[c], T.StringType) and facts[f"n{i}"] == facts["rows"]
            and c not in fixed and c not in unset]
    counts = distinct_counts(df, full).collect() if full else []
    unique = {r["feature"] for r in counts if r["n_distinct"] == facts["rows"]}
    reasons = []
    for c in columns:
        reason = ("all_null" if c in unset else "constant" if c in fixed else "duplicate" if c in same
                  else "unique_id" if c in unique else None)
        if reason:
            reasons.append((c, reason))
    return df.sparkSession.createDataFrame(reasons, "feature string, reason string")


def pearson(a: str, b: str) -> Column:
    """Pearson correlation over the rows where both columns have a value; NULL where one of them is constant there."""
    x, y = (F.when(F.col(other).isNotNull(), F.col(c).cast("double")) for c, other in ((a, b), (b, a)))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation in long form (a, b, score): symmetric, diagonal 1. One pass for each WIDE_CORRELATION pairs.

    Each pair is judged on the rows where both columns have a value, at every number of columns; the score is NULL where one is constant.
    """
    columns = list(columns or numeric_columns(df))
    pairs = list(combinations(range(len(columns)), 2))
    out = None
    for start in range(0, max(1, len(pairs)), WIDE_CORRELATION):
        part = pairs[start:start + WIDE_CORRELATION]
        wide = df.agg(F.lit(1.0).alias("one"), *[pearson(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in part])
        cells = [(x, y, F.col(f"c{i}_{j}")) for i, j in part for x, y in ((i, j), (j, i))]
        if start == 0:
            cells += [(i, i, F.col("one")) for i in range(len(columns))]
        rows = to_rows(wide, [[F.lit(columns[x]).alias("a"), F.lit(columns[y]).alias("b"), score.alias("score")] for x, y, score in cells])
        out = rows if out is None else out.unionByName(rows)
    return out


def without_charts(stats: str | Column) -> Column:
    """Entries of a map whose key does not mention a chart."""
    return F.map_filter(stats, lambda k, v: ~F.lower(k).contains("chart"))


def feature_role_info(df: DataFrame, roles: ColumnRoles, features: Sequence[str],
                      importance: DataFrame | None = None) -> DataFrame:
    """One row per feature: name, type, role, statistics (map, without chart entries), importance."""
    roles.check(df.columns)
    unknown = [c for c in features if c not in df.columns]
    if unknown:
        raise ValueError(f"no such feature: {unknown}")
    types = infer_feature_types(df, features)
    numbers = [c for c in features if c in numeric_columns(df)]
    others = [c for c in features if c not in numbers]
    stat_maps = []
    if numbers:
        p = numeric_profile(df, numbers)
        names = ["missing", "count", "min", "max", "mean", "std", "median"]
        stat_maps.append(p.select("feature", F.map_from_arrays(
            F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n).cast("double") for n in names])).alias("stats")))
    if others:
        wide = df.agg(F.count(F.lit(1)).alias("rows"),
                      *[F.count(F.when(~is_null_value(df, c), 1)).alias(f"n{i}") for i, c in enumerate(others)])
        stat_maps.append(to_rows(wide, [[F.lit(c).alias("feature"), F.create_map(
            F.lit("missing"), (F.col("rows") - F.col(f"n{i}")).cast("double"),
            F.lit("count"), F.col(f"n{i}").cast("double")).alias("stats")] for i, c in enumerate(others)]))
    stats = stat_maps[0] if len(stat_maps) == 1 else stat_maps[0].unionByName(stat_maps[1])
    role = F.coalesce(*[F.when(F.col("feature") == c, F.lit(roles.role_of(c))) for c in features])
    out = types.join(stats, "feature").withColumn("role", role)
    if importance is not None:
        out = out.join(importance.select("feature", "importance"), "feature", "left")
    else:
        out = out.withColumn("importance", F.lit(None).cast("double"))
    return out.select(F.col("feature").alias("name"), "type", "role", without_charts("stats").alias("stats"), "importance")


def schema_report(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Column, type, role and share of nulls for each column of the table; one aggregate."""
    roles.check(df.columns)
    wide = df.agg(*[F.avg(F.when(is_null_value(df, c), 1.0).otherwise(0.0)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return to_rows(wide, [[F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("type"),
                           F.lit(roles.role_of(c)).alias("role"), F.col(f"n{i}").alias("null_share")]
                          for i, c in enumerate(df.columns)])
