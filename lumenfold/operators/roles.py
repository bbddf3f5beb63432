"""Column roles, row filters, deterministic splits and input contracts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lumenfold.functions.hashing import hash_bucket, hash_share


@dataclass(frozen=True)
class ColumnRoles:
    """Which column plays which part. The id carries no signal and is never a feature."""

    target: str | None = None
    filename: str | None = None
    id: str | None = None
    fold: str | None = None
    weight: str | None = None
    time: str | None = None
    groups: Sequence[str] = field(default_factory=tuple)
    apriori: Sequence[str] = field(default_factory=tuple)
    drop: Sequence[str] = field(default_factory=tuple)

    def named(self) -> dict[str, str]:
        """column -> role for every column with a role (a-priori columns stay features)."""
        out = {c: "drop" for c in self.drop}
        out |= {c: "apriori" for c in self.apriori}
        out |= {c: "group" for c in self.groups}
        single = {"target": self.target, "filename": self.filename, "id": self.id, "fold": self.fold,
                  "weight": self.weight, "time": self.time}
        return out | {c: role for role, c in single.items() if c is not None}

    def check(self, columns: Sequence[str]) -> None:
        unknown = sorted(set(self.named()) - set(columns))
        if unknown:
            raise ValueError(f"columns not in the table: {unknown}")

    def role_of(self, column: str) -> str:
        return self.named().get(column, "feature")

    def features(self, columns: Sequence[str]) -> list[str]:
        return [c for c in columns if self.role_of(c) in ("feature", "apriori")]


def assign_roles(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Keep the columns that matter, the named roles first and the features after them; dropped columns go."""
    roles.check(df.columns)
    kept = [c for c in df.columns if roles.role_of(c) not in ("feature", "apriori", "drop")]
    return df.select(*kept, *roles.features(df.columns))


def drop_columns(df: DataFrame, drop: Sequence[str]) -> DataFrame:
    ColumnRoles(drop=tuple(drop)).check(df.columns)
    return df.drop(*drop)


def is_null_value(df: DataFrame, column: str) -> Column:
    """NULL, NaN or the literal text 'null'."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    if isinstance(kind, T.StringType):
        return c.isNull() | (c == "null")
    return c.isNull()


def normalize_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.withColumns({c: F.when(~is_null_value(df, c), F.col(c)) for c in (columns or df.columns)})


def pred_label(df: DataFrame, prefix: str = "pred_", name: str = "pred_label") -> DataFrame:
    """Label of the largest probability among the columns whose name contains prefix; the first column wins ties."""
    columns = [c for c in df.columns if prefix in c]
    if not columns:
        raise ValueError(f"no column contains {prefix!r}")
    values = {c: F.col(f"`{c}`").cast("double") for c in columns}
    top = F.array_max(F.array(*values.values()))
    return df.withColumn(name, F.coalesce(*[F.when(v == top, F.lit(c.replace(prefix, ""))) for c, v in values.items()]))


def apply_threshold(p: str | Column, threshold: float = 0.5) -> Column:
    p = F.col(p) if isinstance(p, str) else p
    return F.when(p >= threshold, 1).when(p < threshold, 0)


def _castable(df: DataFrame, column: str, kind: str) -> Column:
    c = F.col(column)
    return (c if isinstance(df.schema[column].dataType, T.StringType) else c.cast("string")).try_cast(kind)


def contract_report(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """One row per contract column: is it there, how many values are set, how many fit the type. One pass."""
    names = list(contract)
    sums = []
    for i, c in enumerate(names):
        if c in df.columns:
            sums += [F.count(c).alias(f"n{i}"), F.count(_castable(df, c, contract[c])).alias(f"k{i}")]
        else:
            sums += [F.lit(0).cast("bigint").alias(f"n{i}"), F.lit(0).cast("bigint").alias(f"k{i}")]
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"), *sums)
    lines = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(c in df.columns).alias("present"),
                               F.col(f"n{i}").alias("non_null"), F.col(f"k{i}").alias("castable"))
                      for i, c in enumerate(names)])
    return wide.select("n_rows", F.explode(lines).alias("e")).select("e.*", "n_rows")


def type_policy(df: DataFrame, contract: dict[str, str], policy: str = "best_effort") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows). best_effort turns misfits into NULL; strict sets their rows aside."""
    if policy not in ("best_effort", "strict"):
        raise ValueError("policy must be best_effort or strict")
    columns = [c for c in contract if c in df.columns]
    typed = df.withColumns({c: _castable(df, c, contract[c]) for c in columns})
    if policy == "best_effort":
        return typed, df.where(F.lit(False))
    bad = F.lit(False)
    for c in columns:
        bad = bad | (F.col(c).isNotNull() & _castable(df, c, contract[c]).isNull())
    good = df.where(~bad)
    return good.withColumns({c: _castable(df, c, contract[c]) for c in columns}), df.where(bad)


def _check_share(share: float) -> None:
    if not 0 <= share <= 1:
        raise ValueError("share must lie between 0 and 1")


def sample(df: DataFrame, ratio: float, keys: Sequence[str] = (), seed: int = 0) -> DataFrame:
    """Keep about ratio of the rows: by key hash if keys are given (repeatable), else at random by seed."""
    _check_share(ratio)
    if not keys:
        return df.sample(fraction=ratio, seed=seed)
    return df.where(hash_share(*keys) < ratio)


def split_holdout(df: DataFrame, share: float, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(train, holdout) by key hash; the holdout serves evaluation only."""
    _check_share(share)
    draw = hash_share(*keys, salt="holdout")
    return df.where(draw >= share), df.where(draw < share)


def assign_folds(df: DataFrame, k: int = 5, keys: Sequence[str] = (), fold_column: str | None = None,
                 name: str = "fold") -> DataFrame:
    """The given fold column, or k folds by key hash."""
    if fold_column is not None:
        ColumnRoles(fold=fold_column).check(df.columns)
        return df.withColumn(name, F.col(fold_column))
    if k < 2 or not keys:
        raise ValueError("hash folds need k >= 2 and key columns")
    return df.withColumn(name, hash_bucket(k, *keys, salt="fold").cast("int"))
