"""Feature engineering modules and feature selection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (IDF, PCA, CountVectorizer, HashingTF, Imputer, OneHotEncoder, StandardScaler, UnivariateFeatureSelector,
                                VectorAssembler)
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from lumenfold.functions.skew import BROADCAST_ROWS, lookup_join, spread
from lumenfold.functions.text import explode_words, tokens
from lumenfold.operators.joins import apply_encoding
from lumenfold.operators.metrics import ratio
from lumenfold.operators.profile import numeric_columns, pearson, string_columns, to_rows, unpivot
from lumenfold.operators.roles import is_null_value
from lumenfold.operators.wordvectors import WordVectors, fit_word_vectors, frequent_from
from lumenfold.session import cut_lineage

# The names of the feature modules, and the ones used when none are chosen.
MODULES = ["Counter", "Date", "freq", "text_tfidf", "text_word2vec", "text_embedding", "tenc", "poly", "pca", "kmean"]
DEFAULT_MODULES = ["freq", "tenc", "Counter"]


def counter(df: DataFrame, numeric: Sequence[str] | None = None, strings: Sequence[str] | None = None) -> DataFrame:
    """Per row: how many numbers are null, zero, negative, positive; how many strings are empty or not."""
    numeric = numeric_columns(df) if numeric is None else list(numeric)
    strings = string_columns(df) if strings is None else list(strings)

    def total(conditions):
        return sum((F.coalesce(c.cast("int"), F.lit(0)) for c in conditions), F.lit(0))
    return df.withColumns({
        "n_null": total([is_null_value(df, c) for c in numeric]),
        "n_zero": total([F.col(c) == 0 for c in numeric]),
        "n_negative": total([F.col(c) < 0 for c in numeric]),
        "n_positive": total([~is_null_value(df, c) & (F.col(c) > 0) for c in numeric]),
        "n_empty": total([F.col(c) == "" for c in strings]),
        "n_filled": total([F.col(c) != "" for c in strings])})


def date_features(df: DataFrame, column: str) -> DataFrame:
    """Calendar parts of a date or time; weeks are ISO weeks, Monday is day 0."""
    c = F.col(column)
    weekday = F.weekday(c)
    parts = {"year": F.year(c), "quarter": F.quarter(c), "month": F.month(c), "day": F.dayofmonth(c), "weekday": weekday,
             "yearday": F.dayofyear(c), "week": F.weekofyear(c), "hour": F.hour(c),
             "is_weekend": (weekday >= 5).cast("int"), "epoch_days": F.unix_date(F.to_date(c))}
    return df.withColumns({f"{column}_{k}": v for k, v in parts.items()})


def frequency_map(train: DataFrame, column: str) -> DataFrame:
    """value -> share of the training rows."""
    total = train.select(F.count(F.lit(1))).scalar()
    return train.groupBy(column).agg(F.count(F.lit(1)).alias("n")) \
        .select(column, (F.col("n") / total).alias(f"{column}_freq")).where(F.col(column).isNotNull())


def frequency_encode(train: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """Add the training share of each value; unseen values get 0."""
    return apply_encoding(df, frequency_map(train, column), column, f"{column}_freq", 0.0)


def term_counts(docs: DataFrame, doc_id: str, words: str) -> DataFrame:
    """(doc, term, tf). Written once: the vocabulary and the weights both need it, and preparing tokens is the slow part."""
    return cut_lineage(explode_words(docs, words, doc_id).groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias("tf")))


def vocabulary(counts: DataFrame, n_docs, n_terms: int | None = None) -> DataFrame:
    """(term, df, idf) of the n_terms most widespread terms, ties by term. idf = ln((n + 1) / (df + 1))."""
    spread_of = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    if n_terms is not None:
        spread_of = spread_of.orderBy(F.desc("df"), "term").limit(n_terms)
    return spread_of.withColumn("idf", F.ln((n_docs + 1) / (F.col("df") + 1)))


def weigh_terms(counts: DataFrame, doc_id: str, vocab: DataFrame) -> DataFrame:
    """(doc, term, tf, weight = tf * idf) for the terms of a vocabulary. The most widespread terms, BROADCAST_ROWS at most, meet a
    broadcast table where they stand; only the rows of rarer terms are shuffled."""
    vocab = cut_lineage(vocab.select("term", "df", "idf"))
    least = frequent_from(vocab, "df", BROADCAST_ROWS)
    wide = vocab.where(F.col("df") >= least).select("term", "idf")
    out = counts.join(F.broadcast(wide), "term")
    if least > 0:
        rare = vocab.where(F.col("df") < least).select("term", "idf")
        out = out.unionByName(counts.join(F.broadcast(wide), "term", "left_anti").join(rare, "term"))
    return out.select(doc_id, "term", "tf", (F.col("tf") * F.col("idf")).alias("weight"))


def text_tfidf(docs: DataFrame, doc_id: str, text: str, n_terms: int | None = None) -> DataFrame:
    counts = term_counts(spread(docs.select(doc_id, text)).select(doc_id, tokens(text).alias("words")), doc_id, "words")
    n = docs.select(F.count(F.lit(1))).scalar()
    return weigh_terms(counts, doc_id, vocabulary(counts, n, n_terms))


def text_word2vec(docs: DataFrame, text: str, dim: int = 32, out: str = "text_vector", seed: int = 7,
                  partitions: int | None = None, min_count: int = 1, max_iter: int = 1) -> DataFrame:
    """Mean of the word vectors of each text; trained on the table's own partitions, at least as many as the session has cores, unless told otherwise."""
    rows = (docs.repartition(partitions) if partitions else spread(docs)).withColumn("_words", tokens(text))
    return fit_word_vectors(rows, "_words", dim, seed, min_count, max_iter).mean(rows, "_words", out).drop("_words")


def text_embedding_model(docs: DataFrame, text: str, dim: int = 16, hash_size: int = 512) -> PipelineModel:
    """Sentence vectors by latent semantic analysis: hashed tf-idf projected on its main axes."""
    rows = spread(docs.select(text)).select(tokens(text).alias("_words"))
    return Pipeline(stages=[HashingTF(inputCol="_words", outputCol="_tf", numFeatures=hash_size),
                            IDF(inputCol="_tf", outputCol="_idf"),
                            PCA(inputCol="_idf", outputCol="_axes", k=dim)]).fit(rows)


def text_embedding(docs: DataFrame, text: str, dim: int = 16, model: PipelineModel | None = None,
                   out: str = "sentence_vector") -> DataFrame:
    model = model or text_embedding_model(docs, text, dim)
    return model.transform(docs.withColumn("_words", tokens(text))).withColumn(out, vector_to_array("_axes")) \
        .drop("_words", "_tf", "_idf", "_axes")


def target_map(train: DataFrame, column: str, target: str, m: float = 10.0) -> DataFrame:
    """value -> smoothed mean (sum y + m * mean) / (n + m) over all training rows."""
    mean = train.select(F.avg(target)).scalar()
    return train.groupBy(column).agg(F.sum(target).alias("s"), F.count(target).alias("n")) \
        .select(column, ((F.col("s") + m * mean) / (F.col("n") + m)).alias(f"{column}_tenc")) \
        .where(F.col(column).isNotNull())


def target_encode_train(train: DataFrame, column: str, target: str, fold: str, m: float = 10.0) -> DataFrame:
    """Out-of-fold encoding: each row is coded by the rows of the other folds only, the smoothing mean included."""
    name = f"{column}_tenc"
    cells = train.groupBy(fold, column).agg(F.sum(target).alias("s"), F.count(target).alias("n"))
    folds = train.groupBy(fold).agg(F.sum(target).alias("fs"), F.count(target).alias("fn"))
    everywhere = Window.partitionBy(F.lit(0))
    prior = folds.select(fold, ratio(F.sum("fs").over(everywhere) - F.col("fs"),
                                     F.sum("fn").over(everywhere) - F.col("fn")).alias("prior"))
    value = Window.partitionBy(column)
    others = cells.withColumns({"s": F.sum("s").over(value) - F.col("s"), "n": F.sum("n").over(value) - F.col("n")}) \
        .where(F.col(column).isNotNull())
    coded = lookup_join(train, others, [fold, column])
    coded = lookup_join(coded, prior, [fold])
    return coded.withColumn(name, F.coalesce((F.col("s") + m * F.col("prior")) / (F.col("n") + m), F.col("prior"))) \
        .drop("s", "n", "prior")


def target_encode(train: DataFrame, df: DataFrame, column: str, target: str, m: float = 10.0) -> DataFrame:
    """Encoding of new rows by the full map; unseen values get the training mean."""
    mean = train.select(F.avg(target)).scalar()
    return apply_encoding(df, target_map(train, column, target, m), column, f"{column}_tenc", mean)


def polynomial(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Squares and pairwise products."""
    new = {f"{c}_x_{c}": F.col(c) * F.col(c) for c in columns}
    new |= {f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in combinations(columns, 2)}
    return df.withColumns(new)


def filled_columns(columns: Sequence[str]) -> list[str]:
    """Helper columns of standard_vector."""
    return [f"_filled_{i}" for i in range(len(columns))]


def standard_vector(df: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """Fitted assembly and standardisation of numeric columns into the vector column _std; NULL and NaN count as the mean.

    A column without any value has no mean and is left out of the vector.
    """
    known = df.agg(*[F.count(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    columns = [c for i, c in enumerate(columns) if known[i]]
    if not columns:
        raise ValueError("no numeric column has a value")
    filled = filled_columns(columns)
    return Pipeline(stages=[Imputer(inputCols=columns, outputCols=filled, strategy="mean"),
                            VectorAssembler(inputCols=filled, outputCol="_raw", handleInvalid="keep"),
                            StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=True)]).fit(df)


def pca(df: DataFrame, columns: Sequence[str], k: int = 2, out: str = "pca") -> DataFrame:
    """Standardise, then project on the k main axes (on fewer, if fewer columns have values)."""
    standard = standard_vector(df, columns)
    scaled = standard.transform(df)
    model = PCA(inputCol="_std", outputCol="_axes", k=min(k, len(standard.stages[1].getInputCols()))).fit(scaled)
    return model.transform(scaled).withColumn(out, vector_to_array("_axes")).drop("_raw", "_std", "_axes", *filled_columns(columns))


def kmean(df: DataFrame, columns: Sequence[str], k: int = 5, seed: int = 7) -> DataFrame:
    """Cluster number and the distances to all k centres."""
    scaled = standard_vector(df, columns).transform(df)
    model = KMeans(featuresCol="_std", predictionCol="cluster", k=k, seed=seed).fit(scaled)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    point = vector_to_array("_std")
    return model.transform(scaled).withColumn("_point", point).withColumn("centre_distances", F.transform(
        centres, lambda c: F.sqrt(F.aggregate(F.zip_with("_point", c, lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                                              lambda acc, d: acc + d)))).drop("_raw", "_std", "_point", *filled_columns(columns))


def feature_scores(df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """(feature, score): |correlation| with the target for numbers, correlation ratio for categories."""
    parts = []
    if numeric:
        wide = df.agg(*[F.abs(pearson(c, target)).alias(f"s{i}") for i, c in enumerate(numeric)])
        parts.append(to_rows(wide, [[F.lit(c).alias("feature"), F.col(f"s{i}").alias("score")]
                                    for i, c in enumerate(numeric)]))
    if categorical:
        cells = unpivot(df, categorical, "string", [target]).where(F.col(target).isNotNull()) \
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("m"),
                                             F.var_pop(target).alias("v"))
        sums = cells.groupBy("feature").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("m")).alias("s"),
                                            F.sum(F.col("n") * F.col("m") * F.col("m")).alias("b"),
                                            F.sum(F.col("n") * F.col("v")).alias("within"))
        between = F.greatest(F.col("b") - F.col("s") * F.col("s") / F.col("n"), F.lit(0.0))
        parts.append(sums.select("feature", F.sqrt(ratio(between, between + F.col("within"))).alias("score")))
    if not parts:
        raise ValueError("name at least one feature")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def select_features(df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str] = (),
                    n: int = 10) -> DataFrame:
    """At most n features with the highest scores, ties by name."""
    if n < 1:
        raise ValueError("keep at least one feature")
    return feature_scores(df, target, numeric, categorical).orderBy(F.desc("score"), "feature").limit(n)


def select_by_test(df: DataFrame, features: str, label: str, n: int, feature_type: str = "continuous",
                   label_type: str = "categorical") -> DataFrame:
    """Alternative selection by a statistical test on a vector column."""
    chooser = UnivariateFeatureSelector(featuresCol=features, labelCol=label, outputCol="selected")
    return chooser.setFeatureType(feature_type).setLabelType(label_type).setSelectionMode("numTopFeatures") \
        .setSelectionThreshold(n).fit(df).transform(df)


def image_features(images: DataFrame) -> DataFrame:
    """Size and per-channel mean and spread of decoded images (columns filename, image)."""
    schema = ("filename string, width int, height int, channels int, bytes bigint, channel_mean array<double>, "
              "channel_std array<double>")

    def measure(batches):
        import numpy as np
        import pandas as pd
        for b in batches:
            rows = []
            for name, w, h, c, data in zip(b["filename"], b["width"], b["height"], b["channels"], b["data"]):
                pixels = np.frombuffer(data, dtype=np.uint8).reshape(-1, c).astype(float)
                rows.append((name, w, h, c, len(data), pixels.mean(axis=0).tolist(), pixels.std(axis=0).tolist()))
            yield pd.DataFrame(rows, columns=["filename", "width", "height", "channels", "bytes", "channel_mean",
                                              "channel_std"])

    flat = images.select("filename", "image.width", "image.height", F.col("image.nChannels").alias("channels"), "image.data")
    return flat.mapInPandas(measure, schema)


@dataclass
class VectorColumns:
    """A fitted pipeline whose vector is spread over numeric columns name_0, name_1, ...; text: the column whose tokens it reads."""

    name: str
    model: PipelineModel
    vector: str
    size: int
    text: str | None = None

    @property
    def names(self) -> list[str]:
        return [f"{self.name}_{i}" for i in range(self.size)]

    def apply(self, df: DataFrame) -> DataFrame:
        rows = df if self.text is None else df.withColumn("_words", tokens(F.coalesce(F.col(self.text), F.lit(""))))
        out = self.model.transform(rows).withColumn("_array", vector_to_array(self.vector))
        # one more column first, so that the array is worked out once and not once per element
        values = {n: F.coalesce(F.get("_array", F.lit(i)), F.lit(0.0)) for i, n in enumerate(self.names)}
        return out.withColumns(values).select(*df.columns, *self.names)


@dataclass
class WordColumns(VectorColumns):
    """Mean word vectors of a text column."""

    model: WordVectors

    def apply(self, df: DataFrame) -> DataFrame:
        out = self.model.mean(df.withColumn("_words", tokens(F.coalesce(F.col(self.text), F.lit("")))), "_words", "_array")
        return out.withColumns({n: F.get("_array", F.lit(i)) for i, n in enumerate(self.names)}).select(*df.columns, *self.names)


TEXT_MODULES, AXIS_MODULES = ("text_tfidf", "text_word2vec", "text_embedding"), ("pca", "kmean")
TEXT_TOKENS, TEXT_TERMS, TEXT_DIM, AXES, CLUSTERS = 3, 20, 8, 2, 5


def text_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The string columns with TEXT_TOKENS tokens or more on average."""
    if not columns:
        return []
    sizes = df.agg(*[F.avg(F.size(tokens(F.col(c)))).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if (sizes[i] or 0) >= TEXT_TOKENS]


def fit_text_columns(df: DataFrame, column: str, module: str) -> VectorColumns:
    """tf-idf of the TEXT_TERMS most widespread terms, mean word vectors, or sentence vectors of a text column."""
    rows = spread(df.select(column)).select(tokens(F.coalesce(F.col(column), F.lit(""))).alias("_words"))
    if module == "text_tfidf":
        stages = [CountVectorizer(inputCol="_words", outputCol="_tf", vocabSize=TEXT_TERMS), IDF(inputCol="_tf", outputCol="_vector")]
    elif module == "text_word2vec":
        return WordColumns(f"{column}_word2vec", fit_word_vectors(rows, "_words", TEXT_DIM), "_array", TEXT_DIM, column)
    else:
        return VectorColumns(f"{column}_embedding", text_embedding_model(df, column, TEXT_DIM), "_axes", TEXT_DIM, column)
    model = Pipeline(stages=stages).fit(rows)
    return VectorColumns(f"{column}_tfidf", model, "_vector", len(model.stages[0].vocabulary), column)


def fit_axis_columns(df: DataFrame, columns: Sequence[str], module: str, seed: int = 7) -> VectorColumns | None:
    """Main axes of the numeric columns, or whether a row lies in each of CLUSTERS clusters; None if no column has a value."""
    try:
        standard = standard_vector(df, columns)
    except ValueError:
        return None
    scaled = standard.transform(df)
    if module == "pca":
        size = min(AXES, len(standard.stages[1].getInputCols()))
        model = PCA(inputCol="_std", outputCol="_vector", k=size).fit(scaled)
        return VectorColumns("axis", PipelineModel([standard, model]), "_vector", size)
    model = KMeans(featuresCol="_std", predictionCol="_cluster", k=CLUSTERS, seed=seed).fit(scaled)
    one = OneHotEncoder(inputCols=["_cluster"], outputCols=["_vector"], dropLast=False).fit(model.transform(scaled))
    return VectorColumns("cluster", PipelineModel([standard, model, one]), "_vector", one.categorySizes[0])


def dataset_embedding(df: DataFrame, row_id: str, label: str, dim: int = 3) -> DataFrame:
    """(id, label, embedding) for exploring a table: numbers and value frequencies, standardised and projected."""
    skip = {row_id, label}
    numbers = [c for c in numeric_columns(df) if c not in skip]
    coded = df
    for c in [c for c in string_columns(df) if c not in skip]:
        coded = frequency_encode(df, coded, c)
        numbers.append(f"{c}_freq")
    return pca(coded, numbers, min(dim, len(numbers)), "embedding").select(
        F.col(row_id).alias("id"), F.col(label).cast("string").alias("label"), F.col("embedding").cast("array<float>"))
