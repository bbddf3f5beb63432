"""Text similarity: preparation, vectors, exact and approximate search, and the grid that compares them."""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from itertools import combinations

import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

from lumenfold.functions.hashing import key_hash
from lumenfold.functions.skew import BROADCAST_ROWS, spread
from lumenfold.functions.text import STOP_WORDS, TOKEN, detect_language, stem, tokens, without_stop_words
from lumenfold.functions.topk import celled_topk, dealt, exact_topk, finish, in_cells, is_sparse, nearest_lists
from lumenfold.operators.features import frequent_from, term_counts, text_embedding, text_embedding_model, vocabulary, weigh_terms
from lumenfold.operators.metrics import TEXT_SIMILARITY, retrieval_metrics
from lumenfold.session import cut_lineage, kept, release

# Names of the vector kinds and search methods, and the pairs compared by default.
EMBEDDINGS = ["tf_idf", "transformer", "transformer_fine_tuned"]
SEARCHES = ["brute_force", "cluster_pruning", "ivf_opq", "hkm", "lsh"]
DEFAULT_GRID = [("tf_idf", "brute_force"), ("tf_idf", "cluster_pruning"), ("transformer", "brute_force"),
                ("transformer_fine_tuned", "brute_force")]
DEFAULT_TOP_K = 10
#: Recall that approximate searches aim at and what they add to it, the queries they are tuned on, rows to learn a list from, bits flipped at most.
TARGET, MARGIN, SAMPLE_QUERIES, ROWS_A_LIST, MAX_FLIPS = 0.9, 0.03, 100, 256, 4
#: Rows whose buckets are worked out at once.
FLIP_ROWS = 1000
#: Documents whose terms are held as lists at once.
TEXT_ROWS = 500
#: Share of the sampled neighbours that the quantised form must hand on to exact scoring.
RERANKED = 0.985
SENTENCE_TOKENS = 8


def _choice(name: str, value: str, allowed: Sequence[str]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {list(allowed)}")


def preprocess(df: DataFrame, text: str, lang: str = "auto", word_stemming: str = "yes", ignore_stop_word: str = "auto",
               ignore_punctuation: str = "no", out: str = "words") -> DataFrame:
    """Add lang and the prepared tokens. Stop words on auto go when the texts are full sentences on average."""
    _choice("lang", lang, ["auto", *STOP_WORDS])
    _choice("word_stemming", word_stemming, ["yes", "no"])
    _choice("ignore_stop_word", ignore_stop_word, ["yes", "no", "auto"])
    _choice("ignore_punctuation", ignore_punctuation, ["yes", "no"])
    rows = df.withColumn(out, tokens(text, keep_punctuation=ignore_punctuation == "no"))
    rows = rows.withColumn("lang", detect_language(F.col(out)) if lang == "auto" else F.lit(lang))
    words = F.col(out)
    if ignore_stop_word != "no":
        cleaned = without_stop_words(words, F.col("lang"))
        if ignore_stop_word == "auto":
            mean = df.select(F.avg(F.regexp_count(text, F.lit(TOKEN)))).scalar()
            cleaned = F.when(mean >= SENTENCE_TOKENS, cleaned).otherwise(words)
        rows = rows.withColumn(out, cleaned)
    if word_stemming == "yes":
        rows = rows.withColumn(out, stem(F.col(out), F.col("lang")))
    return rows


def tfidf_weights(counts: DataFrame, row_id: str, vocab: DataFrame) -> DataFrame:
    """Long (id, term, weight) with each row scaled to length 1."""
    v = tfidf_vectors(counts, row_id, vocab)
    return v.select(row_id, F.explode(F.arrays_zip("vector.terms", "vector.weights")).alias("e")) \
        .select(row_id, F.col("e.terms").alias("term"), F.col("e.weights").alias("weight"))


def tfidf_vectors(counts: DataFrame, row_id: str, vocab: DataFrame, out: str = "vector") -> DataFrame:
    """Sparse unit vectors struct(terms, weights) from term counts; rows without a known term are left out."""
    long = weigh_terms(counts, row_id, vocab).where(F.col("weight") > 0)
    # the norm is an aggregate of its own: inside the lambda it would be worked out once per term
    packed = long.groupBy(row_id).agg(F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("e"),
                                      F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("n"))
    return packed.select(row_id, F.struct(
        F.transform("e", lambda x: x["term"]).alias("terms"),
        F.transform("e", lambda x: x["weight"] / F.col("n")).alias("weights")).alias(out))


def sliced(batches):
    """Arrow batches in parts of TEXT_ROWS rows, as a text takes much more room as a list of words."""
    return (batch.slice(start, TEXT_ROWS) for batch in batches for start in range(0, batch.num_rows, TEXT_ROWS))


def packed_counts(docs: DataFrame, doc_id: str, words: str) -> DataFrame:
    """(doc, terms, tfs) of documents that stand in one row each: their terms in order and how often they occur; rows without a term
    are left out. Nothing is shuffled, and stored it takes a small part of the texts' size."""
    from collections import Counter

    def run(batches):
        for batch in sliced(batches):
            found = [sorted(Counter(w for w in row or () if w is not None).items()) for row in batch.column(words).to_pylist()]
            own = pa.array([bool(x) for x in found], pa.bool_())
            found = [x for x in found if x]
            yield pa.RecordBatch.from_arrays([batch.column(doc_id).filter(own), pa.array([[t for t, _ in x] for x in found], pa.list_(pa.string())),
                                              pa.array([[n for _, n in x] for x in found], pa.list_(pa.int64()))], [doc_id, "terms", "tfs"])
    rows = docs.select(doc_id, words)
    return kept(rows.mapInArrow(run, T.StructType([rows.schema[doc_id], *T._parse_datatype_string("terms array<string>, tfs array<bigint>").fields])), "counts")


def packed_vectors(packed: DataFrame, doc_id: str, vocab: DataFrame, out: str = "vector") -> DataFrame:
    """tfidf_vectors of packed counts and a stored vocabulary, worked out wherever they are read. The most widespread terms,
    BROADCAST_ROWS at most, are looked up there. Of rarer ones the number of documents is joined first, and the documents are
    stored with it; their widespread terms pass through that shuffle as one compressed value."""
    least = frequent_from(vocab, "df", BROADCAST_ROWS)
    sc, (name, kind) = packed.sparkSession.sparkContext, (doc_id, packed.schema[doc_id])
    wide = sc.broadcast({r["term"]: r["idf"] for r in vocab.where(F.col("df") >= least).select("term", "idf").collect()})
    by_df = sc.broadcast({r["df"]: r["idf"] for r in vocab.where(F.col("df") < least).select("df", "idf").distinct().collect()})  # one each number
    if least > 0:
        parted = packed.mapInArrow(_parted(wide, name), T.StructType([kind, *T._parse_datatype_string(
            "blob binary, terms array<string>, tfs array<bigint>").fields]))
        rare = parted.select(name, F.explode(F.arrays_zip("terms", "tfs")).alias("e")).select(name, F.col("e.terms").alias("term"), F.col("e.tfs").cast("int").alias("tf"))
        rare = rare.join(vocab.where(F.col("df") < least).select("term", F.col("df").cast("int").alias("df")), "term") \
            .select(name, F.lit(None).cast("binary").alias("blob"), F.struct("term", "tf", "df").alias("e"))
        both = parted.select(name, "blob", F.lit(None).cast(rare.schema["e"].dataType).alias("e")).unionByName(rare)
        rows = both.groupBy(name).agg(F.first("blob", ignorenulls=True).alias("blob"), F.collect_list("e").alias("e"))
        packed = kept(rows.select(name, "blob", *[F.col(f"e.{c}").alias(f"{c}s") for c in ("term", "tf", "df")]), "spread")

    def run(batches):
        import pickle
        import zlib
        near, far = wide.value, by_df.value
        vectors = pa.struct([("terms", pa.list_(pa.string())), ("weights", pa.list_(pa.float64()))])
        for batch in sliced(batches):
            found = []
            for row in batch.to_pylist():
                pairs = zip(row["terms"], row["tfs"])
                if least > 0:
                    pairs = [(t, n, far[x]) for t, n, x in zip(row["terms"], row["tfs"], row["dfs"])]
                    pairs = sorted(pairs + [(t, n, near[t]) for t, n in zip(*pickle.loads(zlib.decompress(row["blob"])))])
                else:
                    pairs = [(t, n, near[t]) for t, n in pairs if t in near]
                weights = [(t, n * idf) for t, n, idf in pairs if idf > 0]
                length = math.sqrt(math.fsum(w * w for _, w in weights))
                found.append({"terms": [t for t, _ in weights], "weights": [w / length for _, w in weights]} if weights else None)
            own = pa.array([x is not None for x in found], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(name).filter(own), pa.array([x for x in found if x is not None], vectors)], [name, out])
    return packed.mapInArrow(run, T.StructType([kind, *T._parse_datatype_string(f"{out} struct<terms: array<string>, weights: array<double>>").fields]))


def _parted(wide, name: str):
    """Packed counts with the terms looked up in a broadcast table as one compressed value, the others as they are."""
    def run(batches):
        import pickle
        import zlib
        near = wide.value
        for batch in sliced(batches):
            blobs, terms, tfs = [], [], []
            for row in zip(batch.column("terms").to_pylist(), batch.column("tfs").to_pylist()):
                pairs = list(zip(*row))
                known = [x for x in pairs if x[0] in near]
                rare = [x for x in pairs if x[0] not in near]
                blobs.append(zlib.compress(pickle.dumps(tuple(map(list, zip(*known))) or ([], []), 5)))
                terms.append([t for t, _ in rare])
                tfs.append([n for _, n in rare])
            yield pa.RecordBatch.from_arrays([batch.column(name), pa.array(blobs, pa.binary()), pa.array(terms, pa.list_(pa.string())),
                                              pa.array(tfs, pa.list_(pa.int64()))], [name, "blob", "terms", "tfs"])
    return run


def dense_vectors(df: DataFrame, row_id: str, vector: str, out: str = "vector") -> DataFrame:
    """Unit vectors from an array column that is already on the table."""
    v = F.col(vector).cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return df.select(row_id, F.zip_with(v, F.array_repeat(F.when(norm > 0, norm).otherwise(1.0), F.size(v)),
                                        lambda x, n: x / n).alias(out))


# --- search: frames (query id, vector) and (item id, vector) of unit vectors --------------------------------------

def cross_topk(queries: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str, query_vector: str = "vector",
               item_vector: str = "vector") -> DataFrame:
    """k items of largest dot product per query."""
    return exact_topk(queries, items, k, query_id, item_id, query_vector, item_vector)


def search_brute_force(queries: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str) -> DataFrame:
    """Exact cosine search. With sparse vectors, items that share no term are no match."""
    found = exact_topk(queries, items, k, query_id, item_id)
    return found.where(F.col("score") > 0) if is_sparse(items, "vector") else found


def _lifted(df: DataFrame, row_id: str, is_centre: bool) -> DataFrame:
    """One more dimension, so that the largest dot product means the smallest Euclidean distance."""
    half = F.aggregate("vector", F.lit(0.0), lambda a, x: a - x * x / 2)
    return df.select(row_id, F.concat("vector", F.array(half if is_centre else F.lit(1.0))).alias("vector"))


def _nearest(rows: DataFrame, row_id: str, centres: DataFrame, n: int, euclidean: bool) -> DataFrame:
    """(row id, b, place): the n nearest centres of each row."""
    if euclidean:
        found = exact_topk(_lifted(rows, row_id, False), _lifted(centres, "centre", True), n, row_id, "centre")
    else:
        found = exact_topk(rows, centres, n, row_id, "centre")
    return found.select(row_id, F.col("centre").alias("b"), F.col("rank").alias("place"))


def sampled_truth(queries: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str) -> tuple[DataFrame, DataFrame]:
    """(at most SAMPLE_QUERIES queries of lowest key hash, their exact k best): what a search is tuned on; one scan of the items."""
    few = cut_lineage(queries.orderBy(key_hash(query_id), query_id).limit(SAMPLE_QUERIES))
    return few, cut_lineage(exact_topk(few, items, k, query_id, item_id).select(query_id, item_id))


def needed_places(places: DataFrame, target: float, most: int) -> int:
    """The number of places that holds the target share of the rows of places(place), and a little more; NULL counts as the last place."""
    share = min(1.0, target + MARGIN)
    return int(places.agg(F.ceil(F.percentile(F.coalesce("place", F.lit(most)), share)).alias("p")).first()[0] or most)


def _probe(queries, items, centres, k, probes, query_id, item_id, euclidean, target=None, vectors=None, best=None, margin=None, sample=None):
    """Put items in the cell of their nearest centre, look into the nearest cells of each query.

    Without a number of probes, as many as a sample of queries needs to find the target share of its exact neighbours.
    vectors: the vectors to score by, if they are not those that were placed. With best or margin the vectors' column
    exact decides in the end, as celled_topk says. sample: the sampled truth, if it is known.
    """
    sparse = is_sparse(items, "vector")
    # items that can be placed where they stand need no join
    here = in_cells(items, centres, item_id, "centre") if probes is not None and not euclidean and vectors is None and _unique(items, item_id) else None
    if here is None:
        placed = cut_lineage(_nearest(items, item_id, centres, 1, euclidean).drop("place"))
    if probes is None:
        number = centres.count()
        few, truth = sample or sampled_truth(queries, items, k, query_id, item_id)
        ranked = _nearest(few, query_id, centres, number, euclidean)
        probes = needed_places(truth.join(placed, item_id).join(ranked, [query_id, "b"], "left"), target, number)
    if euclidean:
        asked = nearest_lists(_lifted(queries, query_id, False), _lifted(centres, "centre", True), probes, query_id, "centre")
        asked = asked.withColumn("vectors", F.transform("vectors", lambda v: F.slice(v, 1, F.size(v) - 1)))
    else:
        asked = nearest_lists(queries, centres, probes, query_id, "centre")
    asked = _cells_of(dealt(asked.select(F.col(query_id).alias("q"), F.explode("vectors").alias("v"), "bs"), queries))
    if here is not None:
        return celled_topk(asked, here, k, sparse, stored=False)
    rows = (items if vectors is None else vectors).join(placed, item_id)
    own = [] if best is None and margin is None else [F.col("exact").alias("e")]
    return celled_topk(asked,
                       cut_lineage(rows.select("b", F.col(item_id).alias("i"), F.col("vector").alias("v"), *own)), k, sparse,
                       *([best, margin] if own else []))


def _cells_of(rows: DataFrame) -> DataFrame:
    """(b, q, v) for each cell in bs of the rows (q, v, bs); only the first cell of a row comes with the vector."""
    return rows.select("q", "v", F.posexplode("bs").alias("at", "b")).select("b", "q", F.when(F.col("at") == 0, F.col("v")).alias("v"))


def _named(found: DataFrame, query_id: str, item_id: str) -> DataFrame:
    return found.select(F.col("q").alias(query_id), F.col("i").alias(item_id), "score", "rank")


def approximate_places(few: DataFrame, truth: DataFrame, coded: DataFrame, query_id: str, item_id: str):
    """Of each neighbour of the sampled queries, as two arrays: its place among the items (vector, approx) ordered by approximate
    vectors, and by how much its approximate score falls short of the exact one; one scan of the items."""
    import numpy as np
    rows = truth.join(few.select(query_id, F.col("vector").alias("_q")), query_id).join(coded, item_id) \
        .select("_q", "vector", "approx").collect()  # SAMPLE_QUERIES times k, as ids are unique
    if not rows:
        return np.zeros(0), np.zeros(0)
    asked, exact, rough = (np.array([r[n] for r in rows], float) for n in range(3))
    own, at = np.unique(asked, axis=0, return_inverse=True)
    scores = (asked * rough).sum(1)
    shared = coded.sparkSession.sparkContext.broadcast((own, at.ravel(), scores + 1e-9))

    def run(batches):
        own, at, least = shared.value
        ahead = np.zeros(len(at), np.int64)
        for batch in batches:
            if len(batch):
                found = own @ np.stack([np.asarray(v, dtype=float) for v in batch["approx"]]).T
                ahead += [np.count_nonzero(found[row] > edge) for row, edge in zip(at, least)]
        yield pd.DataFrame({"n": np.arange(len(at)), "ahead": ahead})
    places = np.ones(len(rows))
    for r in coded.select("approx").mapInPandas(run, "n long, ahead long").groupBy("n").agg(F.sum("ahead").alias("ahead")).collect():
        places[r["n"]] += r["ahead"]
    return places, (asked * exact).sum(1) - scores


def search_cluster_pruning(queries: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str,
                           probes: int = 3) -> DataFrame:
    """About sqrt(n) items chosen by hash lead; a query is compared with the followers of its nearest leaders."""
    n = items.count()
    leaders = cut_lineage(items.orderBy(key_hash(item_id), item_id).limit(max(1, math.ceil(math.sqrt(n))))
                          .select(F.col(item_id).alias("centre"), "vector"))
    found = finish(_probe(queries, items, leaders, k, probes, query_id, item_id, False), k)
    out = _named(found, query_id, item_id)
    return out.where(F.col("score") > 0) if is_sparse(items, "vector") else out


def _centres(items: DataFrame, model) -> DataFrame:
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return items.sparkSession.createDataFrame(rows, "centre bigint, vector array<double>")


def _need_dense(items: DataFrame) -> None:
    if is_sparse(items, "vector"):
        raise ValueError("this search needs dense vectors")


def search_hkm(queries: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str, depth: int | None = None, probes: int | None = None,
               seed: int = 7, target: float = TARGET) -> DataFrame:
    """Tree of two-way k-means splits with about sqrt(n) leaves; the nearest leaves are searched exactly, as many as the target recall needs."""
    _need_dense(items)
    leaves = 2 ** depth if depth is not None else _lists(items)
    model = BisectingKMeans(k=leaves, seed=seed, featuresCol="f").fit(_fit_rows(items, leaves).select(array_to_vector("vector").alias("f")))
    return _named(finish(_probe(queries, items, cut_lineage(_centres(items, model)), k, probes, query_id, item_id, True, target), k),
                  query_id, item_id)


def _lists(items: DataFrame) -> int:
    return max(1, math.ceil(math.sqrt(items.count())))


def _fit_rows(items: DataFrame, lists: int) -> DataFrame:
    """Rows to learn centres from: ROWS_A_LIST for each, chosen at random by seed; every item is placed afterwards."""
    n = items.count()
    return items if n <= ROWS_A_LIST * lists else items.sample(ROWS_A_LIST * lists / n, seed=7)


class Quantiser:
    """Product quantiser on rotated vectors: one code book per slice of dimensions."""

    def __init__(self, rotation, books):
        self.rotation, self.books = rotation, books

    def encode(self, vectors):
        import numpy as np
        x = np.stack([np.asarray(v, dtype=float) for v in vectors]) @ self.rotation
        codes, start = [], 0
        for book in self.books:
            part = x[:, start:start + book.shape[1]]
            start += book.shape[1]
            codes.append(np.argmax(part @ book.T - (book * book).sum(axis=1) / 2, axis=1))
        return np.stack(codes, axis=1)

    def coded(self, vectors):
        """The coded form of vectors, still rotated."""
        import numpy as np
        codes = self.encode(vectors)
        return np.concatenate([book[codes[:, j]] for j, book in enumerate(self.books)], axis=1)

    def decode(self, codes):
        import numpy as np
        return np.concatenate([book[codes[:, j]] for j, book in enumerate(self.books)], axis=1) @ self.rotation.T


def rotated_by(rotation):
    """A function of vector columns that multiplies by a matrix."""
    import numpy as np

    @F.pandas_udf("array<double>")
    def rotated(v: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(v.tolist()) @ rotation)) if len(v) else pd.Series([], dtype=object)
    return rotated


def fit_quantiser(items: DataFrame, dim: int, slices: int, codes: int, seed: int = 7, turns: int = 2) -> Quantiser:
    """Code books and a rotation that fit each other: starting from the main axes, the books are learned on the rotated vectors,
    then the rotation is set to the one that brings the vectors nearest to their coded form (from the sum of outer products,
    added up in the tasks), and so on for some turns."""
    import numpy as np
    vectors = cut_lineage(items.select(array_to_vector("vector").alias("f")))
    rotation = PCA(inputCol="f", outputCol="r", k=dim).fit(vectors).pc.toArray()
    slices = min(slices, dim)
    edges = [round(i * dim / slices) for i in range(slices + 1)]
    raw = vectors.select(vector_to_array("f").alias("v"))
    for turn in range(turns):
        turned = cut_lineage(raw.select(rotated_by(rotation)("v").alias("r")))
        books = []
        for a, b in zip(edges, edges[1:]):
            part = turned.select(array_to_vector(F.slice("r", a + 1, b - a)).alias("f"))
            books.append(np.stack(KMeans(k=codes, seed=seed, featuresCol="f", maxIter=10).fit(part).clusterCenters()))
        if turn + 1 < turns:
            own = Quantiser(rotation, books)

            def outer(batches):
                total = np.zeros((dim, dim))
                for x in batches:
                    v = np.stack(x["v"].tolist()) if len(x) else np.zeros((0, dim))
                    if len(v):
                        total += v.T @ own.coded(v)
                yield pd.DataFrame({"at": np.arange(dim * dim), "x": total.ravel()})
            sums = raw.mapInPandas(outer, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
            gram = np.zeros(dim * dim)
            for r in sums:  # dim x dim
                gram[r["at"]] = r["x"]
            u, _, w = np.linalg.svd(gram.reshape(dim, dim))
            rotation = u @ w
    return Quantiser(rotation, books)


def search_ivf_pq(queries: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str, nlist: int | None = None,
                  nprobe: int | None = None, slices: int = 16, codes: int = 16, rerank: int = 8, seed: int = 7, target: float = TARGET) -> DataFrame:
    """About sqrt(n) inverted lists by k-means, as many of them read as the target recall needs; items scored by their quantised
    form after a learned rotation, the best rerank * k of them exactly. Where these hold too few neighbours of the sampled queries,
    all items are scored exactly whose quantised form leaves room, by the error the sample shows, for one of the best k."""
    _need_dense(items)
    import numpy as np
    dim = items.select(F.size("vector")).first()[0]
    lists = nlist or _lists(items)
    learned = _fit_rows(items, lists)
    coarse = KMeans(k=lists, seed=seed, featuresCol="f", maxIter=10).fit(learned.select(array_to_vector("vector").alias("f")))
    quantiser = items.sparkSession.sparkContext.broadcast(fit_quantiser(learned, dim, slices, codes, seed))

    @F.pandas_udf("array<double>")
    def quantised(v):
        import pandas as pd
        q = quantiser.value
        return pd.Series(list(q.decode(q.encode(v.tolist())))) if len(v) else pd.Series([], dtype=object)
    coded = items.select(item_id, "vector", quantised("vector").alias("approx"))
    rough, centres = coded.select(item_id, F.col("approx").alias("vector")), cut_lineage(_centres(items, coarse))
    if _unique(queries, query_id) and _unique(items, item_id):
        # a task that reads all items has the final list of its queries, so no vector is joined to the pairs
        both, sample = coded.select(item_id, F.col("approx").alias("vector"), F.col("vector").alias("exact")), sampled_truth(queries, items, k, query_id, item_id)
        places, short = approximate_places(*sample, coded, query_id, item_id)
        first, margin = (k * rerank, None) if not len(places) or (places <= k * rerank).mean() >= RERANKED else (k, max(0.0, float(np.quantile(short, RERANKED))))
        return _named(finish(_probe(queries, items, centres, first, nprobe, query_id, item_id, True, target, both, k if margin is None else None, margin,
                                    sample), k), query_id, item_id)
    short = finish(_probe(queries, items, centres, k * rerank, nprobe, query_id, item_id, True, target, rough), k * rerank)
    pairs = _named(short, query_id, item_id).select(query_id, item_id) \
        .join(queries.select(query_id, F.col("vector").alias("_q")), query_id) \
        .join(items.select(item_id, F.col("vector").alias("_i")), item_id)
    exact = pairs.select(F.col(query_id).alias("q"), F.col(item_id).alias("i"), F.round(F.aggregate(F.zip_with(
        "_q", "_i", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x), 9).alias("score"))
    return _named(finish(exact, k), query_id, item_id)


def _unique(rows: DataFrame, key: str) -> bool:
    """True if every row has a key of its own, none NULL."""
    n, distinct = rows.agg(F.count(F.lit(1)), F.count_distinct(key)).first()
    return n == distinct


def flips(margins, bits: int, most: int):
    """Rows x most: which bits to flip (as a number), cheapest first, for rows of margins to the planes; the cost of a set of
    flipped bits is the sum of their squared margins. Sets of up to MAX_FLIPS bits are looked at."""
    import numpy as np
    sets = np.array([sum(1 << i for i in c) for n in range(min(MAX_FLIPS, bits) + 1) for c in combinations(range(bits), n)])
    member = (sets[:, None] >> np.arange(bits) & 1).astype(float)
    cost = np.square(margins) @ member.T
    if most < len(sets):
        # sort those only that can be among the cheapest, ties at the edge included
        near = np.argpartition(cost, most - 1, axis=1)[:, :most]
        edge = np.take_along_axis(cost, near, 1).max(axis=1)
        clear = (cost <= edge[:, None]).sum(axis=1) == most
        near = np.sort(near, axis=1)
        order = np.take_along_axis(near, np.argsort(np.take_along_axis(cost, near, 1), axis=1, kind="stable"), 1)
        order[~clear] = np.argsort(cost[~clear], axis=1, kind="stable")[:, :most]
        return sets[order]
    return sets[np.argsort(cost, axis=1, kind="stable")]


def search_lsh(queries: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str, tables: int = 8, bits: int | None = None,
               probes: int | None = None, seed: int = 7, target: float = TARGET) -> DataFrame:
    """Signs against fixed random planes, several tables of about sqrt(n) buckets. Items lie in one bucket of each table; a query
    visits its own bucket and those behind the planes it is nearest to, as many as the target recall needs; rows that meet are
    compared exactly."""
    _need_dense(items)
    import numpy as np
    dim = items.select(F.size("vector")).first()[0]
    bits = bits or max(2, min(24, round(math.log2(max(items.count(), 2)) / 2)))
    planes = np.random.default_rng(seed).normal(size=(dim, tables * bits))
    every = sum(math.comb(bits, n) for n in range(min(MAX_FLIPS, bits) + 1))

    def signs(v):
        m = (np.stack([np.asarray(x, dtype=float) for x in v]) @ planes).reshape(len(v), tables, bits)
        return m, ((m >= 0) * (1 << np.arange(bits))).sum(axis=2)

    def signature(most: int):
        @F.pandas_udf("array<bigint>")
        def buckets(v: pd.Series) -> pd.Series:
            if not len(v):
                return pd.Series([], dtype=object)
            return pd.Series([row for start in range(0, len(v), FLIP_ROWS) for row in visited(v[start:start + FLIP_ROWS], most)])
        return buckets

    def visited(v, most: int):
        m, own = signs(v)
        # the bucket of a row itself comes first and flips nothing
        around = flips(m.reshape(-1, bits), bits, most).reshape(len(v), tables, -1) if most > 1 else 0
        return list(((own[:, :, None] ^ around) + (np.arange(tables)[:, None] << bits)).reshape(len(v), -1).astype("int64"))

    if not _unique(items, item_id):
        # a match counts once, so rows that are the same must not crowd others out of the k best of a task
        items = items.dropDuplicates([item_id, "vector"])
    i = cut_lineage(items.select(F.explode(signature(1)("vector")).alias("b"), F.col(item_id).alias("i"), F.col("vector").alias("v")))
    if probes is None:
        few, truth = sampled_truth(queries, items, k, query_id, item_id)
        order = few.select(query_id, F.posexplode(signature(every)("vector")).alias("at", "b")).withColumn("place", F.pmod("at", F.lit(every)) + 1)
        met = truth.join(i.select(F.col("i").alias(item_id), "b"), item_id).join(order, [query_id, "b"], "left")
        probes = needed_places(met.groupBy(query_id, item_id).agg(F.min("place").alias("place")), target, every)
    q = _cells_of(dealt(queries).select(F.col(query_id).alias("q"), F.col("vector").alias("v"), signature(probes)("vector").alias("bs")))
    found = celled_topk(q, i, k, False).groupBy("q", "i").agg(F.max("score").alias("score"))
    return _named(finish(found, k), query_id, item_id)


SEARCH_FUNCTIONS = {"brute_force": search_brute_force, "cluster_pruning": search_cluster_pruning, "ivf_opq": search_ivf_pq,
                    "hkm": search_hkm, "lsh": search_lsh}


def embed(queries: DataFrame, items: DataFrame, query_id: str, item_id: str, query_text: str, item_text: str,
          embedding: str = "tf_idf", vector: str | None = None, dim: int = 16, **preparation) -> tuple[DataFrame, DataFrame]:
    """Unit vectors of both tables, written once. The weights and axes come from the catalogue alone."""
    _choice("embedding", embedding, EMBEDDINGS)
    if embedding == "tf_idf":
        words = preprocess(spread(items.select(item_id, item_text)), item_text, **preparation)
        if _unique(items, item_id):
            packed = packed_counts(words, item_id, "words")
            its = packed.select(item_id, F.explode("terms").alias("term"))
        else:
            packed, its = None, term_counts(words, item_id, "words")
        qs = term_counts(preprocess(spread(queries.select(query_id, query_text)), query_text, **preparation), query_id, "words")
        vocab = cut_lineage(vocabulary(its, items.select(F.count(F.lit(1))).scalar()))
        if packed is not None:
            found = packed_vectors(packed, item_id, vocab)
            release(items.sparkSession)
            return cut_lineage(tfidf_vectors(qs, query_id, vocab)), kept(found, "vectors")
        out = tfidf_vectors(qs, query_id, vocab), tfidf_vectors(its, item_id, vocab)
    elif vector is not None:
        out = dense_vectors(queries, query_id, vector), dense_vectors(items, item_id, vector)
    else:
        model = text_embedding_model(items, item_text, dim)
        out = (dense_vectors(text_embedding(queries, query_text, model=model), query_id, "sentence_vector"),
               dense_vectors(text_embedding(items, item_text, model=model), item_id, "sentence_vector"))
    return cut_lineage(out[0]), cut_lineage(out[1])


def similarity_predict(queries: DataFrame, items: DataFrame, query_id: str, item_id: str, query_text: str, item_text: str,
                       k: int = DEFAULT_TOP_K, true_id: str | None = None, embedding: str = "tf_idf",
                       search: str = "brute_force", **options) -> DataFrame:
    """Ranked matches per query, with the true item id next to them if it is known."""
    if not isinstance(k, int) or isinstance(k, bool) or k < 1:
        raise ValueError("k must be a positive integer")
    _choice("search", search, SEARCHES)
    qs, its = embed(queries, items, query_id, item_id, query_text, item_text, embedding, **options)
    found = SEARCH_FUNCTIONS[search](qs, its, k, query_id, item_id)
    return found.join(queries.select(query_id, true_id), query_id) if true_id else found


def fit_text_similarity(queries: DataFrame, items: DataFrame, query_id: str, item_id: str, query_text: str, item_text: str,
                        true_id: str, k: int = DEFAULT_TOP_K, metric: str = "accuracy_at_k",
                        grid: Sequence[tuple[str, str]] = tuple(DEFAULT_GRID), vector: str | None = None) -> DataFrame:
    """Leaderboard of (embedding, search) pairs; each vector kind is computed once for all its searches."""
    _choice("metric", metric, TEXT_SIMILARITY)
    rows, vectors = [], {}
    release(queries.sparkSession)
    for embedding, search in grid:
        _choice("search", search, SEARCHES)
        start = time.time()
        if embedding not in vectors:
            vectors[embedding] = embed(queries, items, query_id, item_id, query_text, item_text, embedding, vector)
            release(queries.sparkSession)
        found = SEARCH_FUNCTIONS[search](*vectors[embedding], k, query_id, item_id)
        score = retrieval_metrics(queries, found, query_id, item_id, "rank", true_id, k).first()
        found = None
        release(queries.sparkSession)
        rows.append((embedding, search, k, float(score["accuracy_at_k"]), float(score["mrr_at_k"]), time.time() - start))
    board = queries.sparkSession.createDataFrame(
        rows, "embedding string, search string, k int, accuracy_at_k double, mrr_at_k double, seconds double")
    return board.withColumn("best", F.col(metric) == F.lit(max(r[3 if metric == "accuracy_at_k" else 4] for r in rows)))
