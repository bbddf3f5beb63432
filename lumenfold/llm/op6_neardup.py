"""MinHash near-duplicates by fast similarity sketching, banding and exact verification.

Sketch: t bins are filled in rounds. In round i every shingle x falls into the bin given by a hash h_i(x) and carries a
second hash as its value; a bin keeps the smallest value of the first round that reached it. From round t on, the bin of
a round is fixed, so after 2t rounds every bin of a non-empty set is filled. Two sets agree in a bin with a probability
equal to their similarity, with the concentration of independent bins, and a set of n shingles costs about t log t + n.

A document is linked with another if 100 * |intersection| >= 75 * |union| of their shingle sets. Candidates share a band
of the sketch (64 bands of 6 bins: a pair at the threshold is missed with probability 4e-6); each is confirmed on the full
sets. First every member is compared with its bucket's smallest id; then only buckets that this left in different components
are looked at again, by sketches in bounded blocks, and the pairs that may be links are confirmed as well.

Cases: null, empty or blank text has an empty set and no links. Rows that repeat a doc_id are one document (their links
are joined). A null doc_id has a null component and is kept. Extra columns are not read. Ties go to the smallest doc_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lumenfold.llm.common import components, stored, table
from lumenfold.llm.wordhash import mix, pieces

BANDS, WIDTH, SHINGLE = 64, 6, 5
CHUNK, BLOCK, LIKELY = 64, 256, 0.66
#: Rows sketched together: short texts fill a piece with many rows, and each has BANDS * WIDTH bins in several arrays.
SKETCHED = 1024
SKETCH_SCHEMA = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"


def shingle_sets(piece, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(flat distinct shingle hashes, offsets per row): k-word windows, or the whole sequence of a shorter text."""
    at, hashes = piece.windows(k)
    bounds = np.searchsorted(at, piece.first)
    sets = []
    for r, n in enumerate(piece.counts):
        if n >= k:
            sets.append(np.unique(hashes[bounds[r]:bounds[r + 1]]))
        elif n:
            own, h = piece.hashes[piece.first[r]:piece.first[r + 1]], np.uint64([n])
            for j in range(n):
                h = mix(h ^ own[j:j + 1])
            sets.append(h)
        else:
            sets.append(np.empty(0, np.uint64))
    return np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])


def sketch(flat: np.ndarray, offsets: np.ndarray, t: int) -> np.ndarray:
    """t bins for each set (rows x t); a set without elements keeps zeros."""
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), t), np.uint64)
    active = np.flatnonzero(sizes)
    owner = np.repeat(np.arange(len(active)), sizes[active])
    bins = np.zeros((len(active), t), np.uint64)
    none = np.uint64(np.iinfo(np.uint64).max)
    for i in range(2 * t):
        h = mix(flat ^ mix(np.uint64([i + 1])))
        place = (h >> np.uint64(48)).astype(np.int64) * t >> 16 if i < t else i - t
        found = np.full(bins.size, none)
        np.minimum.at(found, owner * t + place, mix(h + np.uint64(i)) | np.uint64(1))
        found = found.reshape(bins.shape)
        take = (bins == 0) & (found != none)
        bins[take] = found[take]
        full = (bins != 0).all(1)
        if full.any():
            out[active[full]] = bins[full]
            rest = ~full
            keep = rest[owner]
            flat, owner = flat[keep], (np.cumsum(rest) - 1)[owner[keep]]
            active, bins = active[rest], bins[rest]
            if not len(active):
                break
    return out


def sketches(batches):
    t = BANDS * WIDTH
    for batch in batches:
        for p in pieces(batch.column("text"), lower=True, rows=SKETCHED):
            flat, offsets = shingle_sets(p)
            sizes = np.diff(offsets)
            bins = sketch(flat, offsets, t).reshape(p.rows, BANDS, WIDTH)
            band = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (p.rows, 1))
            for j in range(WIDTH):
                band = mix(band * np.uint64(31) + bins[:, :, j])
            total = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(flat ^ s), dtype=np.uint64)])
                     for s in np.uint64([[11], [23]])]
            k1, k2 = (x[offsets[1:]] - x[offsets[:-1]] for x in total)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]).astype(np.int32),
                                             pa.array(band[sizes > 0].ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(p.row, p.rows), pa.array(sizes.astype(np.int64)), pa.array(k1.view(np.int64)),
                 pa.array(k2.view(np.int64)), lists], ["doc_id", "n_shingles", "k1", "k2", "bands"])


def _confirm(group: pa.Table) -> pa.Table:
    """Links between the leader's texts and those of a bounded number of members."""
    text = group.column("text").combine_chunks()
    ids, lead = group.column("id").to_numpy(), group.column("leader").to_numpy()
    first = group.column("is_leader").to_numpy(zero_copy_only=False)
    order = np.argsort(~first, kind="stable")
    own, found = [], set()
    for p in pieces(text.take(pa.array(order)), lower=True):
        flat, offsets = shingle_sets(p)
        for r in range(p.rows):
            row, s = order[p.row + r], flat[offsets[r]:offsets[r + 1]]
            if first[row]:
                own.append(s)
                continue
            for x in own:
                both = len(np.intersect1d(x, s, assume_unique=True))
                if both and 100 * both >= 75 * (len(x) + len(s) - both):
                    found.add(int(ids[row]))
    found = sorted(found)
    return pa.table({"a": pa.array([int(lead[0])] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (leader, member) whose full sets are similar enough, as (a, b).

    A leader's members come in chunks of about CHUNK, each with one copy of the leader's text, so no group grows with the
    number of members and a member's text moves once per leader.
    """
    sizes = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    members = pairs.join(sizes, "leader").withColumn("chunk", F.pmod(F.xxhash64("member"), "chunks"))
    leaders = sizes.select("leader", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    rows = members.join(texts, F.col("member") == F.col("doc_id")).select(
        "leader", "chunk", F.lit(False).alias("is_leader"), F.col("member").alias("id"), "text")
    heads = leaders.join(texts, F.col("leader") == F.col("doc_id")).select(
        "leader", "chunk", F.lit(True).alias("is_leader"), F.col("leader").alias("id"), "text")
    return rows.unionByName(heads).groupBy("leader", "chunk").applyInArrow(_confirm, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs; see the module's docstring."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketched = stored(source.mapInArrow(sketches, SKETCH_SCHEMA), "sketches")
    filled = sketched.where("n_shingles > 0 and doc_id is not null")
    classes = stored(filled.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep")), "classes")
    heads = filled.join(classes, (filled.doc_id == classes.rep) & (filled.k1 == classes.k1) & (filled.k2 == classes.k2),
                        "left_semi").dropDuplicates(["doc_id", "k1", "k2"])
    bands = heads.select(F.posexplode("bands").alias("no", "band"), F.col("doc_id").alias("rep"), F.col("n_shingles").cast("int").alias("n"))
    buckets = bands.groupBy("band").agg(F.min("rep").alias("leader"), F.max("rep").alias("other"), F.min_by("n", "rep").alias("n_leader"))
    shared = stored(bands.join(buckets.where("leader <> other").drop("other"), "band"), "shared")

    def close(x: str, y: str) -> F.Column:
        return 100 * F.least(x, y).cast("long") >= 75 * F.greatest(x, y).cast("long")

    pairs = stored(shared.where((F.col("rep") != F.col("leader")) & close("n", "n_leader"))
                   .select("leader", F.col("rep").alias("member")).distinct(), "pairs")
    wanted = stored(shared.select(F.col("rep").alias("doc_id")).distinct(), "wanted")
    texts = stored(source.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]), "texts")
    twice = _several_texts(filled, classes)
    links = stored(confirmed(pairs, texts).union(twice), "links")
    rest = _unresolved(shared, components(links), pairs, texts)
    if rest.limit(1).count():
        links = links.union(stored(confirmed(rest, texts), "links"))
    joined = components(links).withColumnRenamed("node", "rep")
    of_class = classes.join(joined, "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("component"))
    out = sketched.join(of_class, ["k1", "k2"], "left")
    # an empty set shares its key with no class; neither does a null doc_id count for one
    component = F.when((F.col("n_shingles") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _several_texts(filled: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges between the classes of a doc_id that stands on rows with different sets."""
    own = filled.groupBy("doc_id").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi")).where("lo <> hi").select("doc_id")
    reps = filled.join(own, "doc_id", "left_semi").join(classes, ["k1", "k2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    return reps.where("a <> b").distinct()


def signatures(batches):
    """One byte of each bin of the sketch."""
    for batch in batches:
        for p in pieces(batch.column("text"), lower=True, rows=SKETCHED):
            bins = (mix(sketch(*shingle_sets(p), BANDS * WIDTH)) & np.uint64(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(p.row, p.rows), pa.array([x.tobytes() for x in bins], pa.binary())],
                                             ["rep", "signature"])


def _likely(block: pa.Table) -> pa.Table:
    """Pairs of a bounded block in different components whose sketches agree in LIKELY of the bins or more."""
    rep, comp, n = (block.column(x).to_numpy() for x in ("rep", "component", "n"))
    chunk, low, high = block.column("chunk").to_numpy(), block.column("low")[0].as_py(), block.column("high")[0].as_py()
    no = block.column("no")[0].as_py()
    bins = np.frombuffer(b"".join(block.column("signature").to_pylist()), np.uint8).reshape(len(rep), -1)
    kinds, counts = np.unique(comp, return_counts=True)
    common = kinds[counts.argmax()]
    a, b = [], []
    for i in np.flatnonzero(comp != common):
        other = (comp != comp[i]) & ((comp == common) | (rep > rep[i])) & (100 * np.minimum(n, n[i]) >= 75 * np.maximum(n, n[i]))
        if low != high:
            other &= chunk != chunk[i]
        j = np.flatnonzero(other)
        same = bins[j] == bins[i]
        # a pair that shares several bands is reported by the first of them
        shared = same.reshape(len(j), BANDS, WIDTH).all(2)
        j = j[(same.sum(1) >= LIKELY * bins.shape[1]) & ~shared[:, :no].any(1)]
        a.extend(np.minimum(rep[j], rep[i]))
        b.extend(np.maximum(rep[j], rep[i]))
    return pa.table({"leader": pa.array(a, pa.int64()), "member": pa.array(b, pa.int64())})


def _unresolved(shared: DataFrame, comps: DataFrame, done: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (leader, member) of a bucket in different components that may be links and that no comparison has seen yet.

    Only buckets that span several components are read. Their members are compared by their sketches in blocks of bounded
    size; a pair at the threshold agrees in fewer than LIKELY of its bins with a probability of 2e-5.
    """
    comp = comps.withColumnRenamed("node", "rep")
    rows = shared.join(comp, "rep", "left").select("band", "no", "rep", "n", F.coalesce("component", "rep").alias("component"))
    mixed = rows.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                     F.ceil(F.count(F.lit(1)) / BLOCK).alias("chunks")).where("lo <> hi").select("band", "chunks")
    rows = stored(rows.join(mixed, "band").withColumn("chunk", F.pmod(F.xxhash64("rep"), "chunks")), "mixed")
    members = texts.join(rows.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    signed = stored(members.select("doc_id", "text").mapInArrow(signatures, "rep long, signature binary"), "signatures")
    placed = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    placed = placed.join(signed, "rep").select("band", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
                                               "no", "chunk", "rep", "n", "component", "signature")
    pairs = placed.groupBy("band", "low", "high").applyInArrow(_likely, "leader long, member long").distinct()
    return stored(pairs.join(done, ["leader", "member"], "left_anti"), "rest")


def op6(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op6_near_duplicates": op6}
