"""Exact top-k by dot product between two tables of vectors, with bounded tasks.

Vectors are array<double> (dense) or struct<terms: array<string>, weights: array<double>> (sparse). Ids are unique.
Spark spreads the rows; numpy multiplies one block of queries with one batch of items and keeps k per query, so no
task emits or holds all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lumenfold.operators.profile import top_per_group
from lumenfold.session import cut_lineage

BLOCK_ROWS = 2048         # queries sent to all tasks, or multiplied at once
SHARED_ITEMS = 50_000     # items sent to all tasks
BLOCK_CELLS = 4_000_000   # numbers in a table sent to all tasks
CELL_ROWS = 20_000        # rows of either side in one stored block
ITEM_ROWS = 4096          # items in one stored block, however large cells may be
ITEM_PARTS = 6            # parts of the items; each query keeps k of every part
TASKS_A_CORE = 4          # tasks a core that keep all cores busy to the end
SMALL_ROWS = 512          # query rows that are not worth another task
SPARSE_ROWS = 500         # sparse vectors unpacked at once
BATCH_CELLS = 4_000_000   # scores held at once
PAIRS = 100_000           # pairs scored again at once
SCORE_DIGITS = 9


def is_sparse(df: DataFrame, vector: str) -> bool:
    return isinstance(df.schema[vector].dataType, T.StructType)


def vector_length(df: DataFrame, vector: str) -> Column:
    return F.size(F.col(f"{vector}.terms")) if is_sparse(df, vector) else F.size(vector)


def block_fits(df: DataFrame, vector: str, max_rows: int) -> bool:
    """True if the vectors are few and short enough to sit in every task."""
    size = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(vector_length(df, vector)).alias("c")).first()
    return size["n"] <= max_rows and (size["c"] or 0) <= BLOCK_CELLS


class Block:
    """A few vectors in id order, ready to be multiplied with batches of others."""

    def __init__(self, ids, vectors, sparse: bool):
        import numpy as np
        ids = np.asarray(ids)
        order = np.argsort(ids, kind="stable")
        self.ids, self.sparse, vectors = ids[order], sparse, [vectors[i] for i in order]
        self.batch = max(16, BATCH_CELLS // max(1, len(ids)))
        if not sparse:
            self.matrix = np.stack([np.asarray(v, dtype=float) for v in vectors]) if vectors else np.zeros((0, 0))
            return
        postings = {}
        for i, v in enumerate(vectors):
            for t, w in zip(v["terms"], v["weights"]):
                rows, weights = postings.setdefault(t, ([], []))
                rows.append(i)
                weights.append(w)
        self.postings = {t: (np.asarray(r), np.asarray(w)) for t, (r, w) in postings.items()}

    def scores(self, vectors):
        """len(ids) x len(vectors) dot products, rounded so that equal vectors tie exactly."""
        import numpy as np
        if not self.sparse:
            return np.round(self.matrix @ np.stack([np.asarray(v, dtype=float) for v in vectors]).T, SCORE_DIGITS)
        out = np.zeros((len(self.ids), len(vectors)))
        for j, v in enumerate(vectors):
            hits = [(self.postings[t], w) for t, w in zip(v["terms"], v["weights"]) if t in self.postings]
            if hits:
                rows = np.concatenate([r for (r, _), _ in hits])
                parts = np.concatenate([p * w for (_, p), w in hits])
                out[:, j] = np.bincount(rows, weights=parts, minlength=len(self.ids))
        return np.round(out, SCORE_DIGITS)


class Running:
    """k best items seen so far for each row of a query block."""

    def __init__(self, block: Block, k: int):
        self.block, self.k, self.ids, self.best = block, k, None, None

    def add(self, ids, vectors) -> None:
        import numpy as np
        scores = self.block.scores(vectors)
        rows = best_k(scores, ids, self.k)
        if self.best is None:
            self.ids, self.best = [ids[r] for r in rows], [scores[n][r] for n, r in enumerate(rows)]
            return
        for n, r in enumerate(rows):
            if len(self.best[n]) == self.k and len(r) and scores[n][r[0]] < self.best[n][-1]:
                continue
            s, i = np.concatenate([self.best[n], scores[n][r]]), np.concatenate([self.ids[n], ids[r]])
            order = np.lexsort((i, -s))[:self.k]
            self.best[n], self.ids[n] = s[order], i[order]

    def frame(self, columns):
        import numpy as np
        if self.best is None:
            return _frame([], [], [], columns)
        return _frame([np.repeat(self.block.ids[n:n + 1], len(r)) for n, r in enumerate(self.ids)], self.ids, self.best, columns)


def best_k(scores, ids, k: int):
    """Per row of scores: positions of the k best, by score descending then id ascending."""
    import numpy as np
    if k == 1 and len(ids) and (ids[:-1] <= ids[1:]).all():
        return scores.argmax(axis=1)[:, None]
    out = []
    for row in scores:
        keep = np.arange(len(row))
        if len(row) > k:
            keep = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
        out.append(keep[np.lexsort((ids[keep], -row[keep]))[:k]])
    return out


def _frame(qid, iid, score, columns):
    import numpy as np
    import pandas as pd
    return pd.DataFrame(dict(zip(columns, (np.concatenate(qid) if qid else [], np.concatenate(iid) if iid else [],
                                           np.concatenate(score) if score else []))))


def _scan_items(shared, columns, kinds, k):
    """Walk over the items of a partition with the shared query block; k running best per query."""
    def run(batches):
        block = shared.value
        best, size = Running(block, k), min(block.batch, SPARSE_ROWS) if block.sparse else block.batch
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                best.add(_ids(part.column("i")), _vectors(part.column("v"), block.sparse))
        yield from _arrow(best.frame(columns), columns, kinds)
    return run


def _arrow(frame, columns, kinds):
    import pyarrow as pa
    if len(frame):
        yield pa.RecordBatch.from_arrays([pa.array(frame[c], kind, from_pandas=True) for c, kind in zip(columns, kinds)], columns)


def _kinds(schema):
    from pyspark.sql.pandas.types import to_arrow_type
    return [to_arrow_type(f.dataType) for f in schema]


def _scan_queries(shared, columns, k):
    """Walk over the queries of a partition with the shared item block; results are final per query."""
    def run(batches):
        import numpy as np
        block = shared.value
        for b in batches:
            for start in range(0, len(b), block.batch):
                part = b.iloc[start:start + block.batch]
                scores, ids = block.scores(part["v"].tolist()).T, part["q"].to_numpy()
                rows = best_k(scores, block.ids, k)
                yield _frame([np.repeat(ids[n:n + 1], len(r)) for n, r in enumerate(rows)], [block.ids[r] for r in rows],
                             [scores[n][r] for n, r in enumerate(rows)], columns)
    return run


def _share_block(df: DataFrame, id_name: str, sparse: bool):
    rows = df.collect()  # bounded by block_fits
    return df.sparkSession.sparkContext.broadcast(Block([r[id_name] for r in rows], [r["v"] for r in rows], sparse))


def _schema(q: DataFrame, i: DataFrame) -> T.StructType:
    return T.StructType([T.StructField("q", q.schema["q"].dataType), T.StructField("i", i.schema["i"].dataType),
                         T.StructField("score", T.DoubleType())])


def dealt(rows: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Query rows in even partitions, for all cores and of CELL_ROWS at most. counted: a cheaper frame of as many rows."""
    n = (rows if counted is None else counted).count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(cores, -(-n // SMALL_ROWS)), -(-n // CELL_ROWS)))


def _ids(column):
    return column.to_pandas().to_numpy() if column.null_count else column.to_numpy(zero_copy_only=False)


def _vectors(column, sparse: bool):
    """The vectors of an Arrow column without nulls: a list, or a matrix of one row each."""
    import numpy as np
    if sparse:
        return column.to_pylist()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("vectors differ in length")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(lengths), lengths[0]) if len(lengths) else np.zeros((0, 0))


def _joined(parts, sparse: bool):
    import numpy as np
    return [v for part in parts for v in part] if sparse else np.concatenate(parts)


def _packed_items(sparse, refined):
    """Rows (b, i, v) in order of b as pickled blocks (b, ids, vectors), numbered within the partition; refined: with the vectors e."""
    def run(batches):
        import pickle

        import pyarrow as pa
        size, number = min(CELL_ROWS, ITEM_ROWS), 0
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                packed = [_ids(part.column("b")), _ids(part.column("i")), _vectors(part.column("v"), sparse)]
                packed += [_vectors(part.column("e"), False)] if refined else []
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([pickle.dumps(packed, 5)], pa.binary())], ["no", "its"])
                number += 1
    return run


def _packed_queries(sparse, k):
    """Rows (b, q, v) as pickled blocks (ids, vectors, cells, where their rows start, rows), cells in order, numbered within the partition."""
    def run(batches):
        import pickle

        import numpy as np
        import pyarrow as pa
        ids, vectors, cells, rows, last, count, size, number = [], [], [], [], None, 0, 0, 0

        def block():
            b, at = np.concatenate(cells), np.concatenate(rows)
            order = np.argsort(b, kind="stable")
            own, starts = np.unique(b[order], return_index=True)
            packed = np.concatenate(ids), _joined(vectors, sparse), own, np.append(starts, len(b)), at[order].astype(np.int32)
            for x in (ids, vectors, cells, rows):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([len(packed[0])], pa.int32()),
                                               pa.array([pickle.dumps(packed, 5)], pa.binary())], ["at", "n", "qs"])
        for batch in batches:
            first = batch.column("v").is_valid().to_numpy(zero_copy_only=False)
            q, b, own = _ids(batch.column("q")), _ids(batch.column("b")), _vectors(batch.column("v").drop_null(), sparse)
            cuts, seen = [0, *np.flatnonzero(first)[::CELL_ROWS], len(q)], 0
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if first[start] and (count >= CELL_ROWS or size >= BLOCK_CELLS):
                    yield block()
                    count, size, number = 0, 0, number + 1
                here = first[start:end]
                mine, at = q[start:end][here], count - 1 + np.cumsum(here)
                # a row's vector is the last one before it, which must be of the same query
                owner = np.concatenate([last if count else q[:1], mine])[np.cumsum(here)]
                if at[0] < 0 or ((owner != q[start:end]) & ((owner == owner) | (q[start:end] == q[start:end]))).any():
                    raise ValueError("a query has no vector")
                n, last = len(mine), owner[-1:]
                new, seen = own[seen:seen + n], seen + n
                if n:
                    ids.append(mine)
                    vectors.append(new)
                count += n
                cells.append(b[start:end])
                rows.append(at)
                size += end - start + n * k + (sum(len(v["terms"]) for v in new) if sparse else new.size)
        if ids:
            yield block()
    return run


class Asked:
    """A block of queries and the k best items that each of them has met in its cells.

    Dense vectors are compared in single precision first; what may be among the k best by the error that this can have is
    scored in double precision. Such pairs wait until there are enough of them to be sorted at once.
    """

    def __init__(self, packed: bytes, k: int, sparse: bool, margin: float | None = None):
        import pickle

        import numpy as np
        self.ids, self.vectors, self.cells, self.starts, self.rows = pickle.loads(packed)
        self.k, self.sparse, self.margin, self.last, self.waiting = k, sparse, margin, (None, None), 0
        self.worst, self.pairs = np.full(len(self.ids), -np.inf), []
        if not sparse:
            self.short, self.length = self.vectors.astype(np.float32), _longest(self.vectors)

    def asked(self, first, rows, exact: bool):
        """The rows asked, ready to be multiplied; those asked last are kept at hand."""
        import numpy as np
        if self.last[0] != (first, exact):
            self.last = (first, exact), (Block(np.arange(len(rows)), [self.vectors[r] for r in rows], True) if self.sparse else
                                         (self.vectors if exact else self.short)[rows])
        return self.last[1]

    def meet(self, cells, ids, vectors, refined=None) -> None:
        """Score items, in order of their cells, with the queries that ask these cells."""
        import numpy as np
        if not len(ids):
            return
        exact, slack, margin, shown, sharp = self.sparse, 0.0, 0.0, vectors, None
        if not self.sparse:
            length = max(_longest(vectors), _longest(refined) if refined is not None else 0.0)
            reach, exact = self.length * length, not (self.length < 1e15 and length < 1e15)  # too long for single precision, or not a number
            slack = (vectors.shape[1] + 4) * 2.0 ** (-52 if exact else -23) * (reach if reach < np.inf else 0.0) + 10.0 ** -SCORE_DIGITS
            shown = vectors if exact else vectors.astype(np.float32)
        if self.margin is not None:  # the second vectors alone decide
            vectors, refined, margin, sharp = refined, None, self.margin, refined if exact else refined.astype(np.float32)
        edges = [0, *(np.flatnonzero(cells[1:] != cells[:-1]) + 1), len(cells)]
        for start, end, place in zip(edges, edges[1:], np.searchsorted(self.cells, cells[edges[:-1]])):
            if place == len(self.cells) or self.cells[place] != cells[start]:
                continue
            for first in range(self.starts[place], self.starts[place + 1], BLOCK_ROWS):
                rows = self.rows[first:min(self.starts[place + 1], first + BLOCK_ROWS)]
                step = max(16, BATCH_CELLS // len(rows))
                for s in range(start, end, step):
                    part = slice(s, min(end, s + step))
                    block = self.asked(first, rows, exact)
                    scores = block.scores(vectors[part]) if self.sparse else block @ shown[part].T
                    if exact and not self.sparse:
                        scores[np.isnan(scores)] = -np.inf
                    if sharp is not None:
                        self.take_by_both(rows, block, scores, slack, margin, cells[start], ids[part], vectors[part], sharp[part])
                        continue
                    near, floor = self.near(rows, scores, slack)
                    r, c = np.divmod(np.flatnonzero(scores[near] >= floor[near, None]), len(ids[part]))
                    self.take(rows, near[r], c, scores, cells[start], ids[part], vectors[part], None if refined is None else refined[part])

    def near(self, rows, scores, slack):
        """The rows that may have met one of their k best, and the score from which that holds."""
        import numpy as np
        floor, n = self.worst[rows] - slack, scores.shape[1]
        new = np.flatnonzero(floor == -np.inf)
        if len(new) and n > self.k:
            floor[new] = np.partition(scores[new], n - self.k, axis=1)[:, n - self.k] - 2 * slack
        return np.flatnonzero(scores.max(axis=1) >= floor), floor

    def take_by_both(self, rows, block, scores, slack, margin, cell, ids, vectors, sharp) -> None:
        """Where scores are approximate: what they leave by the margin is compared by the vectors that decide (sharp: in single precision)."""
        import numpy as np
        near, floor = self.near(rows, scores, slack + margin)
        second = block[near] @ sharp.T
        second[~((scores[near] >= floor[near, None]) & (second >= -np.inf))] = -np.inf
        left, floor = self.near(rows[near], second, slack)
        r, c = np.divmod(np.flatnonzero((second[left] >= floor[left, None]) & (second[left] > -np.inf)), len(ids))
        self.take(rows, near[left[r]], c, scores, cell, ids, vectors, None)

    def take(self, rows, r, c, scores, cell, ids, vectors, refined) -> None:
        """Score the pairs (r, c) of rows and items and note those that may be among the k best."""
        import numpy as np
        for s in range(0, len(r), PAIRS):
            at, its = r[s:s + PAIRS], c[s:s + PAIRS]
            own = rows[at]
            score = scores[at, its] if self.sparse else _dots(self.vectors[own], vectors[its])
            keep = np.flatnonzero(score >= self.worst[own])
            own, its = own[keep], its[keep]
            pairs = [own, score[keep], ids[its], np.full(len(keep), cell)]
            self.pairs.append(pairs if refined is None else [*pairs, _dots(self.vectors[own], refined[its])])
            self.waiting += len(keep)
            if self.waiting >= max(len(self.ids) * self.k, PAIRS):
                self.settle()

    def settle(self) -> None:
        """Keep k pairs of each query; a pair that another cell gave with the same score is the same pair again."""
        import numpy as np
        if not self.waiting:
            return
        pairs = [np.concatenate(x) for x in zip(*self.pairs)]
        order = np.lexsort((pairs[2], -pairs[1], pairs[0]))  # stable: of equal pairs the one met first leads
        rows, scores, ids, cells = (x[order] for x in pairs[:4])
        again = np.append(False, (rows[1:] == rows[:-1]) & (scores[1:] == scores[:-1]) & (ids[1:] == ids[:-1]))
        if again.any():
            leader = np.maximum.accumulate(np.where(again, 0, np.arange(len(rows))))
            own = np.flatnonzero(cells == cells[leader])
            order, rows, scores = order[own], rows[own], scores[own]
        head = np.append(True, rows[1:] != rows[:-1])
        place = np.arange(len(rows)) - np.maximum.accumulate(np.where(head, np.arange(len(rows)), 0))
        self.worst[rows[place == self.k - 1]] = scores[place == self.k - 1]
        order = order[place < self.k]
        self.pairs, self.waiting = [[x[order] for x in pairs]], 0

    def frame(self, columns, best=None):
        """The pairs kept; of those with a second score the best so many by that."""
        import numpy as np
        import pandas as pd
        self.settle()
        if not self.pairs:
            return _frame([], [], [], columns)
        rows, scores, ids, _, *refined = self.pairs[0]
        if refined:
            order = np.lexsort((ids, -refined[0], rows))
            rows, scores, ids = rows[order], refined[0][order], ids[order]
            first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
            own = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows)))) < best
            rows, scores, ids = rows[own], scores[own], ids[own]
        return pd.DataFrame(dict(zip(columns, (self.ids[rows], ids, scores))))


def _longest(vectors) -> float:
    import numpy as np
    return float(np.sqrt(np.einsum("ij,ij->i", vectors, vectors).max())) if len(vectors) else 0.0


def _dots(a, b):
    """Dot products row by row, rounded; the same two vectors give the same number wherever they stand."""
    import numpy as np
    return np.round((a * b).sum(axis=1), SCORE_DIGITS)


def _scan_cells(shared, columns, kinds, k, sparse, margin):
    """Walk over the items (b, i, v) of a partition with the shared query blocks, some rows at a time."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        blocks = [Asked(packed, k, sparse, margin) for packed in shared.value]
        size = SPARSE_ROWS if sparse else ITEM_ROWS
        for part in (batch.slice(start, size) for batch in batches for start in range(0, batch.num_rows, size)):
            part = part.take(pa.array(np.argsort(_ids(part.column("b")), kind="stable")))
            e = [_vectors(part.column("e"), False)] if "e" in part.schema.names else []
            for block in blocks:
                block.meet(_ids(part.column("b")), _ids(part.column("i")), _vectors(part.column("v"), sparse), *e)
        for block in blocks:
            yield from _arrow(block.frame(columns), columns, kinds)
    return run


def in_cells(rows: DataFrame, centres: DataFrame, row_id: str, centre: str) -> DataFrame | None:
    """(b, i, v): each row with its nearest centre, as exact_topk ranks them, worked out where it stands; None if centres do not fit into tasks."""
    sparse = is_sparse(rows, "vector")
    c = centres.select(F.col(centre).alias("i"), F.col("vector").alias("v"))
    if not block_fits(c, "v", SHARED_ITEMS):
        return None
    shared = _share_block(c, "i", sparse)
    if not len(shared.value.ids):
        return None
    own = rows.select(F.col(row_id).alias("i"), F.col("vector").alias("v"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        block = shared.value
        size = min(block.batch, SPARSE_ROWS) if sparse else block.batch
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                place = block.scores(part.column("v").to_pylist()).argmax(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.asarray(block.ids)[place], kind), *part.columns], ["b", *part.schema.names])
    from pyspark.sql.pandas.types import to_arrow_type
    kind = to_arrow_type(c.schema["i"].dataType)
    return own.mapInArrow(run, T.StructType([T.StructField("b", c.schema["i"].dataType), *own.schema.fields]))


def celled_topk(queries: DataFrame, items: DataFrame, k: int, sparse: bool, best: int | None = None, margin: float | None = None,
                stored: bool = True) -> DataFrame:
    """Frames (b, q, v) and (b, i, v): of the items in a query's buckets the k best (q, i, score), per part of the items.

    A query may name its buckets in rows that follow each other, of which only the first holds the vector.
    No vector is copied into buckets or cells: both sides are packed into blocks and stored once, the items in order of
    their buckets and in ITEM_PARTS even parts. A task reads one part of the queries and one or more parts of the items, all of
    them where the queries alone keep the cores busy, and keeps k per query, so what is shuffled and written grows with the
    rows, however they fall on the buckets. A block holds at most about CELL_ROWS rows or BLOCK_CELLS numbers, so a crowded
    bucket is cut up. best, margin: items come with a second vector e, which gives the score. With best, a query's k best by v
    are scored so and the so many best of them given; then a task reads all items. With margin, the k best by e are given of
    all items whose score by v is up to the margin below the k-th.
    Queries few enough to be sent to all tasks meet the items where these stand; else items that are not stored are.
    """
    schema, columns, refined = _schema(queries, items), ["q", "i", "score"], best is not None or margin is not None
    qs = cut_lineage(queries.select("b", "q", "v").mapInArrow(_packed_queries(sparse, k), "at int, n int, qs binary"))
    own = items.select("b", "i", "v", *(["e"] if refined else []))
    size = qs.agg(F.sum("n").alias("n"), F.sum(F.octet_length("qs")).alias("bytes")).first()
    if best is None and (size["n"] or 0) <= BLOCK_ROWS and (size["bytes"] or 0) <= 8 * BLOCK_CELLS:
        shared = queries.sparkSession.sparkContext.broadcast([r["qs"] for r in qs.collect()])
        return own.mapInArrow(_scan_cells(shared, columns, _kinds(schema), k, sparse, margin), schema)
    own = (own if stored else cut_lineage(own)).repartitionByRange(ITEM_PARTS, "b", F.xxhash64("i")).sortWithinPartitions("b")
    its = cut_lineage(own.mapInArrow(_packed_items(sparse, refined), "no int, its binary"))
    tasks = TASKS_A_CORE * queries.sparkSession.sparkContext.defaultParallelism
    parts = 1 if best else max(1, min(ITEM_PARTS, -(-tasks // max(1, qs.rdd.getNumPartitions()))))

    def cell(batches):
        import pickle
        asked = {}
        for batch in batches:
            for packed, at, one in zip(batch["qs"], batch["at"], batch["its"]):
                if at not in asked:
                    asked[at] = Asked(packed, k, sparse, margin)
                asked[at].meet(*pickle.loads(one))
        for at in list(asked):
            yield asked.pop(at).frame(columns, best)
    # the hint asks for the product of partitions: items streamed, one part of the queries held, no shuffle;
    # a block of queries is handed over with the first block of each part of the items only
    both = its.coalesce(parts).hint("shuffle_replicate_nl").crossJoin(qs)
    return both.select("its", "at", F.when(F.col("no") == 0, F.col("qs")).alias("qs")).mapInPandas(cell, schema)


def nearest_lists(rows: DataFrame, centres: DataFrame, k: int, row_id: str, centre: str) -> DataFrame:
    """(row id, vectors, bs): the vectors of each id and its k nearest centres, as exact_topk ranks them. Only rows are shuffled if the centres fit into tasks."""
    sparse = is_sparse(rows, "vector")
    own = rows.groupBy(row_id).agg(F.collect_list("vector").alias("vectors"))
    i = centres.select(F.col(centre).alias("i"), F.col("vector").alias("v"))
    if not block_fits(i, "v", SHARED_ITEMS):
        found = exact_topk(rows, centres, k, row_id, centre)
        return own.join(found.groupBy(row_id).agg(F.collect_list(centre).alias("bs")), row_id)
    shared, kind = _share_block(i, "i", sparse), i.schema["i"].dataType

    def run(batches):
        import numpy as np
        import pyarrow as pa
        block = shared.value
        for batch in batches:
            lists = batch.column("vectors").to_pylist()
            flat, found = [v for vs in lists for v in vs], []
            for start in range(0, len(flat), block.batch):
                scores = block.scores(flat[start:start + block.batch]).T
                found += [(x[r], block.ids[r]) for x, r in zip(scores, best_k(scores, block.ids, k))]
            out, at = [], 0
            for vs in lists:
                s, b = (np.concatenate(x) if len(vs) > 1 else x[0] for x in zip(*found[at:at + len(vs)])) if vs else ([], [])
                out.append(list(b if len(vs) < 2 else b[np.lexsort((b, -s))[:k]]))
                at += len(vs)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, listed)], [*batch.schema.names, "bs"])
    from pyspark.sql.pandas.types import to_arrow_type
    listed = to_arrow_type(T.ArrayType(kind))
    return own.mapInArrow(run, T.StructType([*own.schema.fields, T.StructField("bs", T.ArrayType(kind))]))


def finish(found: DataFrame, k: int) -> DataFrame:
    return top_per_group(found, ["q"], [F.desc("score"), F.asc("i")], k, "rank")


def exact_topk(queries: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str, query_vector: str = "vector",
               item_vector: str = "vector") -> DataFrame:
    """(query id, item id, score, rank): the k items of largest dot product, ties by item id.

    Few queries: their block goes to all tasks and the items are scanned once. Few items: the other way round.
    Both large: stored blocks of queries meet stored blocks of items.
    """
    if not isinstance(k, int) or isinstance(k, bool) or k < 1:
        raise ValueError("k must be a positive integer")
    sparse = is_sparse(queries, query_vector)
    q = queries.select(F.col(query_id).alias("q"), F.col(query_vector).alias("v"))
    i = items.select(F.col(item_id).alias("i"), F.col(item_vector).alias("v"))
    columns, schema = ["q", "i", "score"], _schema(q, i)
    if block_fits(q, "v", BLOCK_ROWS):
        block = _share_block(q, "q", sparse)
        out = finish(i.mapInArrow(_scan_items(block, columns, _kinds(schema), k), schema), k) if len(block.value.ids) else \
            finish(q.sparkSession.createDataFrame([], schema), k)
    elif block_fits(i, "v", SHARED_ITEMS):
        found = q.mapInPandas(_scan_queries(_share_block(i, "i", sparse), columns, k), schema)
        out = finish(found, k)
    else:
        out = finish(celled_topk(dealt(q).withColumn("b", F.lit(0)), i.withColumn("b", F.lit(0)), k, sparse), k)
    return out.select(F.col("q").alias(query_id), F.col("i").alias(item_id), "score", "rank")
