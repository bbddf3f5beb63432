"""Balanced label propagation: documents into shards of nearly equal bytes, linked ones together.

Linked documents (here: equal texts; a link table may hold any groups) start in the shards of their hashes. In each round a
join gives every document the bytes that its group has in each shard; a document moves to the shard with most of them if
the shard's quota, its capacity less what it holds, has room. Movers are admitted by running totals of hash buckets, so no
quota is exceeded and no group is gathered anywhere. Unlinked documents then fill the rest of each capacity.

Law `bytes`: with C = all bytes / shards, all linked documents of up to C bytes take part in the propagation, whatever their size; the driver
sets quotas. Of what no link holds, documents above C / 64 (fewer than 64 a shard) are dealt out by the driver, largest first, all others
follow running totals, those above C / 1024 before the small ones, so shards end within about C / 1024 of each other where the
documents allow it.

Cases: a null text has size 1 and is linked with other null texts like any equal ones; repeated rows are rows of their own;
a null doc_id is placed like any other; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumenfold.llm.common import stored, table

SHARDS, ROUNDS = 16, 4
BIG, MEDIUM = 64, 1024
BUCKET_ROWS = 20_000


def _bucket(n: int, *keys) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n))


def running(df: DataFrame, by: list[str], value: str, buckets: int, order: list[str]) -> DataFrame:
    """df with `before`: the sum of value over the earlier rows of the same `by`, in the order of bucket and then `order`.

    Bucket totals are summed up over the buckets, rows only within their bucket; by has few values.
    """
    df = df.withColumn("_bucket", _bucket(buckets, *order))
    keys = [*by, "_bucket"]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    up = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)], F.coalesce(F.sum("_sum").over(up), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_inner", F.coalesce(F.sum(value).over(within), F.lit(0)))
    cond = [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)]
    return rows.join(offsets, cond).select(*[c for c in df.columns if c != "_bucket"], (F.col("_inner") + F.col("_offset")).alias("before"))


def propagate(linked: DataFrame, quota: dict[int, int], rounds: int = ROUNDS, buckets: int = 64) -> DataFrame:
    """linked(grp, size, doc_id, shard): move documents to their group's main shard within the quotas (bytes a shard may hold)."""
    for _ in range(rounds):
        held = {r.shard: int(r.n) for r in linked.groupBy("shard").agg(F.sum("size").alias("n")).collect()}
        weight = linked.groupBy("grp", "shard").agg(F.sum("size").alias("w"))
        main = weight.groupBy("grp").agg(F.max(F.struct("w", (-F.col("shard")).alias("s"))).alias("m")).select("grp", (-F.col("m.s")).cast("int").alias("to"))
        rows = linked.join(main, "grp").withColumn("sub", _bucket(64, "doc_id")).withColumn("cell", _bucket(1024, "grp"))
        asks = rows.where("to <> shard").groupBy("to", "cell", "sub").agg(F.sum("size").alias("n"))
        room = F.create_map(*[x for k, q in quota.items() for x in (F.lit(k), F.lit(max(0, q - held.get(k, 0))))])
        up = Window.partitionBy("to").orderBy("cell", "sub").rowsBetween(Window.unboundedPreceding, 0)
        admitted = asks.withColumn("total", F.sum("n").over(up)).where(F.col("total") <= room[F.col("to")]).select(
            "to", "cell", "sub", F.lit(True).alias("admitted"))
        new = rows.join(admitted, ["to", "cell", "sub"], "left").select(
            "doc_id", "crc", "grp", "size", F.when(F.col("admitted"), F.col("to")).otherwise(F.col("shard")).cast("int").alias("shard"),
            (F.col("admitted") & (F.col("to") != F.col("shard"))).alias("moved"))
        new = stored(new, "shards")
        linked = new.drop("moved")
        if not new.where("moved").limit(1).count():
            break
    return linked


def fill(pool: DataFrame, room: dict[int, int], buckets: int) -> DataFrame:
    """Lay the pool on a line and cut it in proportion to the shards' room (bytes): a shard column, exact but for one row a cut."""
    total = pool.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    share = {k: max(0, v) for k, v in room.items()}
    scale = total / max(1, sum(share.values()))
    bounds, at = [], 0.0
    for k, v in share.items():
        at += v * scale
        bounds.append((k, at))
    rows = running(pool, [], "size", buckets, ["doc_id", "crc"])
    shard = None
    middle = F.col("before") + F.col("size") / 2
    for k, end in bounds[:-1]:
        shard = (F if shard is None else shard).when(middle < end, k)
    return rows.withColumn("shard", (shard.otherwise(bounds[-1][0]) if shard is not None else F.lit(bounds[-1][0])).cast("int")).drop("before")


def _sums(df: DataFrame, shards: int) -> dict[int, int]:
    got = {r.shard: int(r.n) for r in df.groupBy("shard").agg(F.sum("size").alias("n")).collect()}
    return {k: got.get(k, 0) for k in range(shards)}


def balanced_shards(docs: DataFrame, shards: int = SHARDS, links: DataFrame | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of docs.

    links(doc_id, grp) may name the group of a document; without it, groups are the documents with equal texts.
    """
    spark, text = docs.sparkSession, F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"), F.xxhash64(text, F.length(text)).alias("grp"))
    if links is not None:
        named = links.groupBy("doc_id").agg(F.min(F.xxhash64("grp")).alias("named"))
        rows = rows.join(named, "doc_id", "left").select("doc_id", "size", "crc", F.coalesce("named", F.xxhash64("doc_id", "crc")).alias("grp"))
    rows = stored(rows, "sizes")
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    capacity, buckets = total / shards, max(16, n // BUCKET_ROWS)
    columns = ["doc_id", "crc", "grp", "size", "shard"]
    groups = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("grp")
    linked = stored(rows.join(groups, "grp", "left_semi").withColumn("shard", _bucket(shards, "doc_id", "crc").cast("int")), "linked")
    linked = propagate(linked, dict.fromkeys(range(shards), int(capacity)))
    # a first placement by hash can exceed a quota: the surplus goes back to the pool
    ahead = running(linked, ["shard"], "size", buckets, ["grp", "doc_id", "crc"])
    ahead = stored(ahead.withColumn("stays", F.col("before") + F.col("size") <= capacity), "linked")
    kept = ahead.where("stays").select(*columns)
    pool = rows.join(groups, "grp", "left_anti").select("doc_id", "crc", "grp", "size").union(
        ahead.where("not stays").select("doc_id", "crc", "grp", "size"))
    pool = stored(pool, "pool")
    # what no link holds is dealt out: fewer than shards * BIG large rows by their size, a bounded list, then the rest
    load, placed, whole = _sums(kept, shards), [], {}
    for r in pool.where(F.col("size") > capacity / BIG).collect():
        whole.setdefault(r.grp, []).append(r)
    for members in sorted(whole.values(), key=lambda g: (-sum(r["size"] for r in g), g[0].grp)):
        k, left = min(load, key=lambda s: (load[s], s)), sum(r["size"] for r in members)
        for r in sorted(members, key=lambda r: (r.doc_id is None, r.doc_id or 0)):
            if load[k] + min(left, capacity) > capacity and load[k] + r["size"] > capacity:
                k = min(load, key=lambda s: (load[s], s))
            load[k], left = load[k] + r["size"], left - r["size"]
            placed.append((r.doc_id, r.crc, r.grp, r["size"], k))
    parts = [spark.createDataFrame(placed, "doc_id long, crc long, grp long, size long, shard int"), kept]
    pool = pool.where(F.col("size") <= capacity / BIG)
    room = {k: capacity - v for k, v in load.items()}
    for chosen in (pool.where(F.col("size") > capacity / MEDIUM), pool.where(F.col("size") <= capacity / MEDIUM)):
        part = stored(fill(chosen, room, buckets), "filled")
        room = {k: room[k] - v for k, v in _sums(part, shards).items()}
        parts.append(part.select(*columns))
    done = parts[0].select(*columns)
    for p in parts[1:]:
        done = done.union(p)
    done = running(done.withColumn("one", F.lit(1).cast("long")), ["shard"], "one", buckets, ["doc_id", "crc"])
    return done.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
                       F.col("before").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op4(spark, sf_dir) -> DataFrame:
    return balanced_shards(table(spark, sf_dir, "documents"))


QUERIES = {"op4_balanced_shards": op4}
