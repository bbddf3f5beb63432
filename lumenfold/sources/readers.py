"""Loading tables: CSV, Parquet, archives, JDBC, images, inventories and snapshots."""

from __future__ import annotations

import csv
import io
import zipfile

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lumenfold.functions.skew import spread

PARQUET_MAGIC = b"PAR1"
ORIGINS = ("pipeline_output", "pipeline_intermediate_file")
REMOTE_SCHEMES = {"s3": "s3a", "gcs": "gs", "ftp": "ftp", "sftp": "sftp", "file": "file"}


def check_one_source(**sources) -> str:
    """Name of the only source given; none or several is an error."""
    given = [k for k, v in sources.items() if v is not None]
    if len(given) != 1:
        raise ValueError(f"give exactly one of {sorted(sources)}, got {given}")
    return given[0]


def check_origin(origin: str | None) -> None:
    if origin is not None and origin not in ORIGINS:
        raise ValueError(f"origin must be one of {ORIGINS}")


def load_csv(spark: SparkSession, path: str, sep: str = ",", schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header line. Give a schema for large files: inferring types reads the data twice."""
    reader = spark.read.option("header", True).option("sep", sep)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def load_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def sniff_formats(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame:
    """(path, format) by the first four bytes of each file. Tasks open the files themselves, so nothing else is read."""
    files = spread(spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(directory).select("path"))

    def peek(batches):
        from pyarrow import fs
        for b in batches:
            kinds = []
            for path in b["path"]:
                store, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1).replace("file:/", "file:///", 1)
                                                     if not path.startswith("file:///") else path)
                with store.open_input_file(name) as f:
                    kinds.append("parquet" if f.read(len(PARQUET_MAGIC)) == PARQUET_MAGIC else "csv")
            yield b[["path"]].assign(format=kinds)
    return files.mapInPandas(peek, "path string, format string")


def load_directory(spark: SparkSession, directory: str, sep: str = ",", schema: str | None = None) -> DataFrame:
    """A folder mixing Parquet and CSV files as one table."""
    formats = sniff_formats(spark, directory).groupBy("format").agg(F.collect_list("path").alias("paths")).collect()
    parts = [load_parquet(spark, r["paths"]) if r["format"] == "parquet" else load_csv(spark, r["paths"], sep, schema)
             for r in sorted(formats, key=lambda r: r["format"])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def load_zip_csv(spark: SparkSession, glob: str, schema: str, sep: str = ",", encoding: str = "utf-8") -> DataFrame:
    """First member of every archive, with the archive path; archives are read in parallel, members as streams."""
    kinds = T.StructType.fromDDL(schema)
    names = kinds.fieldNames()
    text = T.StructType([T.StructField("archive", T.StringType())] + [T.StructField(n, T.StringType()) for n in names])

    def unpack(batches):
        import pandas as pd
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as box, box.open(box.namelist()[0]) as member:
                    rows = csv.reader(io.TextIOWrapper(member, encoding, newline=""), delimiter=sep)
                    header = next(rows)
                    order = [header.index(n) for n in names]
                    block = []
                    for r in rows:
                        block.append([path] + [r[i] if r[i] != "" else None for i in order])
                        if len(block) == 10_000:
                            yield pd.DataFrame(block, columns=text.fieldNames())
                            block = []
                    yield pd.DataFrame(block, columns=text.fieldNames())

    files = spark.read.format("binaryFile").load(glob).select("path", "content")
    rows = files.mapInPandas(unpack, text)
    return rows.select("archive", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds.fields])


def _jdbc(spark: SparkSession, url: str, driver: str | None, options: dict | None):
    reader = spark.read.format("jdbc").option("url", url).options(**(options or {}))
    return reader.option("driver", driver) if driver else reader


def jdbc_table(spark: SparkSession, url: str, table: str, database: str | None = None, driver: str | None = None,
               split: tuple[str, int, int, int] | None = None, options: dict | None = None) -> DataFrame:
    """A database table; split = (column, lowest, highest, readers) reads it in parallel ranges."""
    reader = _jdbc(spark, url, driver, options).option("dbtable", f"{database}.{table}" if database else table)
    if split:
        column, low, high, readers = split
        reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=readers)
    return reader.load()


def jdbc_query(spark: SparkSession, url: str, request: str, driver: str | None = None,
               options: dict | None = None) -> DataFrame:
    return _jdbc(spark, url, driver, options).option("query", request).load()


def remote_uri(kind: str, path: str, bucket: str | None = None, host: str | None = None, port: int | None = None) -> str:
    """Hadoop address of a remote file: bucket + path for object stores, host + path for ftp and sftp."""
    if kind not in REMOTE_SCHEMES:
        raise ValueError(f"kind must be one of {sorted(REMOTE_SCHEMES)}")
    authority = bucket if kind in ("s3", "gcs") else "" if kind == "file" else host
    if authority is None:
        raise ValueError("object stores need a bucket, ftp and sftp a host")
    return f"{REMOTE_SCHEMES[kind]}://{authority}{f':{port}' if port else ''}/{path.lstrip('/')}"


def load_remote(spark: SparkSession, kind: str, path: str, file_format: str = "csv", sep: str = ",", schema: str | None = None,
                **place) -> DataFrame:
    uri = remote_uri(kind, path, **place)
    return load_parquet(spark, uri) if file_format == "parquet" else load_csv(spark, uri, sep, schema)


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files below root: path, size, time, extension. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", F.col("length").alias("size"), "modificationTime",
                        F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("extension"))


def inventory_totals(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("extension").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("bytes"))


def image_folder(spark: SparkSession, directory: str) -> DataFrame:
    """Images with their file name and decoded pixels."""
    images = spark.read.format("image").option("dropInvalid", True).load(directory)
    return images.select(F.element_at(F.split("image.origin", "/"), -1).alias("filename"), "image")


def read_snapshot(spark: SparkSession, path: str, at: str | None = None) -> DataFrame:
    """The newest snapshot at or before a time (or the newest of all); other partitions are not read."""
    rows = spark.read.parquet(path)
    times = rows.select("snapshot_ts").distinct()
    if at is not None:
        times = times.where(F.col("snapshot_ts") <= F.lit(at).cast(rows.schema["snapshot_ts"].dataType))
    newest = times.agg(F.max("snapshot_ts")).first()[0]
    if newest is None:
        raise ValueError("no snapshot at that time")
    return rows.where(F.col("snapshot_ts") == F.lit(newest)).drop("snapshot_ts")


