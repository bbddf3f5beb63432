"""Readers and writers on files made here."""

import struct
import zipfile
import zlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lumenfold.operators import features as E
from lumenfold.operators.joins import join_images
from lumenfold.sources import readers as R, writers as K


def png(path, rgb, width=2, height=3):
    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))
    raw = b"".join(b"\x00" + bytes(rgb) * width for _ in range(height))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
                     + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_csv_round_trip(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;x\n1;2.5\n2;\n")
    df = R.load_csv(spark, str(tmp_path / "a.csv"), ";")
    assert df.dtypes == [("id", "int"), ("x", "double")] and df.count() == 2
    assert R.load_csv(spark, str(tmp_path / "a.csv"), ";", "id bigint, x string").dtypes[0] == ("id", "bigint")


def test_mixed_folder(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "p"))
    part = next(p for p in (tmp_path / "p").iterdir() if p.name.endswith(".parquet"))
    (folder / "one.dat").write_bytes(part.read_bytes())
    (folder / "two.dat").write_text("id\n7\n")
    kinds = {r["path"].rsplit("/", 1)[1]: r["format"] for r in R.sniff_formats(spark, str(folder)).collect()}
    assert kinds == {"one.dat": "parquet", "two.dat": "csv"}
    assert sorted(r["id"] for r in R.load_directory(spark, str(folder), schema="id bigint").collect()) == [0, 1, 2, 7]


def test_zip_first_member(spark, tmp_path):
    for n in (1, 2):
        with zipfile.ZipFile(tmp_path / f"z{n}.zip", "w") as z:
            z.writestr("first.csv", f'name,id\n"a, quoted",{n}\n,{n}0\n')
            z.writestr("second.csv", "id\n99\n")
    rows = R.load_zip_csv(spark, str(tmp_path / "*.zip"), "id int, name string").orderBy("id").collect()
    assert [(r["id"], r["name"]) for r in rows] == [(1, "a, quoted"), (2, "a, quoted"), (10, None), (20, None)]


def test_inventory(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text("x")
    (tmp_path / "sub" / "b.CSV").write_text("xyz")
    totals = R.inventory_totals(R.file_inventory(spark, str(tmp_path))).collect()
    assert [tuple(r) for r in totals] == [("csv", 2, 4)]


def test_source_rules(spark, tmp_path):
    assert R.check_one_source(file="a", frame=None) == "file"
    for given in ({"file": None, "frame": None}, {"file": "a", "frame": "b"}):
        with pytest.raises(ValueError):
            R.check_one_source(**given)
    with pytest.raises(ValueError):
        R.check_origin("elsewhere")
    assert R.remote_uri("s3", "/a/b.csv", bucket="box") == "s3a://box/a/b.csv"
    assert R.remote_uri("ftp", "b.csv", host="h", port=21) == "ftp://h:21/b.csv"
    with pytest.raises(ValueError):
        R.remote_uri("s3", "a")
    (tmp_path / "r.csv").write_text("x\n1\n")
    assert R.load_remote(spark, "file", str(tmp_path / "r.csv")).count() == 1


def test_images(spark, tmp_path):
    for name, rgb in (("a.png", (10, 20, 30)), ("b.png", (0, 0, 0)), ("c.png", (200, 100, 50))):
        png(tmp_path / name, rgb)
    images = R.image_folder(spark, str(tmp_path))
    measures = {r["filename"]: r for r in E.image_features(images).collect()}
    a = measures["a.png"]
    assert (a["width"], a["height"], a["channels"], a["bytes"]) == (2, 3, 3, 18)
    assert a["channel_mean"] == [30.0, 20.0, 10.0] and a["channel_std"] == [0.0, 0.0, 0.0]
    labels = spark.createDataFrame([("a.png", "cat"), ("x.png", "dog")], "filename string, label string")
    joined, missing = join_images(labels, images, "filename")
    assert joined.count() == 2 and [r["filename"] for r in missing.collect()] == ["x.png"]


def test_local_numbers(spark, tmp_path):
    df = spark.createDataFrame([(1, 1234567.25), (2, -0.5), (3, None), (4, 100.0)], "id int, x double")
    K.write_csv(df, str(tmp_path / "out"), separator=";", decimal=",", thousands=" ", encoding="ISO-8859-1")
    back = spark.read.option("header", True).option("sep", ";").csv(str(tmp_path / "out")).orderBy("id").collect()
    assert [r["x"] for r in back] == ["1 234 567,25", "-0,5", None, "100"]


def test_modes(spark, tmp_path):
    df, path = spark.range(2), str(tmp_path / "d")
    K.write_dataset(df, path)
    with pytest.raises(Exception, match="exists"):
        K.write_dataset(df, path)
    K.write_dataset(spark.range(5), path, mode="replace")
    assert spark.read.parquet(path).count() == 5
    stamped = K.write_dataset(df, path, mode="timestamp")
    assert stamped.startswith(path + "_") and spark.read.parquet(stamped).count() == 2
    for mode in ("append", "other"):
        with pytest.raises(ValueError):
            K.write_dataset(df, path, mode=mode)
    with pytest.raises(ValueError):
        K.check_mode("safe", is_table=True)
    with pytest.raises(ValueError):
        K.write_dataset(df, path, "xls")
    packed = K.write_dataset(df, str(tmp_path / "z"), "zip")
    assert spark.read.option("header", True).csv(packed).count() == 2


def test_prediction_export_and_log(spark, tmp_path):
    target = K.export_prediction(spark.range(3), str(tmp_path / "p"), "deployment")
    assert spark.read.parquet(target).select("prediction_type").distinct().collect() == [("deployment",)]
    with pytest.raises(ValueError):
        K.export_prediction(spark.range(3), str(tmp_path / "q"), "other")
    K.export_log(spark, str(tmp_path / "log"), "a", target, 3)
    K.export_log(spark, str(tmp_path / "log"), "b", target, 0, "failed")
    assert [(r["n_rows"], r["status"]) for r in K.list_exports(spark, str(tmp_path / "log"), "a").collect()] == [(3, "done")]


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "s")
    K.write_snapshot(spark.range(1), path, datetime(2024, 1, 1))
    K.write_snapshot(spark.range(2), path, datetime(2024, 2, 1))
    K.write_snapshot(spark.range(3), path, datetime(2024, 2, 1))
    assert R.read_snapshot(spark, path).count() == 3
    assert R.read_snapshot(spark, path, "2024-01-15").count() == 1
    with pytest.raises(ValueError):
        R.read_snapshot(spark, path, "2023-01-01")
    scan = R.read_snapshot(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_ts" in scan
