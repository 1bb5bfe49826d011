"""Byte-capped parts, FeatureCollections by splits and the one scan of the report reader."""

import json

import pytest
from pyspark.sql import functions as F

from citybeat.operators import reports
from citybeat.sources.files import (
    parts_manifest,
    read_csv,
    read_feature_collection,
    to_geojson_features,
    write_csv_parts_by_size,
    write_feature_collection,
)


def test_parts_keep_a_byte_cap_and_their_order(spark, tmp_path):
    # widths from 1 to 400 characters, quoted and multi-byte values, a null folder
    text = F.concat(F.repeat(F.lit("\u00e9,"), (F.col("id") * 7 % 200).cast("int")), F.lit('"'))
    df = spark.range(5000).select("id", text.alias("t"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).cast("int").alias("g"))
    cap = write_csv_parts_by_size(df, str(tmp_path / "p"), 0.02, ["g"])
    files = sorted((tmp_path / "p").glob("g=*/part-*.csv"))
    sizes = [f.stat().st_size for f in files]
    assert max(sizes) <= cap == 20971
    assert len(files) < 1.1 * sum(sizes) / cap + 4  # parts are nearly full
    man = parts_manifest(spark, str(tmp_path / "p"), "id long, t string", ["g"]).collect()
    assert sorted(r.bytes for r in man) == sorted(sizes) and sum(r.rows for r in man) == 5000
    back = read_csv(spark, str(tmp_path / "p"), "id long, t string, g int")
    assert back.count() == 5000 and back.select("id").distinct().count() == 5000
    for g in ("1", "2", "__HIVE_DEFAULT_PARTITION__"):
        ids = [int(line.split(",")[0]) for f in files if f.parent.name == f"g={g}" for line in f.read_text().splitlines()[1:]]
        assert ids == sorted(ids) and len(ids) in (1666, 1667)


def test_parts_of_nothing_and_of_wide_rows(spark, tmp_path):
    df = spark.range(3).select("id", F.repeat(F.lit("x"), 5000).alias("t"))
    write_csv_parts_by_size(df.limit(0), str(tmp_path / "none"), 0.01)
    assert read_csv(spark, str(tmp_path / "none"), "id long, t string").count() == 0
    with pytest.raises(ValueError):
        write_csv_parts_by_size(df, str(tmp_path / "wide"), 0.001)


FEATURES = [
    {"type": "Feature", "geometry": {"type": "Point", "coordinates": [i / 8, -i / 4]}, "properties": {"id": i, "type": "Feature", "name": n}}
    for i, n in enumerate(["a", "Feature", 'say "Feature", [{"type": "x', "\u00e9\u00e9 }]},{", "", None] * 60)
]


@pytest.mark.parametrize("indent", [None, 2])
def test_one_document_is_read_by_splits(spark, tmp_path, indent):
    feats = [{"id": i, **f} if i % 2 else f for i, f in enumerate(FEATURES)]
    feats[7] = {"type": "Feature", "geometry": {"type": "Point", "coordinates": []}, "properties": {"id": 7}}
    feats[9] = {"type": "Feature", "geometry": None, "properties": None}
    doc = tmp_path / "doc.geojson"
    doc.write_text(json.dumps({"type": "FeatureCollection", "features": feats, "bbox": [0, 0, 1, 1]}, indent=indent, ensure_ascii=False))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        # splits of about six features, so that most cut one
        spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert spark.read.text(str(doc)).rdd.getNumPartitions() > 20
        got = read_feature_collection(spark, str(doc), "struct<id:long,type:string,name:string>").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = [(f["geometry"]["coordinates"], f["properties"]) for i, f in enumerate(feats) if i not in (7, 9)]
    assert sorted((r.properties.id, r.lng, r.lat, r.properties.type, r.properties.name) for r in got if r.properties.id not in (None,)) == sorted(
        ((p["id"], c[0], c[1], p["type"], p["name"]) for c, p in want), key=lambda t: t[0]
    )


def test_parts_of_a_collection_make_one_document(spark, tmp_path):
    rows = spark.range(500).select("id", (F.col("id") / 8).alias("x"), F.lit("Feature").alias("name")).repartition(5)
    feats = to_geojson_features(rows, "Point", F.array("x", "x"), ["id", "name"], keep=["id"])
    write_feature_collection(feats, str(tmp_path / "c"), "id")
    parts = sorted((tmp_path / "c").glob("part-*"))
    assert len(parts) > 3
    doc = json.loads("".join(p.read_text() for p in parts))
    assert [f["properties"]["id"] for f in doc["features"]] == list(range(500))
    back = read_feature_collection(spark, str(tmp_path / "c"), "struct<id:long,name:string>")
    assert sorted((r.properties.id, r.lng, r.lat) for r in back.collect()) == [(i, i / 8, i / 8) for i in range(500)]
    write_feature_collection(feats.limit(0), str(tmp_path / "none"), "id")
    none = json.loads("".join(p.read_text() for p in sorted((tmp_path / "none").glob("part-*"))))
    assert none == {"type": "FeatureCollection", "features": []}
    assert read_feature_collection(spark, str(tmp_path / "none"), "struct<id:long>").count() == 0


def test_all_sections_in_one_scan_of_the_cells(spark, tmp_path):
    spark.createDataFrame([("f", "s", 0, 0, "v")], "file string, sheet string, row int, col int, value string").write.parquet(str(tmp_path / "c"))
    out = reports.tidy_reports(spark.read.parquet(str(tmp_path / "c")))
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert out.count() == 0


def test_sections_meet_and_sheets_repeat_cells(spark):
    # no blank row between the blocks: the first body runs on to the end of the sheet
    cells = [
        ("a", "s", 0, 0, "Borough - Rejects"), ("a", "s", 1, 0, "Reject Reason"), ("a", "s", 1, 1, "new york"),
        ("a", "s", 2, 0, "Glare"), ("a", "s", 2, 1, "1"), ("a", "s", 2, 2, "5"), ("a", "s", 2, 1, "x"),
        ("a", "s", 3, 0, "Community Board - Rejects"), ("a", "s", 4, 0, "Reject Reason"), ("a", "s", 4, 1, "B  1"),
        ("a", "s", 5, 0, "Dark"), ("a", "s", 5, 1, "2"), ("a", "s", 6, 0, None), ("a", "s", 7, 0, "Late"), ("a", "s", 7, 1, "3"),
        (None, "s", 0, 0, "Borough - Rejects"), ("b", None, 1, 1, "9"),
    ]
    df = spark.createDataFrame(cells, "file string, sheet string, row int, col int, value string")
    out = reports.tidy_reports(df)
    assert sorted((r.section, r.reject_reason, r.borough, r.community_board, r["count"]) for r in out.collect()) == [
        ("borough", "Dark", "New York", "", 2), ("borough", "Glare", "New York", "", 1), ("community_board", "Dark", "", "B 1", 2),
    ]


def test_slices_of_capped_parts_grow_with_the_table(spark, tmp_path, monkeypatch):
    """One task sorts one slice, and a slice holds a fixed number of bytes whatever the table."""
    from citybeat.sources import files

    monkeypatch.setattr(files, "SLICE_BYTES", 500)
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("g"))
    asked = []
    real = type(df).repartitionByRange
    monkeypatch.setattr(type(df), "repartitionByRange", lambda self, n, *k: asked.append(n) or real(self, n, *k))
    cap = write_csv_parts_by_size(df, str(tmp_path / "p"), 0.005, ["g"])
    assert asked[0] > int(spark.conf.get("spark.sql.shuffle.partitions"))
    back = spark.read.option("header", True).schema("id long").csv(str(tmp_path / "p"))
    assert sorted(r.id for r in back.collect()) == list(range(3000))
    found = parts_manifest(spark, str(tmp_path / "p"), "id long", ["g"]).collect()
    assert sum(r.rows for r in found) == 3000 and max(r.bytes for r in found) <= cap
