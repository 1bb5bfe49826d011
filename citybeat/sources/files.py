"""File sources and sinks.

All reads and writes are Spark's own: the driver only lists paths.  Outputs
go to the location the caller names (on a cluster: shared storage).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citybeat.session import ensure_checkpoint_dir


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` (file, folder or glob) matches at least one file."""
    try:
        return bool(spark.read.format("binaryFile").load(path).select("path").take(1))
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def write_parts_manifest(spark: SparkSession, parts_dir: str, base_name: str, manifest_path: str) -> None:
    """Write ``{"base": base_name, "parts": [...]}`` for the CSV parts under
    ``parts_dir`` (names relative to it, sorted) as a JSON document (S8)."""
    root = parts_dir.rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(F.regexp_extract("path", r"^.*?" + root.split("/")[-1] + r"/(.*)$", 1).alias("rel"))
    )
    doc = files.agg(
        F.to_json(F.struct(F.lit(base_name).alias("base"), F.array_sort(F.collect_list("rel")).alias("parts"))).alias("value")
    )
    doc.coalesce(1).write.mode("overwrite").text(manifest_path)


def read_parts_manifest(spark: SparkSession, manifest_path: str) -> tuple[str, list[str]]:
    """(base, parts) of a manifest written by ``write_parts_manifest``."""
    row = spark.read.schema("base string, parts array<string>").json(manifest_path).first()
    return row.base, list(row.parts)


def resolve_whole_or_parts(
    spark: SparkSession, whole: str, part_patterns: Sequence[str] = (), manifest: str | None = None, parts_dir: str | None = None
) -> list[str]:
    """The single file when it exists; else the parts a manifest lists
    (relative to ``parts_dir``); else every file matching the part patterns,
    sorted by name (S4)."""
    if path_exists(spark, whole):
        return [whole]
    if manifest and path_exists(spark, manifest):
        _, parts = read_parts_manifest(spark, manifest)
        base = (parts_dir or whole.rsplit("/", 1)[0]).rstrip("/")
        return [f"{base}/{p}" for p in parts]
    found: list[str] = []
    for pattern in part_patterns:
        if path_exists(spark, pattern):
            rows = spark.read.format("binaryFile").load(pattern).select("path").collect()  # names only
            found.extend(r.path for r in rows)
    if not found:
        raise FileNotFoundError(f"none of {whole} or {list(part_patterns)} exist")
    return sorted(set(found))


def read_csv(spark: SparkSession, paths: Sequence[str] | str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """CSV with an explicit schema: no inference pass, ids stay strings (S3).

    Several paths are read as one DataFrame, which is the concatenation of
    the parts (X1)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(paths)


def write_csv_parts(df: DataFrame, path: str, max_records: int, partition_by: Sequence[str] = ()) -> None:
    """CSV parts with a header each, at most ``max_records`` rows per file,
    optionally in ``col=value`` folders (S7, S8)."""
    w = df.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", max_records)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


#: CSV bytes in a slice of ``write_csv_parts_by_size``: what one task sorts.
SLICE_BYTES = 8 * 1024 * 1024


def write_csv_parts_by_size(
    df: DataFrame, path: str, max_mb: float, partition_by: Sequence[str] = (), order_by: Sequence[str] = ()
) -> int:
    """Ordered CSV parts, none larger than ``max_mb`` megabytes; returns that cap in bytes.

    Every row's bytes are those of its CSV line.  Rows are range-sliced on
    (``partition_by``, ``order_by``, the other columns), as many slices as there
    are ``SLICE_BYTES``, so that a task sorts no more when the table grows;
    running sums inside a slice and the sums of the slices before it give each row its byte offset in
    its folder, and the offset its part.  A part takes the rows that start in
    one stretch of (cap - header - widest row) bytes, so it cannot pass the cap.
    One task writes one part.  The driver sees the widest row and the number of
    parts.  A row that does not fit a part with its header is an error; an empty
    table gives an empty folder of parts.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cap = int(max_mb * 1024 * 1024)
    data = [c for c in df.columns if c not in partition_by]
    header = len(",".join(data).encode()) + 2 * len(data) + 1  # names may be quoted
    first = [*partition_by, *order_by]
    keys = [F.col(c) for c in [*first, *[c for c in df.columns if c not in first]]]
    sized = df.withColumn("__bytes", F.octet_length(F.to_csv(F.struct(*[F.col(c) for c in data]))) + 1)
    total = sized.agg(F.sum("__bytes")).first()[0] or 0
    n_slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // SLICE_BYTES))
    sliced = (
        sized.repartitionByRange(n_slices, *keys)
        .withColumn("__slice", F.spark_partition_id())
        .checkpoint()  # a slice number must not change between the two reads
    )
    sums = sliced.groupBy("__slice", *partition_by).agg(F.sum("__bytes").alias("__sum"), F.max("__bytes").alias("__widest"))
    widest = sums.agg(F.max("__widest")).first()[0]
    if widest is None:
        write_csv_parts(df, path, cap, partition_by)
        return cap
    stretch = cap - header - int(widest)
    if stretch < 1:
        raise ValueError(f"a row of {widest} bytes does not fit a part of {cap} bytes")
    folder = Window.partitionBy(*partition_by)
    ahead = folder.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    # one row a slice and folder: small whatever the rows are
    sums = sums.withColumns(
        {
            "__ahead": F.coalesce(F.sum("__sum").over(ahead), F.lit(0)),
            "__parts": F.floor((F.sum("__sum").over(folder) - 1) / stretch) + 1,
            "__nth": F.row_number().over(folder.orderBy("__slice")),
        }
    )
    up_to = Window.orderBy(*partition_by, "__slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.sum(F.when(F.col("__nth") == 1, F.col("__parts")).otherwise(0)).over(up_to)
    sums = sums.withColumn("__opened", opened).checkpoint()
    n_parts = int(sums.agg(F.max("__opened")).first()[0])
    at = sums.select(
        F.col("__slice").alias("__s"), *[F.col(c).alias(f"__f{i}") for i, c in enumerate(partition_by)],
        "__ahead", (F.col("__opened") - F.col("__parts")).alias("__first"),
    )
    same = F.col("__slice") == F.col("__s")
    for i, c in enumerate(partition_by):
        same = same & F.col(c).eqNullSafe(F.col(f"__f{i}"))
    inside = Window.partitionBy("__slice", *partition_by).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    # one slice a task: the windows need no other exchange
    rows = sliced.repartition(n_slices, "__slice").withColumn("__inside", F.coalesce(F.sum("__bytes").over(inside), F.lit(0))).join(at, same)
    part = F.col("__first") + F.floor((F.col("__ahead") + F.col("__inside")) / stretch)
    w = (
        rows.repartitionById(n_parts, part.cast("int"))
        .sortWithinPartitions(*keys)
        .select(*[F.col(c) for c in df.columns])
        .write.mode("overwrite")
        .option("header", True)
    )
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return cap


def parts_manifest(spark: SparkSession, path: str, schema: T.StructType | str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """One row per written part: file name, bytes, partition values and row count."""
    df = read_csv(spark, path, schema)
    cols = [
        F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("bytes"),
        *[F.col(c) for c in partition_cols],
    ]
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("rows"))


def read_geojson_points(spark: SparkSession, path: str) -> DataFrame:
    """Point features of GeoJSON FeatureCollections: lng, lat and the
    properties struct; features without coordinates are skipped (S5)."""
    raw = spark.read.option("multiLine", True).json(path)
    feats = raw.select(F.explode("features").alias("f"))
    coords = F.col("f.geometry.coordinates")
    return feats.filter(coords.isNotNull() & (F.size(coords) >= 2)).select(
        coords[0].cast("double").alias("lng"), coords[1].cast("double").alias("lat"), F.col("f.properties").alias("properties")
    )


def read_geojson_seq_points(spark: SparkSession, path: str) -> DataFrame:
    """Point features of line-delimited GeoJSON (one Feature per line); the
    files split across tasks like any JSON-lines input (S5)."""
    feats = spark.read.json(path)
    coords = F.col("geometry.coordinates")
    return feats.filter(coords.isNotNull() & (F.size(coords) >= 2)).select(
        coords[0].cast("double").alias("lng"), coords[1].cast("double").alias("lat"), F.col("properties").alias("properties")
    )


def to_geojson_features(df: DataFrame, geometry_type: str, coords: F.Column, properties: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One GeoJSON Feature per row as a JSON string column ``feature`` (S9), after the columns ``keep``."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit(geometry_type).alias("type"), coords.alias("coordinates")).alias("geometry"),
        F.struct(*[F.col(p) for p in properties]).alias("properties"),
    )
    return df.select(*keep, F.to_json(feature).alias("feature"))


def write_geojson_seq(features: DataFrame, path: str) -> None:
    """Line-delimited GeoJSON (one Feature per line, RFC 8142), written by
    every task in parallel instead of one collection document (S9)."""
    features.select("feature").write.mode("overwrite").text(path)


#: What every feature of a collection says once; records of the text source end at it.
FEATURE_MARK = '"Feature"'
#: The end of a record after which a feature goes on: `{ ... "type":` in a list or at the start.
FEATURE_OPENS = r'(?:^|[\[,])\s*(\{[^{}]*"type"\s*:\s*)\z'


def read_feature_collection(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Point features of FeatureCollection documents of any size (S5): lng, lat, properties.

    ``properties`` is the type of the properties struct.  The text source
    splits a document at every ``"Feature"``, so one file is read by as many
    tasks as it has splits.  A record that ends in ``{... "type":`` after a list
    bracket or comma opens a feature; running counts of such ends, per split and
    then over the splits of a file, number the features, and the pieces of one
    number are put together again.  So a feature that says ``"Feature"`` in a
    property, or that a split cuts, is whole.  Members before ``type`` must hold
    no object.  Features without coordinates are skipped, as are documents
    without features; null properties stay null.  Parts of one document
    (``write_feature_collection``) may be read as a folder.
    """
    split = ["file", "block"]
    raw = spark.read.option("lineSep", FEATURE_MARK).text(path)
    records = raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), "value",
    )
    records = records.withColumn("head", F.regexp_extract("value", FEATURE_OPENS, 1))
    opens = (F.col("head") != "").cast("long")
    before_split = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = records.groupBy(*split).agg(F.sum(opens).alias("n"))
    splits = splits.select(*split, F.coalesce(F.sum("n").over(before_split), F.lit(0)).alias("base"))
    before = Window.partitionBy(*split).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    numbered = records.withColumn("nth", F.coalesce(F.sum(opens).over(before), F.lit(0))).join(splits, split)
    nth = F.col("base") + F.col("nth")
    body = F.substring(F.col("value"), F.lit(1), F.length("value") - F.length("head"))
    pieces = F.array(
        F.struct(nth.alias("feature"), body.alias("piece")),
        F.struct((nth + 1).alias("feature"), F.nullif(F.col("head"), F.lit("")).alias("piece")),
    )
    piece = F.struct("block", "seq", "piece")
    whole = (
        numbered.select(*split, "seq", F.inline(pieces))
        .filter((F.col("feature") > 0) & F.col("piece").isNotNull())
        .groupBy("file", "feature")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(piece)), lambda p: p["piece"]), FEATURE_MARK).alias("text"))
    )
    parsed = whole.select(F.from_json("text", f"geometry struct<coordinates:array<double>>, properties {properties}").alias("f"))
    coords = F.col("f.geometry.coordinates")
    return parsed.filter(coords.isNotNull() & (F.size(coords) >= 2)).select(
        coords[0].alias("lng"), coords[1].alias("lat"), F.col("f.properties").alias("properties")
    )


def write_feature_collection(features: DataFrame, path: str, key: str) -> None:
    """One FeatureCollection in parts, ordered by ``key``.

    ``features`` is the result of ``to_geojson_features`` with a column ``key``
    that is unique and not null.  The parts, put one after another by name,
    are one valid document: the smallest key has no comma before it, and opening
    and closing lines sort before and after all rows.  An empty table gives an
    empty collection.
    """
    spark = features.sparkSession
    smallest = features.agg(F.min(key)).scalar()
    comma = F.when(F.col(key) == smallest, F.lit("")).otherwise(F.lit(","))
    kind = features.schema[key].dataType
    lines = features.select(F.lit(1).alias("place"), F.col(key).alias("key"), F.concat(comma, "feature").alias("value"))
    ends = spark.createDataFrame(
        [(0, '{"type":"FeatureCollection","features":['), (2, "]}")], "place int, value string"
    ).select("place", F.lit(None).cast(kind).alias("key"), "value")
    (
        lines.unionByName(ends)
        .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "place", "key")
        .sortWithinPartitions("place", "key")
        .select("value")
        .write.mode("overwrite")
        .text(path)
    )
