"""Files in and out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import numbered

TASK_SCHEMA = "grid_cell struct<lat_max: double, lat_min: double, lng_max: double, lng_min: double>, category string, depth int, retry_count int, priority double"
POPULATION_SCHEMA = "longitude double, latitude double, population double"


def population_csv(spark: SparkSession, path: str) -> DataFrame:
    """Cells with people: id is not in the file, so rows have none."""
    rows = spark.read.schema(POPULATION_SCHEMA).option("header", True).option("enforceSchema", True).csv(path)
    return rows.where(F.col("population") > 0).select("population", F.col("latitude").alias("lat"), F.col("longitude").alias("lng"))


def task_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TASK_SCHEMA).json(path)


def districts_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("name string, lat double, lng double").option("multiLine", True).json(path)


def boundary_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(boundary, ring, rings): the polygons in a GeoJSON feature collection, feature or geometry, numbered in order; ``ring`` is the outer one, ``rings`` has the holes after it."""
    polygon = F.from_json(F.col("g.coordinates"), "array<array<array<double>>>")
    many = F.from_json(F.col("g.coordinates"), "array<array<array<array<double>>>>")
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "type string, coordinates string, geometry struct<type:string,coordinates:string>, features array<struct<geometry:struct<type:string,coordinates:string>>>").alias("j"))
    shapes = F.when(F.col("j.features").isNotNull(), F.transform("j.features", lambda f: f["geometry"])).when(F.col("j.geometry").isNotNull(), F.array("j.geometry")).otherwise(F.array(F.struct(F.col("j.type").alias("type"), F.col("j.coordinates").alias("coordinates"))))
    rows = whole.select(F.posexplode(shapes).alias("feature", "g"))
    each = rows.select("feature", F.posexplode(F.when(F.col("g.type") == "Polygon", F.array(polygon)).otherwise(many)).alias("part", "p"))
    rings = F.transform("p", lambda r: F.transform(r, lambda v: F.struct(v[0].alias("x"), v[1].alias("y"))))
    return each.select(F.concat_ws("-", "feature", "part").alias("boundary"), rings.alias("rings")).select("boundary", F.col("rings")[0].alias("ring"), "rings")


def _files(spark: SparkSession, path: str):
    """The file system and the place of a path."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def union_existing(spark: SparkSession, paths: list[str], schema: str | None = None) -> DataFrame:
    """Rows of all the tables that exist; missing columns are null. If none does, no rows of ``schema``."""
    there = [p for p in paths if (lambda f: f[0].exists(f[1]))(_files(spark, p))]
    if not there:
        if schema is None:
            raise FileNotFoundError(f"none of {', '.join(paths)} exists")
        return spark.createDataFrame([], schema)
    out = spark.read.parquet(there[0])
    for p in there[1:]:
        out = out.unionByName(spark.read.parquet(p), allowMissingColumns=True)
    return out


def export_json(df: DataFrame, path: str) -> None:
    """The active businesses as one JSON array, a record a line, in files of which only the first opens and only the last closes it."""
    rows = df.select(F.to_json(F.struct("name", "lat", "lng", "category"), {"ignoreNullFields": "false"}).alias("value"))
    if rows.isEmpty():
        rows.sparkSession.createDataFrame([("[]",)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return
    # One file: an array can't be cut, and the export is one file by definition; rows stream through its writer.
    lines = rows.repartition(1).mapInArrow(_as_array, "value string")
    lines.write.mode("overwrite").text(path)


def _as_array(batches):
    import pyarrow as pa

    held, opened = None, False
    for b in batches:
        for v in b.column("value"):
            if held is not None:
                yield pa.RecordBatch.from_arrays([pa.array([("" if opened else "[") + held + ","])], names=["value"])
                opened = True
            held = v.as_py()
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([("" if opened else "[") + held + "]"])], names=["value"])


def export_tasks(df: DataFrame, path: str) -> None:
    """Tasks as lines of JSON, as ``task_lines`` reads them."""
    df.select(F.struct("lat_max", "lat_min", "lng_max", "lng_min").alias("grid_cell"), "category", "depth", "retry_count", "priority").write.mode("overwrite").json(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV in UTF-8 whose files begin with the byte-order mark (before the first column's name)."""
    first = df.columns[0]
    df.withColumnRenamed(first, "\ufeff" + first).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def shards(tasks: DataFrame, order: list[str], n: int, contiguous: bool = False) -> DataFrame:
    """Adds ``shard``: round robin over the order, or contiguous parts of which the first are the larger."""
    numbers = numbered(tasks, order, total="_total")
    small, more = F.floor(F.col("_total") / n), F.col("_total") % n
    part = F.when(F.col("_i") < more * (small + 1), F.floor(F.col("_i") / (small + 1))).otherwise(more + F.floor((F.col("_i") - more * (small + 1)) / F.nullif(small, F.lit(0))))
    return numbers.withColumn("shard", (part if contiguous else F.col("_i") % n).cast("int")).select(*tasks.columns, "shard")


def publish(df: DataFrame, path: str, by: str | None = None) -> None:
    """Replaces a table: it is written beside the old one, which then gives way by two renames.

    Where renames are atomic, readers see the old table, none for a moment, or the new one, never a part of it. ``df`` may read the old table.
    """
    spark, beside = df.sparkSession, f"{path.rstrip('/')}._{uuid.uuid4().hex}"
    writer = df.write
    (writer.partitionBy(by) if by else writer).parquet(beside)
    files, at = _files(spark, path)
    new, old = _files(spark, beside)[1], _files(spark, f"{beside}-old")[1]
    had = files.exists(at)
    if had and not files.rename(at, old):
        raise OSError(f"{path} can't be moved away")
    if not files.rename(new, at):
        if had:
            files.rename(old, at)
        raise OSError(f"{beside} can't be moved to {path}")
    if had:
        files.delete(old, True)


#: What a business record shows of itself (fixed names).
RECORD = ("name", "lat", "lng", "category", "search_category")


def records(df: DataFrame, fields: tuple[str, ...] = RECORD) -> DataFrame:
    """The rows as records of the fields, missing ones null."""
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in fields))


def most_common(df: DataFrame, column: str, k: int) -> DataFrame:
    """(value, n): the k most frequent values, of equals the first by value; a top-k report."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col("value").asc_nulls_last()).limit(k)
