"""Table sources and sinks: Parquet, CSV, JSON documents, keyed upsert,
latest-pointer publishing, month selection."""
from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.storagelevel import StorageLevel

from velocube.sources import versions


# ---------------------------------------------------------------- months
def last_months(as_of: Column, n: int = 12) -> Column:
    """Array of the ``n`` whole months before ``as_of`` as 'yyyyMM', newest first."""
    return F.transform(F.sequence(F.lit(1), F.lit(n)),
                       lambda i: F.date_format(F.add_months(F.trunc(as_of, "MM"), -i), "yyyyMM"))


def eastern_now() -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"),
                              F.current_timestamp().cast("timestamp_ntz"))


# ---------------------------------------------------------------- scans
def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None where nothing is there.  Any
    other failure (a damaged file, no permission) raises."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)  # noqa: SLF001


def is_folder(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    return fs.exists(jvm_path) and fs.getFileStatus(jvm_path).isDirectory()


def load_features(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Feature table by name and version: a version that ``upsert`` has made (the newest by default), or a
    folder ``<root>/v=<version>``."""
    if versions.history(spark, root):
        return read_table(spark, root, version)
    return spark.read.parquet(os.path.join(root, f"v={version or 1}"))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Predictions selected by column name (not position)."""
    return spark.read.parquet(path).select(
        F.col("station_id").cast("string"), F.col("station_rank").cast("int"),
        F.col("target_hour"), F.col("predicted_trips").cast("double"),
        F.col("prediction_generated_at"))


def read_json_doc(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A single JSON document; a missing file yields one row of NULLs/empty maps."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    if not fs.exists(jvm_path):
        return spark.range(1).select(*[
            (F.create_map().cast(f.dataType) if isinstance(f.dataType, T.MapType)
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
    return spark.read.schema(schema).option("multiLine", True).json(path)


def coerce_numeric(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Cast every non-numeric, non-temporal column (except ``keep``) to DOUBLE;
    values that do not parse become NULL."""
    numeric = (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType, T.BooleanType)
    cols = []
    for f in df.schema.fields:
        if f.name in keep or isinstance(f.dataType, numeric):
            cols.append(F.col(f.name))
        else:
            cols.append(F.col(f.name).try_cast("double").alias(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------- sinks
CSV_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; timestamps keep microseconds (Spark's default
    writes milliseconds)."""
    (df.write.mode(mode).option("header", True)
       .option("timestampNTZFormat", CSV_TS_FORMAT).option("timestampFormat", CSV_TS_FORMAT)
       .csv(path))


def write_json_doc(doc: DataFrame, path: str) -> None:
    """Write a one-row DataFrame as a single JSON document (``to_json``)."""
    (doc.select(F.to_json(F.struct(*doc.columns)).alias("value"))
        .coalesce(1).write.mode("overwrite").text(path))


def upsert(spark: SparkSession, target_path: str, new: DataFrame, keys: Sequence[str],
           event_time: str, partition_col: str | None = "month_key") -> DataFrame:
    """Keyed upsert into a versioned Parquet table (``sources.versions``).  Of the rows of a key the one with
    the latest ``event_time`` wins; at equal times a new row beats an old one,
    and among new rows the order of a hash of the row decides.

    With ``partition_col`` only the partitions that ``new`` touches are read and written anew; the others are
    carried over by name.  All of them become visible at once, with the manifest that is written last: a job that dies
    half way leaves the old version whole.  Only a missing path counts as an empty table: a table that cannot be
    read raises and stays as it is.  A plain Parquet folder is taken over as it is read.
    """
    if partition_col and partition_col not in new.columns:
        new = new.withColumn(partition_col, F.date_format(F.col(event_time), "yyyyMM"))
    new = new.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        base, folders = versions.manifest(spark, target_path)
        if base == 0:  # nothing there, or a plain folder: all of it is touched
            old, touched = existing(spark, target_path), None
        else:
            touched = [None]
            if partition_col:  # months: a short list
                touched = [r[0] for r in new.select(F.col(partition_col).cast("string")).distinct().collect()]
            old = versions.read(spark, target_path, base, touched)
        both = new.withColumn("_src", F.lit(1))
        if old is not None:
            if partition_col in old.columns:
                old = old.withColumn(partition_col, F.col(partition_col).cast(new.schema[partition_col].dataType))
            both = old.withColumn("_src", F.lit(0)).unionByName(both, allowMissingColumns=True)
        # keys are (nearly) unique: each window partition holds at most the old and the new rows of one key
        w = Window.partitionBy(*keys).orderBy(F.col(event_time).desc(), F.col("_src").desc(), F.xxhash64(*new.columns))
        merged = both.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_src")
        keep = {} if touched is None else {v: f for v, f in folders.items() if v not in touched}
        return versions.replace(spark, target_path, merged, partition_col, base, keep)
    finally:
        new.unpersist()


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A versioned table (or a plain Parquet folder), the newest version by default."""
    out = versions.read(spark, path, version)
    if out is None:
        raise FileNotFoundError(path)
    return out


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through the Hadoop FileSystem of its URI (works for
    HDFS/S3/local alike)."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)  # noqa: SLF001


SNAPSHOT_STAMP = "yyyyMMdd_HHmm"  # fixed value: the stamp of a published snapshot


def publish(df: DataFrame, root: str, generated_at_col: str = "prediction_generated_at") -> None:
    """Append a timestamped snapshot partition; readers take the newest one
    through ``latest``."""
    (df.withColumn("generated_at", F.date_format(F.col(generated_at_col), SNAPSHOT_STAMP))
       .write.mode("append").partitionBy("generated_at").parquet(root))


def latest(spark: SparkSession, root: str) -> DataFrame:
    """Newest snapshot of a published table (partition pruning on the max)."""
    snaps = spark.read.parquet(root)
    newest = snaps.agg(F.max("generated_at").alias("generated_at"))
    return snaps.join(F.broadcast(newest), "generated_at", "left_semi")  # 1-row side


# ---------------------------------------------------------------- bronze layout
def months_before(as_of: str, n: int = 12) -> list[str]:
    """The ``n`` whole months before ``as_of`` ('yyyy-mm-dd...') as 'yyyyMM',
    newest first - pure calendar arithmetic, so it can become a literal
    partition filter."""
    y, m = int(as_of[:4]), int(as_of[5:7])
    out = []
    for _ in range(n):
        m -= 1
        if m == 0:
            y, m = y - 1, 12
        out.append(f"{y:04d}{m:02d}")
    return out


def write_bronze(trips: DataFrame, path: str, ts: str = "started_at", mode: str = "overwrite") -> None:
    """Land trips once as Parquet partitioned by month ('ym'); later scans
    prune months and push filters into the files."""
    (trips.withColumn("ym", F.coalesce(F.date_format(F.col(ts), "yyyyMM"), F.lit("unknown")))
          .write.mode(mode).partitionBy("ym").parquet(path))


def bronze_months(spark: SparkSession, path: str) -> list[str]:
    """The months that have landed, from the folders' names."""
    return sorted(name[3:] for name in versions.listed(spark, path) if name.startswith("ym="))


def read_bronze(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """Bronze trips with the declared schema ('ym' stays text, no partition
    type inference); ``months`` becomes a partition filter (only those
    folders are listed and read)."""
    from velocube import schemas
    schema = T.StructType(schemas.TRIPS.fields + [T.StructField("ym", T.StringType())])
    df = spark.read.schema(schema).parquet(path)
    return df.filter(F.col("ym").isin(list(months))) if months else df
