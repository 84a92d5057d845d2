"""Trip scans: CSV with column subset, missing-column fallback, zip archives."""
from __future__ import annotations

import csv
import urllib.parse
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from velocube import schemas
from velocube.functions import parse_ts
from velocube.sources.tables import CSV_TS_FORMAT


def _typed(raw: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Cast the all-string scan to the declared trip types; bad values -> NULL.  ``more`` columns stay as they are."""
    out = list(more)
    for f in schemas.TRIPS.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampNTZType):
            out.append(parse_ts(c).alias(f.name))
        elif isinstance(f.dataType, T.DoubleType):
            out.append(c.try_cast("double").alias(f.name))
        else:
            out.append(c.alias(f.name))
    return raw.select(*out[len(more):], *more)


HEAD = 1 << 16  # bytes that a header line may take


def _head(data: bytes, most: int) -> str:
    """The first line of a file's first bytes."""
    line = data.split(b"\n", 1)[0]
    if len(line) >= most:
        raise ValueError(f"no line end within {most} bytes")
    return line.decode("utf-8-sig", "replace").rstrip("\r")


def first_lines(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """The first line of each file; no more than ``HEAD`` bytes of any are read.

    Tasks open the files themselves where ``pyarrow.fs`` knows their file system (compressed ones too); others are
    opened on the driver, by Spark's own file systems, some at a time.
    """
    from velocube.sources.archives import file_system
    try:
        file_system(files[0])
    except (pa.ArrowInvalid, OSError, IndexError):
        return _first_lines_by_driver(spark, files)
    most = HEAD

    def run(batches):
        for batch in batches:
            paths = batch.column(0).to_pylist()
            heads = []
            for path in paths:
                system, place = file_system(urllib.parse.unquote(path) if path.startswith("file:") else path)
                with system.open_input_stream(place) as f:
                    heads.append(_head(f.read(most), most))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(heads, pa.string())], names=["path", "head"])

    each = spark.createDataFrame([(f,) for f in files], "path string").repartition(max(1, min(len(files), spark.sparkContext.defaultParallelism)))
    return {r["path"]: r["head"] for r in each.mapInArrow(run, "path string, head string").collect()}  # one short line a file


def _first_lines_by_driver(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()  # noqa: SLF001

    def head(name: str) -> str:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        stream = path.getFileSystem(conf).open(path)
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        raw = stream if codec is None else codec.createInputStream(stream)
        try:
            return _head(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(raw, HEAD))), HEAD)
        finally:
            raw.close()

    with ThreadPoolExecutor(16) as pool:
        return dict(zip(files, pool.map(head, files)))


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files below ``paths`` by their header, the first line of each.

    Spark lists the files; of each only the first bytes are read (``first_lines``).  A header names ``started_at``, the
    one column every export has; a file without one raises, an empty file is left out.
    """
    files = spark.read.text(list(paths)).inputFiles()
    found: dict[tuple[str, ...], list[str]] = {}
    lines = first_lines(spark, sorted(files)) if files else {}
    for path, line in sorted(lines.items()):
        if not line:
            continue
        names = tuple(n.strip() for n in next(csv.reader([line])))
        if "started_at" not in names:
            raise ValueError(f"{path} has no header line")
        found.setdefault(names, []).append(urllib.parse.unquote(path))  # Spark names its input files as URIs
    return found


def read_trips(spark: SparkSession, paths: str | Sequence[str],
               cols: Sequence[str] | None = None) -> DataFrame:
    """Scan trip CSVs; every file's columns are bound by its own header.

    Files are grouped by header and each distinct header is one scan (all
    values as text, no schema inference).  Column order may differ, unknown
    columns are dropped, and wanted ones that a header lacks become typed
    NULLs.  Text is typed afterwards and unparsable values become NULL.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    out = None
    for names, files in headers(spark, paths).items():  # one scan per distinct header, not per file
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        scan = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(files)
        scan = scan.select(*[F.col(f.name) if f.name in names else F.lit(None).cast("string").alias(f.name)
                             for f in schemas.TRIPS_RAW.fields])
        out = scan if out is None else out.unionByName(scan)
    if out is None:
        out = spark.createDataFrame([], schemas.TRIPS_RAW)
    df = _typed(out)
    return df.select(*cols) if cols else df


def read_trips_by_header(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``read_trips`` under its older name: both bind columns by header."""
    return read_trips(spark, paths)


def read_trip_archives(spark: SparkSession, directory: str, first_only: bool = False, damaged: str = "raise") -> DataFrame:
    """Trips from the CSV members of the ``*.zip`` archives in a folder, and ``source_file``.

    A data source of its own (``velocube.sources.archives``): members are partitions, read at their offsets as
    streams, each bound by its own header.  ``first_only`` keeps the rule of reading the first member of an archive;
    ``damaged='skip'`` leaves out what fails its checksum.  Typing happens in Spark.  For repeated scans, land
    the data once as Parquet (``tables.write_bronze``).
    """
    from velocube.sources import archives
    archives.register(spark)
    raw = spark.read.format("trip_archives").option("first_only", str(first_only)).option("damaged", damaged).load(directory)
    return _typed(raw, [archives.SOURCE])


def write_trip_archives(trips: DataFrame, directory: str, rows: int = 100_000) -> None:
    """Trips as zip archives, one a task, with CSV members of at most ``rows`` rows (microseconds kept)."""
    from velocube.sources import archives
    archives.register(trips.sparkSession)
    text = [F.date_format(f.name, CSV_TS_FORMAT).alias(f.name) if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))
            else F.col(f.name).cast("string") for f in trips.schema.fields]
    trips.select(*text).write.format("trip_archives").option("rows", rows).mode("append").save(directory)
