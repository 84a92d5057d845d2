"""Zip archives of trip CSVs as a Spark data source (``trip_archives``).

Reading: the central directory of every ``*.zip`` below a folder is read (its last kilobytes, archives in parallel), and
members become partitions of their own: a member is opened at its offset and decompressed and parsed as a stream of
blocks, so no task holds an archive, a member or more than a block of rows.  Small members share a partition up to
``PACK`` compressed bytes.  Members in ``__MACOSX`` and those that are not ``.csv`` are left out.

Options: ``path``; ``first_only`` (of each archive the first CSV member); ``damaged``: ``raise`` (default), or ``skip`` to
leave out whole members that fail their checksum or cannot be parsed, and archives without a directory, as a run
over many months needs it.  With ``skip`` a member is read twice: tested first, then parsed, so that none is kept in part.

Writing: every task writes one archive below ``_staged``, with members of at most ``rows`` rows; the commit moves the
archives of the tasks that count into place, so a lost task's file is never read.

Files are opened by ``pyarrow.fs`` (local paths, hdfs, s3, gs).
"""
from __future__ import annotations

import csv
import io
import posixpath
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv as pacsv
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from velocube import schemas

PACK = 64 << 20
BLOCK = 4 << 20
COLUMNS = [f.name for f in schemas.TRIPS_RAW.fields]
DAMAGE = (zipfile.BadZipFile, zlib.error, pa.ArrowInvalid, OSError, ValueError)  # what a file that is no sound archive raises
SOURCE = "source_file"  # archive and member that a row comes from


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class Members(InputPartition):
    """Members (archive, name) that one task reads."""
    members: list

    def __init__(self, members):
        self.members = members


def csv_members(archive) -> list[zipfile.ZipInfo]:
    with zipfile.ZipFile(archive) as z:
        return [i for i in z.infolist() if i.filename.endswith(".csv") and "__MACOSX" not in i.filename]


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.first_only = str(options.get("first_only", "false")).lower() == "true"
        self.skip = str(options.get("damaged", "raise")).lower() == "skip"

    def partitions(self) -> list[InputPartition]:
        files, root = file_system(self.path)
        found = files.get_file_info(fs.FileSelector(root, recursive=False))
        names = sorted(i.path for i in found if i.type == fs.FileType.File and i.path.endswith(".zip"))

        def listed(name: str):
            try:
                with files.open_input_file(name) as f:
                    return [(name, i.filename, i.compress_size) for i in csv_members(f)[:1 if self.first_only else None]]
            except DAMAGE:
                if not self.skip:
                    raise
                return []

        with ThreadPoolExecutor(16) as pool:
            members = [m for some in pool.map(listed, names) for m in some]
        out, held, size = [], [], 0
        for archive, name, packed in members:
            if held and size + packed > PACK:
                out.append(Members(held))
                held, size = [], 0
            held.append((archive, name))
            size += packed
        return [*out, Members(held)]

    def read(self, partition: Members) -> Iterator[pa.RecordBatch]:
        files, _ = file_system(self.path)
        for archive, name in partition.members:
            with files.open_input_file(archive) as f, zipfile.ZipFile(f) as z:
                if self.skip and not self._sound(z, name):
                    continue
                yield from parsed(z, name, f"{posixpath.basename(archive)}/{name}")

    @staticmethod
    def _sound(z: zipfile.ZipFile, name: str) -> bool:
        try:
            for _ in parsed(z, name, ""):
                pass
            return True
        except DAMAGE:
            return False


def parsed(z: zipfile.ZipFile, name: str, source: str) -> Iterator[pa.RecordBatch]:
    """A member's rows, block by block: the trip columns as text, bound by the member's own header; absent ones null."""
    with z.open(name) as raw:
        head = raw.readline().decode("utf-8-sig")
        if not head.strip():
            return
        names = [n.strip() for n in next(csv.reader([head]))]
        convert = pacsv.ConvertOptions(column_types={n: pa.string() for n in names}, null_values=[""], strings_can_be_null=True, quoted_strings_can_be_null=True)
        try:
            rows = pacsv.open_csv(raw, pacsv.ReadOptions(column_names=names, block_size=BLOCK), pacsv.ParseOptions(newlines_in_values=True), convert)
        except pa.ArrowInvalid as e:
            if "Empty CSV file" in str(e):
                return
            raise
        for batch in rows:
            columns = [batch.column(names.index(c)) if c in names else pa.nulls(batch.num_rows, pa.string()) for c in COLUMNS]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([source] * batch.num_rows, pa.string())], names=[*COLUMNS, SOURCE])


@dataclass
class Written(WriterCommitMessage):
    path: str | None


class ArchiveWriter(DataSourceWriter):
    def __init__(self, options: dict, columns: list[str]):
        self.path, self.columns = options["path"], columns
        self.rows = int(options.get("rows", 100_000))

    def write(self, iterator) -> Written:
        files, root = file_system(self.path)
        staged, path, part = posixpath.join(root, "_staged"), None, 0
        batch: list = []
        files.create_dir(staged, recursive=True)
        z = out = None

        def flush():
            nonlocal z, out, path, part, batch
            if z is None:
                path = posixpath.join(staged, f"trips-{uuid.uuid4().hex}.zip")
                out = files.open_output_stream(path)
                z = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
            text = io.StringIO()
            rows = csv.writer(text)
            rows.writerow(self.columns)
            rows.writerows(batch)
            z.writestr(f"trips-{part}.csv", text.getvalue())
            part, batch = part + 1, []

        for row in iterator:
            batch.append(["" if x is None else x for x in row])
            if len(batch) >= self.rows:
                flush()
        if batch:
            flush()
        if z is not None:
            z.close()
            out.close()
        return Written(path)

    def commit(self, messages) -> None:
        files, root = file_system(self.path)
        for m in messages:
            if m is not None and m.path:
                files.move(m.path, posixpath.join(root, posixpath.basename(m.path)))

    def abort(self, messages) -> None:
        files, _ = file_system(self.path)
        for m in messages:
            if m is not None and m.path:
                files.delete_file(m.path)


class TripArchives(DataSource):
    """Rows of text, one column for each of the raw trip columns, and where they come from."""

    @classmethod
    def name(cls) -> str:
        return "trip_archives"

    def schema(self) -> str:
        return ", ".join(f"{c} string" for c in [*COLUMNS, SOURCE])

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options, [f.name for f in schema.fields])


def register(spark) -> None:
    spark.dataSource.register(TripArchives)
