"""Conflict-event exports: zip files holding one headerless tab-separated text each."""

from __future__ import annotations

import io
import itertools
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow import csv, fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from skytally.functions.text import last_path_segment
from skytally.functions.times import parse_compact
from skytally.schemas import EXPORT_COLUMNS, FILES

EXPORT_SUFFIX = ".export.CSV.zip"

# What cleaning needs; the other columns need not leave the parser.
USED_COLUMNS = [
    "GLOBALEVENTID", "Actor1Name", "Actor2Name", "EventCode", "QuadClass", "GoldsteinScale", "NumMentions", "NumSources", "NumArticles",
    "ActionGeo_CountryCode", "ActionGeo_Lat", "ActionGeo_Long", "DATEADDED", "SOURCEURL",
]


def _member_batches(member: io.BufferedReader, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Chosen text columns of a headerless tab-separated text, block by block.

    Only an empty field is NULL and quotes have no meaning. A line with missing fields at its end
    counts as having them empty; surplus fields are ignored.
    """
    if not member.peek(1):
        return
    uneven: list[str] = []

    def set_aside(row: csv.InvalidRow) -> str:
        uneven.append(row.text)
        return "skip"

    reader = csv.open_csv(
        member,
        read_options=csv.ReadOptions(column_names=EXPORT_COLUMNS, use_threads=False),
        parse_options=csv.ParseOptions(delimiter="\t", quote_char=False, invalid_row_handler=set_aside),
        convert_options=csv.ConvertOptions(
            column_types={c: pa.string() for c in EXPORT_COLUMNS},
            include_columns=list(columns),
            null_values=[""],
            strings_can_be_null=True,
            check_utf8=False,
        ),
    )
    yield from reader
    if uneven:
        width = len(EXPORT_COLUMNS)
        rows = [dict(zip(EXPORT_COLUMNS, (line.split("\t") + [""] * width)[:width])) for line in uneven]
        yield pa.RecordBatch.from_pydict({c: pa.array([r[c] or None for r in rows], pa.string()) for c in columns})


def _parser(columns: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def parse(files: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in files:
            for path, content in zip(batch.column("path"), batch.column("content")):
                name = path.as_py().rsplit("/", 1)[-1]
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                    with archive.open(archive.namelist()[0]) as member:
                        for rows in _member_batches(io.BufferedReader(member), columns):
                            source = pa.array([name] * rows.num_rows, pa.string())
                            yield pa.RecordBatch.from_arrays([source, *rows.columns], ["source_file", *columns])

    return parse


def parse_exports(files: DataFrame, columns: Sequence[str] = USED_COLUMNS) -> DataFrame:
    """``path, content`` rows (one small zip each) to the rows of their first members."""
    schema = ", ".join(f"{c} STRING" for c in ["source_file", *columns])
    return files.select("path", "content").mapInArrow(_parser(columns), schema)


def read_exports(spark: SparkSession, path: str, columns: Sequence[str] = USED_COLUMNS) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True)
    return parse_exports(files.load(path), columns)


class ExportZips(DataSource):
    """Sink ``export_zips``: lines of events as zip files of at most ``lines`` each under ``path``, as exports are stored.

    Each task streams its lines into archives in a folder of its own; they are moved in place once all tasks are done, so a task that is
    lost and run again leaves no second copy.
    """

    @classmethod
    def name(cls) -> str:
        return "export_zips"

    def schema(self) -> str:
        return "line STRING"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _ZipWriter(self.options["path"], int(self.options.get("lines", 100_000)))


class _Written(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class _ZipWriter(DataSourceArrowWriter):
    def __init__(self, path: str, lines: int):
        self.path, self.lines, self.job = path, lines, uuid.uuid4().hex

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path if "://" in self.path or ":/" in self.path else f"file://{self.path}")

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, folder = self._place()
        task = TaskContext.get()
        number, attempt = task.partitionId(), task.taskAttemptId()
        staging = f"{folder}/_staging-{self.job}"
        store.create_dir(staging, recursive=True)
        lines = (line for batch in batches for line in batch.column(0).to_pylist() if line is not None)
        files: list[str] = []
        for first in lines:
            files.append(f"{staging}/{attempt}-{number:05d}-{len(files):05d}{EXPORT_SUFFIX}")
            name = files[-1].rsplit("/", 1)[-1].split("-", 1)[1].removesuffix(".zip")
            with store.open_output_stream(files[-1]) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                with archive.open(zipfile.ZipInfo(name), "w", force_zip64=True) as member:
                    member.write(first.encode())
                    for line in itertools.islice(lines, self.lines - 1):
                        member.write(b"\n" + line.encode())
        return _Written(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, folder = self._place()
        for message in messages:
            for file in message.files if message else []:
                store.move(file, f"{folder}/{self.job[:8]}-{file.rsplit('/', 1)[-1].split('-', 1)[1]}")
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, folder = self._place()
        staging = f"{folder}/_staging-{self.job}"
        if store.get_file_info(staging).type != fs.FileType.NotFound:
            store.delete_dir(staging)


def write_exports(lines: DataFrame, path: str, lines_a_file: int = 100_000) -> None:
    """Store lines (column ``line``) as zipped exports under ``path``."""
    lines.sparkSession.dataSource.register(ExportZips)
    lines.select("line").write.format("export_zips").option("lines", lines_a_file).mode("append").save(path)


def stream_exports(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New zips only: the stream's checkpoint remembers every file it has seen."""
    reader = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.zip")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_exports(reader.load(path))


def export_version(source_file: Column, batch_id: Column) -> Column:
    """Order of exports as one number: by the moment their names begin with, then by the batch that brought them."""
    moment = F.coalesce(F.unix_seconds(parse_compact(F.substring(source_file, 1, 14))), F.lit(0))
    return F.shiftleft(moment, 31) + F.least(batch_id, F.lit((1 << 31) - 1))


def _third_token(line: Column) -> Column:
    return F.get(F.split(F.trim(line), r"\s+"), F.lit(2))


def export_urls(listing: DataFrame, line: str = "value") -> DataFrame:
    """Every event-export URL of a text listing (three tokens a line, the third is the URL)."""
    url = _third_token(F.col(line))
    return listing.select(url.alias("url"), last_path_segment(url).alias("file_name")).filter(
        F.col("url").endswith(EXPORT_SUFFIX)
    )


def latest_export_url(listing: DataFrame, line: str = "value") -> DataFrame:
    """The newest export (names start with their timestamp); fails when there is none."""
    newest = F.max(F.struct("file_name", "url"))["url"]
    missing = F.raise_error(F.lit(f"no {EXPORT_SUFFIX} line in the listing")).cast("string")
    return export_urls(listing, line).agg(F.coalesce(newest, missing).alias("url"))
