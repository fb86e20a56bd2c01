"""Numbered logger files as an ordered stream: ``<station>.dat<N>.dat``, one number after the other.

The offset is the next file number of every station. A station's files are handed out in the order of
their numbers, up to the first number that is missing and not beyond a file that reaches the open day,
so a half-written file, a late file or the running day never changes what was read before. What a batch
reads follows from its two offsets alone: a repeated batch reads the same files, and a restarted stream goes on
where it stopped.

The driver reads the end of each new file once, some files at a time, and stops at the first open one; files
before the stream's offset are not opened again. The folder is opened by pyarrow (local mount, HDFS, object stores);
tasks read whole files and hand out Arrow batches.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.csv as pc_csv
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from frostline.functions import values as val

FORMAT = "numbered_log"
SCHEMA = "series_key string, file_seq bigint, line bigint, stamp string, token string, corrupt string"
FIELDS = 6
TAIL_BYTES = 1 << 16       # of a file's end that is searched for its last stamp
FILES_PER_TASK = 64
AT_ONCE = 16               # file ends read at a time
BLOCK_BYTES = 8 << 20
_NAME = re.compile(r"^(?P<station>[^.]+)\.dat(?P<number>\d+)\.dat$")
_ARROW = pa.schema([("series_key", pa.string()), ("file_seq", pa.int64()), ("line", pa.int64()), ("stamp", pa.string()), ("token", pa.string()), ("corrupt", pa.string())])


class FilesOf(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        super().__init__(None)
        self.files = files


def last_stamp(data: bytes) -> dt.date | None:
    """Day of the last line with a readable time; None where there is none."""
    for line in reversed(data.decode("utf-8", "replace").splitlines()):
        try:
            return dt.datetime.fromisoformat(line.split(",")[0].strip().strip('"')).date()
        except ValueError:
            continue
    return None


class NumberedLogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.uri = options["path"]
        self.open_day = dt.date.fromisoformat(options["open_day"]) if options.get("open_day") else None
        self.per_task = int(options.get("files_per_task", FILES_PER_TASK))
        self.next: dict[str, int] = {}

    def _numbers(self) -> dict[str, set[int]]:
        system, root = fs.FileSystem.from_uri(self.uri)
        found: dict[str, set[int]] = {}
        for entry in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            name = _NAME.match(entry.base_name)
            if name and entry.type == fs.FileType.File:
                found.setdefault(name["station"], set()).add(int(name["number"]))
        return found

    def _path(self, root: str, station: str, number: int) -> str:
        return f"{root}/{station}.dat{number}.dat"

    def _is_open(self, system: fs.FileSystem, path: str) -> bool:
        """Whether the file reaches the open day; one without a readable time does not hold the others up."""
        today = self.open_day or dt.datetime.now(dt.timezone.utc).date()
        with system.open_input_file(path) as data:
            size = data.size()
            data.seek(max(0, size - TAIL_BYTES))
            day = last_stamp(data.read(TAIL_BYTES))
        return day is not None and day >= today

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        system, root = fs.FileSystem.from_uri(self.uri)
        for station, numbers in self._numbers().items():
            first = self.next.get(station, min(numbers))
            end = first
            while end in numbers:
                end += 1
            self.next[station] = self._first_open(system, root, station, first, end)
        return dict(self.next)

    def _first_open(self, system: fs.FileSystem, root: str, station: str, first: int, end: int) -> int:
        with ThreadPoolExecutor(AT_ONCE) as pool:
            for at in range(first, end, AT_ONCE):
                some = range(at, min(end, at + AT_ONCE))
                for number, is_open in zip(some, pool.map(lambda n: self._is_open(system, self._path(root, station, n)), some)):
                    if is_open:
                        return number
        return end

    def partitions(self, start: dict, end: dict) -> list[FilesOf]:
        # a restarted stream learns here how far it was
        self.next = {**end, **{s: max(n, end.get(s, n)) for s, n in self.next.items()}}
        numbers = self._numbers() if any(s not in start for s in end) else {}
        files = []
        for station, until in sorted(end.items()):
            first = start.get(station, min(numbers.get(station, {until})))
            files += [(station, number) for number in range(first, until)]
        return [FilesOf(files[n:n + self.per_task]) for n in range(0, len(files), self.per_task)]

    def read(self, partition: FilesOf) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(self.uri)
        for station, number in partition.files:
            yield from read_file(system, self._path(root, station, number), station, number)


def read_file(system: fs.FileSystem, path: str, station: str, number: int) -> Iterator[pa.RecordBatch]:
    """Lines of one file in batches: the first and third field; lines of another width keep their text in ``corrupt``."""
    broken: list[str] = []

    def keep(row) -> str:
        broken.append(row.text)
        return "skip"

    names = [f"c{n}" for n in range(FIELDS)]
    at = 0

    def batch(rows: int, stamp, token, corrupt) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([station] * rows, pa.string()), pa.array([number] * rows, pa.int64()),
                                           pa.array(range(at, at + rows), pa.int64()), stamp, token, corrupt], schema=_ARROW)

    with system.open_input_stream(path, compression=None) as source:
        try:
            reader = pc_csv.open_csv(source, read_options=pc_csv.ReadOptions(column_names=names, block_size=BLOCK_BYTES, use_threads=False),
                                     parse_options=pc_csv.ParseOptions(invalid_row_handler=keep, ignore_empty_lines=True),
                                     convert_options=pc_csv.ConvertOptions(column_types={c: pa.string() for c in names}, include_columns=["c0", "c2"]))
            for rows in reader:
                none = pa.nulls(rows.num_rows, pa.string())
                yield batch(rows.num_rows, rows.column(0), rows.column(1), none)
                at += rows.num_rows
        except pa.ArrowInvalid as problem:  # an empty file, or one that is no text at all
            if "Empty CSV file" not in str(problem):
                broken.append(str(problem))
    if broken:
        none = pa.nulls(len(broken), pa.string())
        yield batch(len(broken), none, none, pa.array(broken, pa.string()))


class NumberedLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> NumberedLogReader:
        return NumberedLogReader(self.options)


def numbered_log_stream(spark: SparkSession, path: str, open_day: str | None = None, bad: str = "Bad") -> DataFrame:
    """series_key, ts, t, file_seq, line and corrupt of new files in order; ``open_day`` (default: today, UTC) stays unread."""
    spark.dataSource.register(NumberedLog)
    reader = spark.readStream.format(FORMAT).option("path", path)
    if open_day is not None:
        reader = reader.option("open_day", open_day)
    rows, ts = reader.load(), F.try_to_timestamp("stamp")
    corrupt = F.when(ts.isNull(), F.coalesce("corrupt", F.concat_ws(",", "stamp", "token")))
    return rows.select("series_key", ts.alias("ts"), val.parse_value(F.col("token"), bad).alias("t"), "file_seq", "line", corrupt.alias("corrupt"))
