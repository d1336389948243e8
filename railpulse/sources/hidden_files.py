"""Reader for raw files whose names start with ``_``, which Spark's readers skip.

Registers the format ``hidden_json_gz``: columns ``source``, ``value`` and ``error``, one row
per file. The driver only lists, with options ``providers``, ``first`` and ``last`` just the
day folders they name; executors open and unpack the files of their partition. A broken
file has an error and no value, and stops no other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator, Mapping

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from railpulse.sources.raw_events import DOCUMENTS, unpack

FORMAT = "hidden_json_gz"
SUFFIX = ".json.gz"
BYTES_PER_PARTITION = 32 * 1024 * 1024


class FileGroup(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class HiddenFilesReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.root = options["path"]
        self.providers = [p for p in options.get("providers", "").split(",") if p]
        self.days = _days(options.get("first"), options.get("last"))

    def _listed(self) -> Iterator[fs.FileInfo]:
        system, base = _open(self.root)
        providers = self.providers or [None]
        for provider in providers:
            for day in self.days or [None]:
                if day is not None and provider is None:
                    raise ValueError("days can only be listed of named providers")
                folder = base if provider is None else f"{base}/{provider}"
                if day is not None:
                    folder += f"/Year={day:%Y}/Month={day:%m}/Day={day:%d}"
                yield from system.get_file_info(
                    fs.FileSelector(folder, recursive=True, allow_not_found=True))

    def partitions(self) -> list[FileGroup]:
        found = self._listed()
        groups: list[list[str]] = []
        room = 0
        for info in sorted(found, key=lambda f: f.path):
            if not info.is_file or not info.path.endswith(SUFFIX):
                continue
            if not groups or info.size > room:
                groups.append([])
                room = BYTES_PER_PARTITION
            groups[-1].append(info.path)
            room -= info.size
        return [FileGroup(paths) for paths in groups or [[]]]

    def read(self, partition: FileGroup) -> Iterator[tuple[str, str | None, str | None]]:
        system, _ = _open(self.root)
        for path in partition.paths:
            with system.open_input_file(path) as raw:
                packed = raw.read()
            yield path, *unpack(packed)


class HiddenFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return DOCUMENTS

    def reader(self, schema) -> HiddenFilesReader:
        return HiddenFilesReader(dict(self.options))


def _open(root: str) -> tuple[fs.FileSystem, str]:
    if "://" in root or root.startswith("file:"):
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root


def _days(first: str | None, last: str | None) -> list[dt.date]:
    if not first:
        return []
    begin, end = dt.date.fromisoformat(first), dt.date.fromisoformat(last or first)
    return [begin + dt.timedelta(days=n) for n in range((end - begin).days + 1)]


def read_hidden_documents(
    spark: SparkSession, root: str, providers: Iterable[str] = (),
    first: dt.date | None = None, last: dt.date | None = None,
) -> DataFrame:
    """Documents for ``parse_event_documents`` from a store with hidden file names.

    ``providers`` are spelled as in paths; with days, only their folders are listed.
    """
    spark.dataSource.register(HiddenFiles)
    reader = spark.read.format(FORMAT).option("providers", ",".join(providers))
    if first is not None:
        reader = reader.option("first", first.isoformat()).option("last", (last or first).isoformat())
    return reader.load(root)
