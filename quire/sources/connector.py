"""Text files and spreadsheets as a data source of Spark's: ``spark.read.format("quire_files")`` and ``df.write.format("quire_files")``.

    connector.register(spark)
    spark.read.format("quire_files").load("file:///in")
    docs.write.format("quire_files").mode("append").save("file:///out")

Reading: rows of path, part_no, kind, text, status and length, one a file, or one a sheet of a spreadsheet. The columns asked for
by ``.schema(...)`` are the only ones made: without text and status no file is opened. Filters on kind, path and length go to the
file list. Files are dealt to partitions by their bytes, the largest first, so that each has about ``partitionBytes``; a file that cannot be
read is a row with a status. PDF and word-processor files are listed with the status ``other_reader``: they go through ``document.read_files``.

Writing: a file for each row, named by its column ``name``, holding its ``text``. Tasks write beside the target; the driver moves all
files into place when every task has ended well (commit), or removes what was written (abort), so a failed job leaves no file.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions.text import EXTENSIONS, IMAGE_EXTENSIONS
from .files import sheets_markdown, sheets_of

SCHEMA = "path string, part_no int, kind string, text string, status string, length long"
PARTITION_BYTES = 64 << 20


def kind_of(path: str) -> str:
    """As ``functions.text.route``, for one path."""
    name = path.rsplit("/", 1)[-1]
    ext = "." + name.rsplit(".", 1)[1].lower() if "." in name[1:] else ""
    return "rejected_image" if ext in IMAGE_EXTENSIONS else EXTENSIONS.get(ext, "unsupported")


def dealt(sizes: list[int], target: int, least: int = 1) -> list[list[int]]:
    """The places of the sizes in as few groups as hold about ``target`` each: the largest first, each to the lightest group.

    A file counts as a hundredth of the target at least, for opening it.
    """
    cost = [max(s, target // 100) for s in sizes]
    n = min(len(sizes), max(least, -(-sum(cost) // target)))
    groups: list[list[int]] = [[] for _ in range(n)]
    heap = [(0, g) for g in range(n)]
    for i in sorted(range(len(cost)), key=lambda i: (-cost[i], i)):
        load, g = heapq.heappop(heap)
        groups[g].append(i)
        heapq.heappush(heap, (load + cost[i], g))
    return groups


@dataclass
class Part(InputPartition):
    files: list[tuple[str, int]]


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names, self.path, self.target = schema.names, options["path"], int(options.get("partitionBytes", PARTITION_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Those on what the file list knows are taken over; Spark gets the others back."""
        kinds = {EqualTo: "eq", In: "in", StringStartsWith: "starts", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le"}
        for f in filters:
            if isinstance(f, IsNotNull) and f.attribute[0] in ("kind", "path", "length"):
                continue  # never null
            if type(f) in kinds and f.attribute[0] in ("kind", "path", "length"):
                self.tests.append((f.attribute[0], kinds[type(f)], f.value))
            else:
                yield f

    def _wanted(self, path: str, size: int) -> bool:
        have = {"kind": kind_of(path), "path": path, "length": size}
        test = {"eq": lambda x, v: x == v, "in": lambda x, v: x in v, "starts": lambda x, v: x.startswith(v), "gt": lambda x, v: x > v, "ge": lambda x, v: x >= v, "lt": lambda x, v: x < v, "le": lambda x, v: x <= v}
        return all(test[op](have[c], v) for c, op, v in self.tests)

    def partitions(self) -> Sequence[InputPartition]:
        files, root = fs.FileSystem.from_uri(self.path)
        info = files.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.type == fs.FileType.File else files.get_file_info(fs.FileSelector(root, recursive=True))
        listed = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")))
        listed = [f for f in listed if self._wanted(*f)]
        return [Part([listed[i] for i in sorted(g)]) for g in dealt([s for _, s in listed], self.target)]

    def _parts(self, files: fs.FileSystem, path: str, kind: str) -> list[tuple[str | None, str]]:
        """text and status of each part of a file."""
        if kind not in ("text", "excel") or path.lower().endswith(".xls"):
            return [(None, {"pdf": "other_reader", "docx": "other_reader"}.get(kind, "unsupported" if kind == "excel" else kind))]
        try:
            with files.open_input_stream(path) as f:
                data = f.read()
            if kind == "text":
                return [(data.decode("utf-8", "replace"), "ok")]
            return [(t, "ok") for t in sheets_of(sheets_markdown(data))] or [(None, "ok")]
        except Exception:  # the file's own failure, reported in its row
            return [(None, "open_failed")]

    def read(self, partition: Part) -> Iterator[tuple]:
        files, _ = fs.FileSystem.from_uri(self.path)
        opened = {"text", "status", "part_no"} & set(self.names)
        for path, size in partition.files:
            kind = kind_of(path)
            for i, (text, status) in enumerate(self._parts(files, path, kind) if opened else [(None, "")]):
                row = {"path": path, "part_no": i, "kind": kind, "text": text, "status": status, "length": size}
                yield tuple(row[n] for n in self.names)


class Writer(DataSourceWriter):
    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        if not {"name", "text"} <= set(schema.names):
            raise ValueError("rows to write have a name and a text")
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.beside = f"_temporary-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Written:
        files, root = fs.FileSystem.from_uri(self.path)
        mine, done = f"{root}/{self.beside}/{uuid.uuid4().hex}", []
        files.create_dir(mine, recursive=True)
        for i, row in enumerate(iterator):
            name = row["name"]
            if not name or "/" in name or name.startswith(("_", ".")):
                raise ValueError(f"not a file name: {name!r}")
            at = f"{mine}/{i}"
            with files.open_output_stream(at) as f:
                f.write((row["text"] or "").encode())
            done.append((at, name))
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = fs.FileSystem.from_uri(self.path)
        moves = [m for w in messages if w for m in w.files]
        names = [n for _, n in moves]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("two rows have one name")
        if self.overwrite:
            for f in files.get_file_info(fs.FileSelector(root)):
                if f.type == fs.FileType.File:
                    files.delete_file(f.path)
        for at, name in moves:
            files.move(at, f"{root}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        files, root = fs.FileSystem.from_uri(self.path)
        if files.get_file_info(f"{root}/{self.beside}").type == fs.FileType.Directory:
            files.delete_dir(f"{root}/{self.beside}")


class Files(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quire_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> Reader:
        unknown = set(schema.names) - {c.split()[0] for c in SCHEMA.split(", ")}
        if unknown:
            raise ValueError(f"no such columns: {sorted(unknown)}")
        return Reader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(schema, self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the source known to a session, with the pushdown of filters that it needs."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Files)
