"""A1: Arrow IPC files as a Spark data source (Python Data Source API).

``spark.read.format("arrow_ipc").load(dir)`` plans input partitions of about
``split_bytes`` (an option): small files whole, large ones by ranges of their record batches, which the
file's footer tells.  It yields ``pyarrow.RecordBatch`` objects straight from the file (no
per-row Python).  With a ``schema`` of some of the columns only these are decoded.  Files of the
streaming format have no footer and are one partition each.  ``df.write.format("arrow_ipc").save(dir)`` writes one IPC
file per task from Arrow batches.  Files are opened through
``pyarrow.fs`` so the same code reads local paths and cluster file systems.

No filter pushdown: convert to parquet early when a corpus is read more
than once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)
from pyspark.sql.types import StructType

NAME = "arrow_ipc"
_SUFFIXES = (".arrow", ".feather", ".ipc")


def _local(path: str) -> str:
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def _fs_and_path(path: str):
    import pyarrow.fs as pafs
    path = _local(path)
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _list_files(path: str) -> list[str]:
    import pyarrow.fs as pafs
    fs, p = _fs_and_path(path)
    info = fs.get_file_info(p)
    if info.type == pafs.FileType.File:
        return [path]
    sel = pafs.FileSelector(p, recursive=True)
    files = sorted(i.path for i in fs.get_file_info(sel)
                   if i.type == pafs.FileType.File and i.path.endswith(_SUFFIXES))
    path = _local(path)
    prefix = path[: len(path) - len(p)] if "://" in path else ""
    return [prefix + f for f in files]


def _open(path: str, columns: list[str] | None = None):
    """A reader of one file, of ``columns`` only."""
    import pyarrow as pa
    import pyarrow.ipc as ipc
    fs, p = _fs_and_path(path)

    def opened(options=None):
        f = fs.open_input_file(p)
        try:
            return ipc.open_file(f, options=options)
        except pa.ArrowInvalid:                  # not the file format: the streaming one
            f.close()
            return ipc.open_stream(fs.open_input_stream(p), options=options)
    r = opened()
    if columns is None:
        return r
    at = [r.schema.get_field_index(c) for c in columns]
    if min(at, default=0) < 0:
        raise ValueError(f"{path} has no column {columns[at.index(-1)]!r}")
    return opened(ipc.IpcReadOptions(included_fields=sorted(at)))


SPLIT_BYTES = 64 << 20


@dataclass
class _FilePartition(InputPartition):
    path: str
    start: int = 0
    end: int = -1                # record batches, the last one exclusive; -1: all


class _Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, split_bytes: int = SPLIT_BYTES):
        self.path = path
        self.schema = schema
        self.split_bytes = split_bytes

    def partitions(self):
        import pyarrow as pa
        out = []
        for path in _list_files(self.path):
            fs, p = _fs_and_path(path)
            size = fs.get_file_info(p).size
            r = _open(path) if size > self.split_bytes else None
            if isinstance(r, pa.ipc.RecordBatchFileReader) and r.num_record_batches > 1:
                n = r.num_record_batches
                step = max(1, n * self.split_bytes // size)
                out += [_FilePartition(path, i, min(i + step, n)) for i in range(0, n, step)]
            else:
                out.append(_FilePartition(path))
        return out

    def read(self, partition):
        import pyarrow as pa
        names = [f.name for f in self.schema.fields]
        r = _open(partition.path, names)
        if isinstance(r, pa.ipc.RecordBatchFileReader):
            end = r.num_record_batches if partition.end < 0 else partition.end
            batches = (r.get_batch(i) for i in range(partition.start, end))
        else:
            batches = iter(r)
        for b in batches:
            yield b.select(names)


@dataclass
class _Written(WriterCommitMessage):
    path: str
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path = _local(path).rstrip("/")
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex          # marks every file of this write job

    def write(self, iterator):
        import pyarrow as pa
        import pyarrow.ipc as ipc
        from pyspark import TaskContext
        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        target = f"{self.path}/part-{pid:05d}-{self.job}-{uuid.uuid4().hex[:12]}.arrow"
        fs, p = _fs_and_path(target)
        fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
        rows, writer, sink = 0, None, None
        for batch in iterator:
            if writer is None:
                sink = fs.open_output_stream(p)
                writer = ipc.new_file(sink, batch.schema)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is None:
            return _Written("", 0)
        writer.close()
        sink.close()
        return _Written(target, rows)

    def commit(self, messages):
        """Keep exactly the committed task files: drop leftovers of failed or
        speculative attempts of this job, and (overwrite) every older file."""
        keep = {m.path for m in messages if m is not None and m.path}
        fs, _ = _fs_and_path(self.path)
        for f in _list_files(self.path):
            ours = self.job in f.rsplit("/", 1)[-1]
            if f not in keep and (ours or self.overwrite):
                fs.delete_file(_fs_and_path(f)[1])

    def abort(self, messages):
        fs, _ = _fs_and_path(self.path)
        for m in messages:
            if m is not None and m.path:
                fs.delete_file(_fs_and_path(m.path)[1])


class ArrowIpcDataSource(DataSource):
    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        import pyarrow as pa
        files = _list_files(self.options["path"])
        if not files:
            raise ValueError(f"no Arrow IPC files under {self.options['path']}")
        s = _open(files[0]).schema
        from pyspark.sql.pandas.types import from_arrow_schema
        return from_arrow_schema(pa.schema(s))

    def reader(self, schema: StructType):
        return _Reader(self.options["path"], schema, int(self.options.get("split_bytes", SPLIT_BYTES)))

    def writer(self, schema: StructType, overwrite: bool):
        return _Writer(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ArrowIpcDataSource)
