"""Far too many small files: byte-level concatenation into few well-sized containers, with an index that gives each file back.

No payload is parsed. A payload of complete zstandard frames is joined to others as it stands (frames may follow each
other in a zstandard stream); any other goes into a newline-delimited container. Lengths and checksums are kept and checked.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.session import fresh_path

INDEX = "file_id long, container string, kind string, offset long, length long, crc long, header boolean, boundary int"
# Fixed values of the zstandard format (RFC 8878).
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
CONTENT_CHECKSUM_FLAG = 0x04
SINGLE_SEGMENT_FLAG = 0x20
RLE_BLOCK, RESERVED_BLOCK = 1, 3


def complete_zstd(data: bytes) -> bool:
    """True if data is one or more whole zstandard frames and nothing else: block sizes are followed, nothing is decompressed."""
    at, size = 0, len(data)
    while True:
        if data[at : at + 4] != ZSTD_MAGIC or at + 5 > size:
            return False
        flags = data[at + 4]
        content = (int(bool(flags & SINGLE_SEGMENT_FLAG)), 2, 4, 8)[flags >> 6]
        at += 5 + (not flags & SINGLE_SEGMENT_FLAG) + (0, 1, 2, 4)[flags & 3] + content
        last = False
        while not last:
            if at + 3 > size:
                return False
            block = int.from_bytes(data[at : at + 3], "little")
            last, kind, length = bool(block & 1), block >> 1 & 3, block >> 3
            if kind == RESERVED_BLOCK:
                return False
            at += 3 + (1 if kind == RLE_BLOCK else length)
        at += 4 if flags & CONTENT_CHECKSUM_FLAG else 0
        if at >= size:
            return at == size


class _Container:
    """One growing file; its name holds the run and the task attempt, so neither runs nor attempts write over each other."""

    def __init__(self, fs, folder: str, kind: str, header: bytes | None, run: str = ""):
        self.run, self.fs, self.folder, self.kind, self.header, self.made, self.out = run, fs, folder, kind, header, 0, None

    def add(self, data: bytes, target: int) -> tuple[str, int, int, bool, int]:
        """(file name, offset, bytes kept, header set aside, boundary bytes)."""
        if self.out and self.at + len(data) > target:
            self.close()
        if not self.out:
            context = TaskContext.get()
            self.name = f"{self.run}-{context.partitionId():06d}-{context.taskAttemptId()}-{self.made}.{self.kind}"
            self.out, self.at = self.fs.open_output_stream(f"{self.folder}/{self.name}"), 0
            self.made += 1
            if self.header and self.kind == "nd":
                self.out.write(self.header)
                self.at = len(self.header)
        aside = bool(self.header) and self.kind == "nd" and data.startswith(self.header)
        if aside:
            data = data[len(self.header) :]
        boundary = b"\n" if self.kind == "nd" and data and not data.endswith(b"\n") else b""
        self.out.write(data)
        self.out.write(boundary)
        start, self.at = self.at, self.at + len(data) + len(boundary)
        return self.name, start, len(data), aside, len(boundary)

    def close(self) -> None:
        if self.out:
            self.out.close()
            self.out = None


def _folder(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri.removeprefix('file:')}")


def compact(files: DataFrame, folder: str | None = None, *, file_id: str = "file_id", payload: str = "payload", target_bytes: int = 64 << 20, header: bytes | None = None, run: str | None = None) -> DataFrame:
    """Writes each file of `files` once into containers of about `target_bytes` in `folder`, and returns the index of them.

    The index has a row per input row: file_id, container, kind (nd, zstd), offset, length, crc, header (the file
    began with `header`, which stands once at the container's start), boundary (newlines added after it: 0 or 1).
    Payloads may be strings or binary. A null payload has an index row with null place; an empty one has length 0 and no
    boundary; a payload above target_bytes gets a container of its own; files with equal payloads or equal ids are each kept; further
    columns are ignored; an empty table gives an empty index and no container. Rows are read where they lie: partitions are
    merged without a shuffle to one task per target_bytes, and bytes are streamed, so neither memory nor traffic grows
    with the number of files. The index is a written table: containers that an abandoned attempt of this `run` (a name of its own, if none is given) left are removed, and those of other runs stay.
    """
    spark = files.sparkSession
    folder = folder or fresh_path(spark, "containers")
    rows = files.select(F.col(file_id).cast("long").alias("file_id"), F.col(payload).cast("binary").alias("payload"))
    total = files.agg(F.sum(F.octet_length(F.col(payload)))).first()[0] or 0
    fs, path = _folder(folder)
    fs.create_dir(path, recursive=True)
    run_id = run or uuid.uuid4().hex[:12]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _folder(folder)
        open_ones = {k: _Container(fs, path, k, header, run_id) for k in ("nd", "zstd")}
        try:
            for batch in batches:
                out: list[tuple] = []
                for i, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if not data.is_valid:
                        out.append((i, None, None, None, None, None, None, None))
                        continue
                    data = data.as_buffer().to_pybytes()
                    kind = "zstd" if data[:4] == ZSTD_MAGIC and complete_zstd(data) else "nd"
                    name, start, length, aside, boundary = open_ones[kind].add(data, target_bytes)
                    out.append((i, name, kind, start, length, zlib.crc32(data), aside, boundary))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * 8, _ARROW)], names=_NAMES)
        finally:
            for x in open_ones.values():
                x.close()

    index_path = f"{folder.rstrip('/')}-index"
    rows.coalesce(max(1, -(-total // target_bytes))).mapInArrow(pack, INDEX).write.parquet(index_path)
    index = spark.read.schema(INDEX).parquet(index_path)
    kept = {r.container for r in index.select("container").where("container is not null").distinct().toLocalIterator()}  # one name per target_bytes of data
    from pyarrow.fs import FileSelector

    for x in fs.get_file_info(FileSelector(path)):
        if x.is_file and x.base_name.startswith(f"{run_id}-") and x.base_name not in kept:
            fs.delete_file(x.path)
    return index.withColumn("folder", F.lit(folder))


_NAMES = [x.split()[0] for x in INDEX.split(", ")]
_ARROW = [{"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32()}[x.split()[1]] for x in INDEX.split(", ")]


def _ranges(batches: Iterator[pa.RecordBatch], header: bytes | None) -> Iterator[tuple[pa.RecordBatch, list[bytes | None], list[bool]]]:
    """Each index batch with its payloads and whether length and checksum hold; neighbouring ranges are read at once."""
    opened: tuple = (None, None)
    for batch in batches:
        x = batch.to_pydict()
        data: list[bytes | None] = []
        good: list[bool] = []
        n, k = batch.num_rows, 0
        while k < n:
            if x["container"][k] is None:
                data.append(None)
                good.append(True)
                k += 1
                continue
            end, stop = k, x["offset"][k]
            while end < n and x["container"][end] == x["container"][k] and x["offset"][end] - stop <= 4096 and x["offset"][end] >= x["offset"][k]:
                stop = x["offset"][end] + x["length"][end]
                end += 1
            if opened[0] != x["container"][k]:
                fs, path = _folder(x["folder"][k])
                opened = (x["container"][k], fs.open_input_file(f"{path}/{x['container'][k]}"))
            f, start = opened[1], x["offset"][k]
            block = f.read_at(max(0, min(stop, f.size()) - start), start)
            for j in range(k, end):
                a = x["offset"][j] - start
                one = block[a : a + x["length"][j]]
                whole = len(one) == x["length"][j]
                one = (header or b"") + one if x["header"][j] else one
                data.append(one)
                good.append(whole and zlib.crc32(one) == x["crc"][j])
            k = end
        yield batch, data, good


def _by_range(index: DataFrame) -> DataFrame:
    """The index in order of place, cut so that a task reads some 8 MB in a row."""
    total = index.agg(F.sum("length")).first()[0] or 0
    return index.repartitionByRange(max(1, -(-total // (8 << 20))), "container", "offset").sortWithinPartitions("container", "offset")


def read_records(index: DataFrame, header: bytes | None = None) -> DataFrame:
    """(file_id, payload binary) of every index row, read from the containers; a wrong length or checksum raises."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, good in _ranges(batches, header):
            if not all(good):
                raise ValueError(f"container damaged at file {batch.column(0)[good.index(False)]}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["file_id", "payload"])

    return _by_range(index).mapInArrow(read, "file_id long, payload binary")


def validate(index: DataFrame, header: bytes | None = None) -> DataFrame:
    """Per container: records, bytes of payload, damaged records, missing_bytes between the index and the file's end."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, good in _ranges(batches, header):
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("container", "length", "offset", "boundary", "folder")), pa.array([int(not g) for g in good], pa.int32())], names=["container", "length", "offset", "boundary", "folder", "bad"])

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.to_pydict()
            found = []
            for folder, name in zip(x["folder"], x["container"]):
                fs, path = _folder(folder)
                found.append(fs.get_file_info(f"{path}/{name}").size or 0)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("container", "records", "bytes", "damaged")), pa.array([s - e for s, e in zip(found, x["end"])], pa.int64())], names=["container", "records", "bytes", "damaged", "missing_bytes"])

    rows = _by_range(index.where("container is not null")).mapInArrow(check, "container string, length long, offset long, boundary int, folder string, bad int")
    per = rows.groupBy("folder", "container").agg(F.count("*").alias("records"), F.sum("length").alias("bytes"), F.sum("bad").cast("long").alias("damaged"), F.max(F.col("offset") + F.col("length") + F.col("boundary")).alias("end"))
    return per.mapInArrow(sizes, "container string, records long, bytes long, damaged long, missing_bytes long")
