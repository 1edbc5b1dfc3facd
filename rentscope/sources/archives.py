"""Zstandard archives of text lines, read by several tasks each.

An archive is a row of frames that decompress on their own. A reader's partitions are runs of
frames: their places are found by walking the headers of frames and blocks, three bytes a block, so
nothing is decompressed for it. A line may lie in two frames; it belongs to the partition in which it begins,
which reads on for its end, and the first line of a later partition is left to the one before. An archive
of one frame is one task; ``reframe`` rewrites such archives once, streaming, into frames that end with a line.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

# The reader travels with the job: Python workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LINES = "value string, file string, seq long"
#: Compressed bytes of a partition, bytes of text in a rewritten frame, and lines of a batch.
SPLIT_BYTES, FRAME_BYTES, BATCH_LINES = 32 << 20, 8 << 20, 20_000
#: Partitions for each core, from which on smaller splits than ``SPLIT_BYTES`` only add tasks.
RUNS_A_CORE = 16
#: Bytes read at once, at first and at most, where the end of a run's last line is sought, and text given to the compressor at once.
READ_BYTES, FIRST_READ, WRITE_BYTES = 1 << 20, 4 << 10, 1 << 20
#: Bits of a line's number within its partition.
LINE_BITS = 40

# Fixed values of the frame format: magic numbers, and field sizes by the flags of a frame's header.
FRAME, SKIPPABLE, SKIPPABLE_MASK = 0xFD2FB528, 0x184D2A50, 0xFFFFFFF0
CONTENT_SIZE_BYTES, DICTIONARY_ID_BYTES = (0, 2, 4, 8), (0, 1, 2, 4)
RLE = 1


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark lists it, and the path within."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def frames(file: pa.NativeFile, size: int) -> Iterator[tuple[int, int]]:
    """Offset and length of each frame; frames without content are passed over."""

    def number(at: int, n: int) -> int:
        file.seek(at)
        data = file.read(n)
        if len(data) < n:
            raise ValueError(f"archive ends within a header at byte {at}")
        return int.from_bytes(data, "little")

    at = 0
    while at < size:
        begin, magic = at, number(at, 4)
        if magic & SKIPPABLE_MASK == SKIPPABLE:
            at += 8 + number(at + 4, 4)
            continue
        if magic != FRAME:
            raise ValueError(f"no frame at byte {at}")
        flags = number(at + 4, 1)
        single = flags >> 5 & 1
        at += 5 + (1 - single) + DICTIONARY_ID_BYTES[flags & 3] + (CONTENT_SIZE_BYTES[flags >> 6] or single)
        last = 0
        while not last:
            block = number(at, 3)
            last = block & 1
            at += 3 + (1 if block >> 1 & 3 == RLE else block >> 3)
        at += 4 * (flags >> 2 & 1)
        yield begin, at - begin


@dataclass
class FrameRun(InputPartition):
    """Frames of an archive that lie side by side: bytes from ``begin`` to ``end``; ``number`` counts the frames before."""

    path: str
    begin: int
    end: int
    size: int
    number: int

    def __post_init__(self) -> None:
        super().__init__(self.number)


def runs_of(path: str, size: int, split_bytes: int) -> list[FrameRun]:
    store, name = open_store(path)
    out: list[FrameRun] = []
    with store.open_input_file(name) as file:
        for number, (begin, length) in enumerate(frames(file, size)):
            if out and begin + length - out[-1].begin <= split_bytes:
                out[-1].end = begin + length
            else:
                out.append(FrameRun(path, begin, begin + length, size, number))
    return out


def split_for(sizes: list[int], least: int, cores: int) -> int:
    """Compressed bytes of a partition: at least ``least``, and where that makes very many partitions for the cores, up to ``SPLIT_BYTES``."""
    return max(least, min(SPLIT_BYTES, -(-sum(sizes) // (RUNS_A_CORE * max(1, cores)))))


def _text(file: pa.NativeFile, begin: int, end: int, step: int = READ_BYTES) -> Iterator[bytes]:
    """The text of the frames from byte ``begin`` to ``end``, in pieces; they begin with ``step`` bytes and grow."""
    file.seek(begin)
    left, expand = end - begin, zstandard.ZstdDecompressor().decompressobj(read_across_frames=True)
    while left > 0:
        data = file.read(min(step, left))
        if not data:
            raise ValueError("archive ends within a frame")
        left, step = left - len(data), min(2 * step, READ_BYTES)
        piece = expand.decompress(data)
        if piece:
            yield piece


def lines_of(run: FrameRun) -> Iterator[list[bytes]]:
    """The lines that begin in a run of frames, in pieces; a run after the first leaves its first line to the one before."""
    store, name = open_store(run.path)
    with store.open_input_file(name) as file:
        skip, rest = run.number > 0, b""
        for piece in _text(file, run.begin, run.end):
            *whole, rest = (rest + piece).split(b"\n")
            if skip and whole:
                whole, skip = whole[1:], False
            if whole:
                yield whole
        if skip:
            # All of it is the middle of a line that began before.
            return
        for piece in _text(file, run.end, run.size, FIRST_READ):
            head, end, _ = piece.partition(b"\n")
            rest += head
            if end:
                yield [rest]
                return
        if rest:
            yield [rest]


class _Reader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], split_bytes: int):
        self.files, self.split_bytes = files, split_bytes

    def partitions(self) -> list[FrameRun]:
        return [run for path, size in self.files for run in runs_of(path, size, self.split_bytes)] or [FrameRun("", 0, 0, 0, 0)]

    def read(self, partition: FrameRun) -> Iterator[pa.RecordBatch]:
        names = ["value", "file", "seq"]
        if not partition.path:
            return
        done = partition.number << LINE_BITS
        for piece in lines_of(partition):
            for at in range(0, len(piece), BATCH_LINES):
                lines = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in piece[at : at + BATCH_LINES]]
                n = len(lines)
                yield pa.RecordBatch.from_arrays([pa.array(lines), pa.array([partition.path] * n), pa.array(range(done, done + n), pa.int64())], names=names)
                done += n


class ZstdLines(DataSource):
    """Format ``zstd_lines``: ``value, file, seq`` of the archives in option ``files``, JSON of paths and sizes."""

    @classmethod
    def name(cls) -> str:
        return "zstd_lines"

    def schema(self) -> str:
        return LINES

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader([tuple(f) for f in json.loads(self.options["files"])], int(self.options.get("split_bytes", SPLIT_BYTES)))


def list_files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Paths and sizes of the files that a path or pattern names, in order."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [(f.getPath(), f) for f in store.globStatus(target) or []]
    inside = [f for p, s in found for f in (store.listStatus(p) if s.isDirectory() else [s])]
    return sorted((f.getPath().toString(), f.getLen()) for f in inside if f.isFile())


def read_lines(spark: SparkSession, pattern: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines of archives with their file and, in ``seq``, their order within it; a task reads some frames of one archive.

    ``split_bytes`` are the least compressed bytes of a task that reads several frames; many small ones are read by larger tasks.
    Lines end with a line feed, with or without a return before it; bytes that are no UTF-8 are replaced. A file that is no
    archive, or ends early, fails the query with the place.
    """
    spark.dataSource.register(ZstdLines)
    files = list_files(spark, pattern)
    split_bytes = split_for([size for _, size in files], split_bytes, spark.sparkContext.defaultParallelism)
    return spark.read.format("zstd_lines").option("files", json.dumps(files)).option("split_bytes", split_bytes).load()


def write_frames(lines: Iterator[bytes], path: str, frame_bytes: int = FRAME_BYTES) -> int:
    """Lines (with their ends) as one archive of frames, each of whole lines; the number of frames.

    A large frame is compressed as its text comes, so no frame is held whole.
    """
    store, name = open_store(path)
    pack, n, held, size, frame, written = zstandard.ZstdCompressor(), 0, [], 0, None, 0
    with store.open_output_stream(name, compression=None) as out:
        for line in lines:
            held.append(line)
            size += len(line)
            if written + size >= frame_bytes or size >= WRITE_BYTES:
                text, written, held, size = b"".join(held), written + size, [], 0
                if frame is None and written >= frame_bytes:
                    out.write(pack.compress(text))
                else:
                    frame = frame or pack.compressobj()
                    out.write(frame.compress(text))
                    if written >= frame_bytes:
                        out.write(frame.flush())
                if written >= frame_bytes:
                    frame, written, n = None, 0, n + 1
        if held or frame:
            out.write(frame.compress(b"".join(held)) + frame.flush() if frame else pack.compress(b"".join(held)))
            n += 1
    return n


def reframe(spark: SparkSession, pattern: str, folder: str, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Archives rewritten into frames of whole lines, once, one task per archive: ``file, copy, n_frames``.

    A task holds a piece of a frame's text. The copy gets its name when it is whole, so a task that runs again leaves no half one.
    """
    files = list_files(spark, pattern)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                copy = f"{folder.rstrip('/')}/{path.rsplit('/', 1)[1]}"
                store, name = open_store(copy)
                store.create_dir(name.rsplit("/", 1)[0], recursive=True)
                whole = FrameRun(path, 0, size, size, 0)
                n = write_frames((line + b"\n" for piece in lines_of(whole) for line in piece), f"{copy}.part", frame_bytes)
                store.move(f"{name}.part", name)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([copy]), pa.array([n], pa.int64())], names=["file", "copy", "n_frames"])

    schema = "file string, copy string, n_frames long"
    if not files:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(files, "path string, size long").repartition(len(files), "path").mapInArrow(rewrite, schema)
