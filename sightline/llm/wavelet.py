"""Token ids in wavelet-matrix files: succinct bit planes with rank and select, one file per shard."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from sightline.llm.files import read_file, write_file
from sightline.llm.text import with_long_id
from sightline.llm.tokens import loaded
from sightline.session import materialize

MAGIC = b"WVM1"
BLOCK = 512  # bits per entry of a plane's rank directory


def _smallest(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint16 if not len(values) or values.max() < 1 << 16 else np.uint32)


def encode(ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray, level: int = 1) -> bytes:
    """A file: magic, header, then compressed sections (documents, and per plane its bits).

    ``ends`` holds for each document the number of ids up to and including its last. A plane holds
    one bit of every id, from the highest; each plane keeps the order of the one before, zeros first.
    """
    packer = zstandard.ZstdCompressor(level=level)
    current = _smallest(ids)
    bits = max(int(current.max()).bit_length() if len(current) else 0, 1)
    zeros, planes = [], []
    for b in reversed(range(bits)):
        plane = np.packbits((current & current.dtype.type(1 << b)) != 0, bitorder="little")
        planes.append(packer.compress(plane.tobytes()))
        # a plane is an Arrow mask, and Arrow's filters move random bits faster than numpy's
        values = pa.array(current)
        first, then = (values.filter(pa.Array.from_buffers(pa.bool_(), len(values), [None, pa.py_buffer(x)])) for x in (~plane, plane))
        zeros.append(len(first))
        current = np.concatenate([first.to_numpy(), then.to_numpy()])
    known = np.array([x is not None for x in doc_ids], np.uint8)
    own = np.array([x or 0 for x in doc_ids], "<i8")
    docs = packer.compress(known.tobytes() + own.tobytes() + np.asarray(ends, "<i8").tobytes())
    sections = [docs, *planes]
    header = struct.pack(f"<4sQQI{len(zeros)}Q{len(sections)}Q", MAGIC, len(ids), len(doc_ids), bits, *zeros, *map(len, sections))
    return header + b"".join(sections)


@dataclass
class Plane:
    """Bits with constant-time rank by a directory of block counts, and select by binary search."""

    packed: np.ndarray
    n: int

    @cached_property
    def directory(self) -> np.ndarray:
        padded = np.zeros(-(-max(self.n, 1) // BLOCK) * BLOCK // 8, np.uint8)
        padded[: len(self.packed)] = self.packed
        ones = np.bitwise_count(padded).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64)
        return np.append(0, np.cumsum(ones))

    def bit(self, i: int) -> int:
        return int(self.packed[i >> 3] >> (i & 7)) & 1

    def rank1(self, i: int) -> int:
        """Ones before position ``i``."""
        block, byte = i // BLOCK, i >> 3
        count = int(self.directory[block]) + int(np.bitwise_count(self.packed[block * BLOCK // 8 : byte]).sum())
        return count + (int(self.packed[byte] & ((1 << (i & 7)) - 1)).bit_count() if i & 7 else 0)

    def rank(self, bit: int, i: int) -> int:
        return self.rank1(i) if bit else i - self.rank1(i)

    def select(self, bit: int, k: int) -> int:
        """Position of the ``k``-th such bit, from 0."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if self.rank(bit, middle + 1) <= k else (low, middle)
        return low


class WaveletFile:
    """Access, counting and lookup of ids in one file. Planes are unpacked when first used."""

    def __init__(self, content: bytes):
        magic, self.n, self.n_docs, self.bits = struct.unpack_from("<4sQQI", content)
        if magic != MAGIC:
            raise ValueError("not a wavelet file")
        at = struct.calcsize("<4sQQI")
        self.zeros = struct.unpack_from(f"<{self.bits}Q", content, at)
        at += 8 * self.bits
        sizes = struct.unpack_from(f"<{self.bits + 1}Q", content, at)
        at += 8 * (self.bits + 1)
        self.sections = []
        for size in sizes:
            self.sections.append(content[at : at + size])
            at += size

    def _section(self, i: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self.sections[i])

    @cached_property
    def documents(self) -> tuple[list[int | None], np.ndarray]:
        raw = self._section(0)
        known = np.frombuffer(raw, np.uint8, self.n_docs)
        own = np.frombuffer(raw, "<i8", self.n_docs, self.n_docs)
        ends = np.frombuffer(raw, "<i8", self.n_docs, 9 * self.n_docs)
        return [int(x) if k else None for x, k in zip(own, known, strict=True)], ends

    @cached_property
    def planes(self) -> list[Plane]:
        return [Plane(np.frombuffer(self._section(i + 1), np.uint8), self.n) for i in range(self.bits)]

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        value = 0
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit = plane.bit(i)
            value = value << 1 | bit
            i = zeros + plane.rank1(i) if bit else i - plane.rank1(i)
        return value

    def _interval(self, token: int, upto: int) -> tuple[int, int]:
        start, end = 0, upto
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            bit = token >> (self.bits - 1 - level) & 1
            start, end = (bit * zeros + plane.rank(bit, x) for x in (start, end))
        return start, end

    def rank(self, token: int, upto: int) -> int:
        """Occurrences of an id before position ``upto``."""
        if token >> self.bits:
            return 0
        start, end = self._interval(token, upto)
        return end - start

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the ``k``-th occurrence of an id, from 0."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        at = self._interval(token, self.n)[0] + k
        for level in reversed(range(self.bits)):
            bit = token >> (self.bits - 1 - level) & 1
            at = self.planes[level].select(bit, at - bit * self.zeros[level])
        return at

    def locate(self, token: int) -> Iterator[int]:
        """All positions of an id, in order."""
        return (self.select(token, k) for k in range(self.count(token)))

    def ids(self) -> np.ndarray:
        """The whole sequence: planes are undone from the last, each in two bulk moves."""
        value = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for level in reversed(range(self.bits)):
            mask = np.unpackbits(self.planes[level].packed, count=self.n, bitorder="little").astype(bool)
            before = np.empty_like(value)
            # positions move random bits faster than masks do
            before[np.flatnonzero(~mask)] = value[: self.zeros[level]]
            before[np.flatnonzero(mask)] = value[self.zeros[level] :] | value.dtype.type(1 << (self.bits - 1 - level))
            value = before
        return value.astype("<u4")


@dataclass(frozen=True)
class TokenFiles:
    """``file_ids`` ids close a file; a longer document is not split. A task gets about ``task_bytes`` of
    texts, and there are ``partitions`` tasks at least."""

    tokenizer: str
    attached: bool = True
    end_id: int = 0
    partitions: int = 64
    file_ids: int = 1 << 21
    task_bytes: int = 256 << 20


MANIFEST = "task int, place int, path string, n_docs long, n_tokens long"


def write_files(docs: DataFrame, folder: str, p: TokenFiles) -> DataFrame:
    """Write the ids of all texts in ascending ``doc_id`` order; returns the stored list of files.

    Documents are range-partitioned by ``doc_id`` and each task writes its files in order. Files
    are complete or absent, and a repeated task writes the same ones.

    A null or empty text is its end id; rows without a doc_id come first; rows that repeat one
    follow each other. An empty table writes no file. Other columns are ignored.
    """
    target = to_arrow_schema(_parse_datatype_string(MANIFEST))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, place = TaskContext.get().partitionId(), 0
        tokens, end = loaded(p.tokenizer, p.attached), p.end_id.to_bytes(4, "little")
        parts: list[bytes] = []
        names: list[int | None] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal place, size
            ids = np.frombuffer(b"".join(parts), "<u4")
            path = f"{folder}/{task:06d}-{place:06d}.wvm"
            write_file(path, encode(ids, names, np.cumsum([len(x) // 4 for x in parts])))
            row = [[task], [place], [path], [len(names)], [len(ids)]]
            place, size = place + 1, 0
            parts.clear()
            names.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, target, strict=True)], schema=target)

        for batch in batches:
            own = tokens.encode(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), own, strict=True):
                parts.append(ids + end)
                names.append(doc_id)
                size += len(ids) // 4 + 1
                if size >= p.file_ids:
                    yield flush()
        if parts:
            yield flush()

    rows = with_long_id(docs).withColumn("text", F.col("text").cast("string"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = rows.repartitionByRange(max(p.partitions, -(-size // p.task_bytes)), "doc_id").sortWithinPartitions("doc_id")
    return materialize(ordered.mapInArrow(run, MANIFEST), "manifest")


def read_files(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files.

    ``start`` counts the ids of all documents before it: the ids of a task's earlier files, and of
    earlier tasks, of which there is one row each.
    """
    tasks = files.groupBy("task").agg(F.sum("n_tokens").alias("n"))
    tasks = tasks.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("earlier"))
    within = F.sum("n_tokens").over(Window.partitionBy("task").orderBy("place")) - F.col("n_tokens")
    placed = files.withColumn("within", within).join(tasks, "task")
    placed = placed.select("path", (F.col("within") + F.col("earlier")).alias("start"), F.xxhash64("path").alias("h"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                found = WaveletFile(read_file(path))
                names, ends = found.documents
                raw = memoryview(found.ids().tobytes())
                begins = np.append(0, ends[:-1]).astype(np.int64)
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                columns = [names, begins + start, ends - begins, crcs]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    spread = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(spread, "h").mapInArrow(run, schema)
