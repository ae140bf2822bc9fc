"""Bounded-space online packing of documents into sequences of a fixed length."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from sightline.llm.text import with_long_id
from sightline.llm.tokens import crc, loaded
from sightline.session import materialize


@dataclass(frozen=True)
class Packing:
    """``windows`` are open at once in a task; a gap under ``least_cut`` ids is padded, not filled.

    The tails of ``fan_in`` tasks are merged by one task: at most that many windows.
    """

    tokenizer: str
    attached: bool = False
    end_id: int = 1
    length: int = 2048
    windows: int = 64
    least_cut: int = 16
    fan_in: int = 256
    pieces: int = 900_000  # that a worker's tokenizer remembers, about 250 bytes each


@dataclass
class Piece:
    doc_id: int | None
    start: int
    doc_tokens: int
    ids: bytes

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.doc_tokens, self.ids[: 4 * n]),
            Piece(self.doc_id, self.start + n, self.doc_tokens, self.ids[4 * n :]),
        )


@dataclass
class Packer:
    """Places pieces as they come; ``done`` gets each sequence as a list of pieces."""

    p: Packing
    done: list[list[Piece]] = field(default_factory=list)
    open: list[tuple[int, list[Piece]]] = field(default_factory=list)  # (ids used, pieces)

    def add(self, piece: Piece) -> None:
        p = self.p
        while len(piece) >= p.length:  # whole sequences of a long document
            head, piece = piece.cut(p.length)
            self.done.append([head])
        n = len(piece)
        if not n:
            return
        fits = [i for i, (used, _) in enumerate(self.open) if used + n <= p.length]
        if fits:
            best = max(fits, key=lambda i: self.open[i][0])
        elif len(self.open) < p.windows:
            self.open.append((0, []))
            best = len(self.open) - 1
        else:  # the fullest window goes, topped up with the head of the piece
            best = max(range(len(self.open)), key=lambda i: self.open[i][0])
            used, pieces = self.open[best]
            if p.length - used >= p.least_cut:
                head, piece = piece.cut(p.length - used)
                pieces.append(head)
            self.done.append(pieces)
            self.open[best] = (0, [])
        used, pieces = self.open[best]
        pieces.append(piece)
        if used + len(piece) == p.length:
            self.done.append(pieces)
            self.open.pop(best)
        else:
            self.open[best] = (used + len(piece), pieces)

    def taken(self) -> list[list[Piece]]:
        out, self.done = self.done, []
        return out

    def close(self) -> list[Piece]:
        """Pieces of the last, partly filled window, after the open ones were filled from each other."""
        rest = [piece for _, pieces in sorted(self.open, key=lambda w: -w[0]) for piece in pieces]
        self.open = []
        tail, used = [], 0
        for piece in rest:
            if used + len(piece) >= self.p.length:
                head, piece = piece.cut(self.p.length - used)
                self.done.append([*tail, head])
                tail, used = [], 0
            if len(piece):
                tail.append(piece)
                used += len(piece)
        return tail


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _rows(pieces: list[Piece], sequence: int) -> Iterator[tuple]:
    offset = 0
    for x in pieces:
        yield x.doc_id, x.start, len(x), crc(x.ids), x.doc_tokens, sequence, offset
        offset += len(x)


def _first_level(docs: DataFrame, p: Packing) -> DataFrame:
    """Pieces of finished sequences, and those of each task's tail with their ids and task number."""
    schema = PIECES + ", task int, ids binary"
    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        packer, tokens = Packer(p), loaded(p.tokenizer, p.attached, p.pieces)
        end = p.end_id.to_bytes(4, "little")

        def rows(more: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*more, strict=True)) or [[]] * len(target)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

        def finished() -> list[tuple]:
            nonlocal number
            out = []
            for pieces in packer.taken():
                out += [(*row, None, None) for row in _rows(pieces, (task << 33) + number)]
                number += 1
            return out

        for batch in batches:
            ids = tokens.encode(batch.column("text").to_pylist())
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                packer.add(Piece(doc_id, 0, len(own) // 4 + 1, own + end))
            yield rows(finished())
        tail = packer.close()
        yield rows(finished() + [(x.doc_id, x.start, len(x), 0, x.doc_tokens, 0, 0, task, x.ids) for x in tail])

    return with_long_id(docs).withColumn("text", F.col("text").cast("string")).mapInArrow(run, schema)


def pack(docs: DataFrame, p: Packing) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Documents are packed where they are read, without a shuffle. Only the last window of each task
    travels, with its ids, and ``fan_in`` of them are filled from each other, so one partly filled
    sequence is left for ``fan_in`` tasks. A document is cut only when it is longer than a
    sequence, when no open window has room for it, or at the end of a task.

    A null or empty text is its end id alone. Repeated rows are packed each; rows without a doc_id
    too. An empty table gives no rows. Other columns are ignored.
    """
    first = materialize(_first_level(docs, p), "packed")

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        packer = Packer(p)
        for row in group.sort_values(["task", "place"]).itertuples():
            doc_id = None if pd.isna(row.doc_id) else int(row.doc_id)
            packer.open.append((row.length, [Piece(doc_id, row.start, row.doc_tokens, row.ids)]))
        packer.open.sort(key=lambda w: 0)  # keeps the order of tasks
        tail = packer.close()
        sequences = packer.taken() + ([tail] if tail else [])
        base = (1 << 62) + (int(group["task"].iloc[0]) // p.fan_in << 20)
        out = [row for i, pieces in enumerate(sequences) for row in _rows(pieces, base + i)]
        frame = pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])
        return frame.astype({"doc_id": "Int64"})

    tails = first.filter(F.col("task").isNotNull()).withColumn("place", F.monotonically_increasing_id())
    merged = tails.groupBy(F.floor(F.col("task") / p.fan_in)).applyInPandas(merge, PIECES)
    return first.filter(F.col("task").isNull()).drop("task", "ids").unionByName(merged)
