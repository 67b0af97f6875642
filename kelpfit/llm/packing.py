"""Token ids packed into sequences of one length, as binary matrices.

Documents are encoded, cut losslessly into pieces no longer than a sequence, and
packed by best-fit decreasing: the longest piece goes first, each into the open
sequence with the least room that still takes it. That sequence is found in a
segment tree over the amounts of room. Packing happens inside each task, in windows of
a bounded number of tokens, so nothing is shuffled and memory does not grow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from kelpfit.llm.bpe import codec
from kelpfit.llm.common import numbered, text_of

WIDTH = 2048
#: Tokens packed together; more fill sequences better and take more memory.
WINDOW_TOKENS = 2_000_000


class Room:
    """Open sequences by the room they have left, in a segment tree over 0 .. width."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(width + 1)]

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        at = self.leaves + room
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Room and number of a sequence with the least room of ``least`` or more."""
        at = self.leaves + least
        if not self.count[at]:
            # up until a right neighbour has something, then down to its leftmost leaf
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.leaves
        sequence = self.open[room].pop()
        while at:
            self.count[at] -= 1
            at >>= 1
        return room, sequence


def best_fit_decreasing(lengths: list[int], width: int) -> list[list[int]]:
    """Numbers of the pieces in each sequence; every length is between 1 and ``width``."""
    room, sequences = Room(width), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = room.take(lengths[i])
        if found is None:
            found = width, len(sequences)
            sequences.append([])
        left, sequence = found
        sequences[sequence].append(i)
        if left > lengths[i]:
            room.put(left - lengths[i], sequence)
    return sequences


def packed_tokens(docs: DataFrame, path: str, width: int = WIDTH, end_id: int | None = None, pad_id: int = 0,
                  window_tokens: int = WINDOW_TOKENS) -> DataFrame:
    """Sequences of ``width`` token ids, one row each.

    Takes ``doc_id`` and ``text``; other columns are ignored. Columns: pack_id,
    n_tokens (without padding), ids and positions (little-endian unsigned integers,
    16 bits wide, or 32 for large vocabularies; positions start again at 0 with
    every segment), cu_seqlens (0, then the end of every segment), rids, doc_ids, and
    starts (where in its document each segment begins). A document longer than a sequence fills whole sequences, and its rest
    is packed like a document. ``end_id`` is appended to every document. Documents
    without tokens, null texts too, are in no sequence unless ``end_id`` is given;
    null ids and repeated rows are packed like others; an empty table gives none.
    """
    id_type = dict(docs.dtypes)["doc_id"]
    rows = numbered(docs.select("doc_id", "text")).select("_rid", "doc_id", text_of("text").alias("_text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, number, id_kind = codec(path), TaskContext.get().partitionId() << 33, None
        kind = np.dtype("<u2") if max(*one.bytes_of, pad_id, end_id or 0) < 1 << 16 else np.dtype("<u4")
        pieces: list[tuple[int, object, int, np.ndarray]] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            sequences = best_fit_decreasing([len(p[3]) for p in pieces], width)
            for lo in range(0, len(sequences), 256):
                columns: list[list] = [[] for _ in range(8)]
                for sequence in sequences[lo:lo + 256]:
                    parts = [pieces[i] for i in sequence]
                    ids, places = np.full(width, pad_id, kind), np.zeros(width, kind)
                    ends = np.cumsum([0, *[len(p[3]) for p in parts]])
                    for p, a, b in zip(parts, ends, ends[1:]):
                        ids[a:b] = p[3]
                        places[a:b] = np.arange(b - a, dtype=kind)
                    for column, value in zip(columns, (
                            number, int(ends[-1]), ids.tobytes(), places.tobytes(), ends.tolist(),
                            [p[0] for p in parts], [p[1] for p in parts], [p[2] for p in parts])):
                        column.append(value)
                    number += 1
                longs = pa.list_(pa.int64())
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), longs,
                         pa.list_(id_kind), longs]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=[
                    "pack_id", "n_tokens", "ids", "positions", "cu_seqlens", "rids", "doc_ids", "starts"])

        for batch in batches:
            id_kind = batch.schema.field("doc_id").type
            for rid, doc, text in zip(*[batch.column(c).to_pylist() for c in ("_rid", "doc_id", "_text")]):
                ids = np.array(one.encode(text) + ([] if end_id is None else [end_id]), kind)
                for start in range(0, len(ids), width):
                    pieces.append((rid, doc, start, ids[start:start + width]))
                held += len(ids)
                if held >= window_tokens:
                    yield from flush()
                    pieces, held = [], 0
        if pieces:
            yield from flush()

    return rows.mapInArrow(
        scan, "pack_id long, n_tokens long, ids binary, positions binary, cu_seqlens array<int>, rids array<long>, "
              f"doc_ids array<{id_type}>, starts array<long>")


def write_matrices(packed: DataFrame, folder: str, sequences_per_file: int = 65_536) -> None:
    """Save sequences as Parquet; read as one column, ``ids`` is a matrix in row order."""
    packed.write.option("maxRecordsPerFile", sequences_per_file).parquet(folder)


def unpacked_tokens(packed: DataFrame, width: int = WIDTH) -> DataFrame:
    """rid, ids: the tokens of every document, put together again from the sequences."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, list[int]]] = []
            for row in batch.to_pylist():
                ends = row["cu_seqlens"]
                ids = np.frombuffer(row["ids"], f"<u{len(row['ids']) // width}")
                for rid, start, a, b in zip(row["rids"], row["starts"], ends, ends[1:]):
                    out.append((rid, start, ids[a:b].tolist()))
            columns = list(zip(*out)) or [[], [], []]
            yield pa.record_batch([
                pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                pa.array(columns[2], pa.list_(pa.int32()))], names=["rid", "start", "part"])

    def together(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        ids = np.concatenate([np.asarray(p) for p in part.sort_values("start")["part"]])
        return pd.DataFrame({"rid": [key[0]], "ids": [ids]})

    return packed.select("ids", "cu_seqlens", "rids", "starts").mapInArrow(
        scan, "rid long, start long, part array<int>").groupBy("rid").applyInPandas(together, "rid long, ids array<int>")
