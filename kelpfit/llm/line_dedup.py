"""Lines that many documents share, found with two Bloom filters.

A first pass over the text sets bits for every line key that a document holds: in a
filter of keys seen at least once and, where the bits were set before, in a filter
of keys seen at least twice. Keys that miss the second filter are in one document
only and go no further. Only the others, the suspected repeats, are shuffled and
counted by the key itself, so the filters save work and decide nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpfit.llm.common import numbered, stored, text_of

#: Bits of each filter, a fixed bound on what is broadcast (16 MB). Beyond about
#: 30 million keys it fills up, and more lines count as suspects; results stay the same.
FILTER_BITS = 1 << 27
HASHES = 2
#: Length of the broadcast table of row numbers, which tells most texts that they lose nothing.
BUCKETS = 1 << 20
#: Line keys with more than this share (one in so many) of all suspects are joined by broadcast.
HOT_KEYS = 1000
SEGMENT_BITS = 1 << 18
BLANKS = b" \t\n\v\f\r"


def line_key(line: bytes) -> bytes:
    """Blanks stripped at both ends, A-Z lower-cased."""
    return line.strip(BLANKS).lower()


def _keys(text: str, min_chars: int) -> dict[bytes, list[int]]:
    """Numbers of the lines under each key long enough to count."""
    found: dict[bytes, list[int]] = {}
    for i, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
        key = line_key(line)
        # a code point has at least one byte that does not continue another
        if len(key) >= min_chars and (len(key) >= 4 * min_chars
                                      or sum(b & 0xC0 != 0x80 for b in key) >= min_chars):
            found.setdefault(key, []).append(i)
    return found


def _bits(keys: list[bytes], bits: int) -> np.ndarray:
    """Bit places of every key, one row per key."""
    both = np.frombuffer(b"".join(map(xxhash.xxh128_digest, keys)), dtype=">u8").reshape(-1, 2)
    step = both[:, 1] | np.uint64(1)
    return np.stack([(both[:, 0] + np.uint64(k) * step) % np.uint64(bits) for k in range(HASHES)], axis=1).astype(np.int64)


def _dense(data: bytes) -> np.ndarray:
    """Bitmap of a segment that is stored as a bitmap or, while shorter, as places."""
    size = SEGMENT_BITS // 8
    if len(data) == size:
        return np.frombuffer(data, np.uint8)
    bits = np.zeros(SEGMENT_BITS, np.uint8)
    bits[np.frombuffer(data, "<u4")] = 1
    return np.packbits(bits, bitorder="little")


def _sparse(bitmap: np.ndarray) -> bytes:
    if np.count_nonzero(bitmap) < len(bitmap) // 32:
        places = np.flatnonzero(np.unpackbits(bitmap, bitorder="little")).astype("<u4")
        if 4 * len(places) < len(bitmap):
            return places.tobytes()
    return bitmap.tobytes()


def repeated_filter(docs: DataFrame, min_chars: int, per_document: bool = True, bits: int = FILTER_BITS) -> bytes:
    """Bitmap of the keys that are seen twice or more, and by chance of some others.

    Takes ``_text``. A document counts once for each of its keys if ``per_document``,
    else once for each line.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            found = [_keys(t, min_chars) for t in batch.column(0).to_pylist()]
            keys = [k for f in found for k, lines in f.items() for _ in (lines[:1] if per_document else lines[:2])]
            if not keys:
                continue
            places = _bits(keys, bits)
            # a key is new if one of its bits is; keys repeated in the batch are found by sorting
            hashed = places[:, 0] * np.int64(bits) + places[:, 1]
            _, first, count = np.unique(hashed, return_index=True, return_counts=True)
            places, again = places[first], count > 1
            known = np.ones(len(places), bool)
            for k in range(HASHES):
                known &= (once[places[:, k] >> 3] >> (places[:, k] & 7).astype(np.uint8)) & 1 == 1
            repeats = places[known | again].ravel()
            np.bitwise_or.at(twice, repeats >> 3, np.uint8(1) << (repeats & 7).astype(np.uint8))
            places = places.ravel()
            np.bitwise_or.at(once, places >> 3, np.uint8(1) << (places & 7).astype(np.uint8))
        size = SEGMENT_BITS // 8
        for s in range(bits // SEGMENT_BITS):
            part = once[s * size:(s + 1) * size]
            if part.any():
                yield pa.record_batch([
                    pa.array([s], pa.int32()), pa.array([_sparse(part)], pa.binary()),
                    pa.array([_sparse(twice[s * size:(s + 1) * size])], pa.binary())],
                    names=["segment", "once", "twice"])

    def merge(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        once, twice = np.zeros(SEGMENT_BITS // 8, np.uint8), np.zeros(SEGMENT_BITS // 8, np.uint8)
        for a, b in zip(parts["once"], parts["twice"]):
            a, b = _dense(a), _dense(b)
            twice |= b | (once & a)
            once |= a
        return pd.DataFrame({"segment": [key[0]], "twice": [twice.tobytes()]})

    parts = docs.select("_text").mapInArrow(scan, "segment int, once binary, twice binary")
    merged = parts.groupBy("segment").applyInPandas(merge, "segment int, twice binary")
    out = np.zeros(bits // 8, np.uint8)
    size = SEGMENT_BITS // 8
    for row in merged.collect():  # at most bits / SEGMENT_BITS rows, whatever the input
        out[row["segment"] * size:(row["segment"] + 1) * size] = np.frombuffer(row["twice"], np.uint8)
    return out.tobytes()


def suspects(docs: DataFrame, filter_: bytes, min_chars: int, bits: int = FILTER_BITS) -> DataFrame:
    """_rid, key, lines of every key of a document that the filter has."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            rids, keys, lines = [], [], []
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for key, at in _keys(text, min_chars).items():
                    rids.append(rid)
                    keys.append(key)
                    lines.append(at)
            hit = np.ones(len(keys), bool)
            if keys:
                places = _bits(keys, bits)
                for k in range(HASHES):
                    hit &= (bitmap[places[:, k] >> 3] >> (places[:, k] & 7).astype(np.uint8)) & 1 == 1
            at = np.flatnonzero(hit)
            yield pa.record_batch([
                pa.array([rids[i] for i in at], pa.int64()), pa.array([keys[i] for i in at], pa.binary()),
                pa.array([lines[i] for i in at], pa.list_(pa.int32()))], names=["_rid", "key", "lines"])

    return docs.select("_rid", "_text").mapInArrow(scan, "_rid long, key binary, lines array<int>")


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals, dropped, texts = [], [], []
        for text, drop in zip(batch.column("_text").to_pylist(), batch.column("_drop").to_pylist()):
            lines = text.split("\n")
            gone = set(drop or ())
            totals.append(len(lines))
            dropped.append(len(gone))
            texts.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text)
        yield pa.record_batch([
            batch.column("_rid"), batch.column("doc_id"), pa.array(totals, pa.int64()),
            pa.array(dropped, pa.int64()), pa.array(texts, pa.string())],
            names=["_rid", "doc_id", "n_lines", "n_dropped", "kept_text"])


def _matched(found: DataFrame, common: DataFrame) -> DataFrame:
    """Suspects whose key is common. The hottest keys, a bounded number, are joined without a shuffle."""
    # at most HOT_KEYS keys can have more than one in HOT_KEYS suspects each
    hot = F.broadcast(common.where(F.col("_keys") > found.count() / HOT_KEYS))
    rest = found.join(hot.select("key"), "key", "left_anti").join(common, "key")
    return found.join(hot, "key").unionByName(rest)


def drop_repeated_lines(docs: DataFrame, min_count: int = 10, min_chars: int = 1, keep: str = "none",
                        bits: int = FILTER_BITS) -> DataFrame:
    """Remove lines whose key is common.

    Takes ``doc_id`` and ``text``; other columns are ignored. Returns one row per
    input row: _rid, doc_id, n_lines, n_dropped, kept_text. With ``keep="none"`` a key
    found in ``min_count`` documents or more loses all its lines everywhere; with
    ``keep="first"`` a key with ``min_count`` lines or more keeps the first of them
    (by row, then line). Keys below ``min_chars`` code points are never dropped. A
    null or empty text is one empty line, a very long one is split whole. Repeated rows
    are documents of their own, null ids stay null, an empty table gives an empty
    result. Only suspected keys, and texts that lose a line, are shuffled.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep must be 'none' or 'first'")
    if min_count < 2:
        raise ValueError("min_count must be 2 or more")
    rows = numbered(docs.select("doc_id", "text")).select("_rid", "doc_id", text_of("text").alias("_text"))
    bitmap = repeated_filter(rows, min_chars, keep == "none", bits)
    found = stored(suspects(rows, bitmap, min_chars, bits), "suspects")
    seen = F.count(F.lit(1)) if keep == "none" else F.sum(F.size("lines"))
    first = F.min(F.struct("_rid", F.element_at("lines", 1).alias("line")))
    common = found.groupBy("key").agg(seen.alias("_n"), first.alias("_first"), F.count(F.lit(1)).alias("_keys")).where(
        F.col("_n") >= min_count)
    common = stored(common, "common")
    lines = F.col("lines")
    if keep == "first":
        lines = F.when(F.col("_first._rid") == F.col("_rid"), F.slice("lines", 2, F.greatest(F.size("lines"), F.lit(1)))).otherwise(lines)
    drop = _matched(found, common).select("_rid", lines.alias("_lines"))
    drop = stored(drop.groupBy("_rid").agg(F.flatten(F.collect_list("_lines")).alias("_drop")), "drops")
    # most texts lose nothing; a table of fixed length lets them stay where they are
    touched = F.broadcast(drop.select(_bucket()).distinct())
    on = _bucket() == F.col("_bucket")
    id_type = dict(docs.dtypes)["doc_id"]
    # lists of lines grow with the texts: they are not broadcast, however few there are
    cut = rows.join(touched, on, "left_semi").join(drop.hint("merge"), "_rid", "left").select("_rid", "doc_id", "_text", "_drop").mapInArrow(
        _rebuild, f"_rid long, doc_id {id_type}, n_lines long, n_dropped long, kept_text string")
    whole = rows.join(touched, on, "left_anti").select(
        "_rid", "doc_id", (F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"), F.col("_text").alias("kept_text"))
    return cut.unionByName(whole)


def _bucket() -> Column:
    return F.pmod(F.xxhash64("_rid"), F.lit(BUCKETS)).cast("int").alias("_bucket")
