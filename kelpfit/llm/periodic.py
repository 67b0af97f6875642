"""Stretches of words that repeat with a period, and texts without the repetitions.

A run is a maximal stretch with smallest period q and at least ``min_periods``
periods and ``min_length`` words. Each of its words therefore occurs in it that many
times, so a word that is rarer within a segment cannot lie in any run of the segment
and splits it. Splitting goes on inside the pieces until nothing changes; ordinary
prose falls apart at once, and only the surviving segments are scanned.

A surviving segment is scanned lag by lag. A run of lag q, s <= q < 2s with s a power
of two, matches itself over at least 2q words and so over a whole aligned block of s
words: lags are tried only where an aligned block occurs again at that distance.
Blocks are compared by integer names given to pairs of names (no hashes), and the
same names tell in a few steps how far a match reaches to both sides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpfit.llm.common import WORD, text_of

MIN_LENGTH = 24
MIN_PERIODS = 3
#: Characters of texts whose words a task holds at once (a longer text is held alone).
HELD_CHARS = 4_000_000
#: Positions compared in one step.
STEP = 1 << 20


def surviving_segments(codes: np.ndarray, min_length: int, min_periods: int) -> list[tuple[int, int]]:
    """Stretches in which every word occurs often enough to lie in a run."""
    open_, done = [(0, len(codes))], []
    while open_:
        low, high = open_.pop()
        if high - low < min_length:
            continue
        _, place, counts = np.unique(codes[low:high], return_inverse=True, return_counts=True)
        rare = np.flatnonzero(counts[place] < min_periods)
        if not len(rare):
            done.append((low, high))
            continue
        edges = np.concatenate(([-1], rare, [high - low]))
        wide = np.flatnonzero(np.diff(edges) > min_length)
        open_ += [(low + int(edges[i]) + 1, low + int(edges[i + 1])) for i in wide]
    return sorted(done)


def _names(codes: np.ndarray) -> list[np.ndarray]:
    """Level k names every stretch of 2^k words: equal names, equal words."""
    levels, size = [codes.astype(np.int64)], 1
    while 2 * size <= len(codes):
        last, n = levels[-1], len(codes) - 2 * size + 1
        pair = last[:n] * (int(last.max()) + 1) + last[size:size + n]
        levels.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
        size *= 2
    return levels


def _reach(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``a`` and ``b`` on are equal, forwards (1) or backwards (-1)."""
    total = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        names, size = levels[k], 1 << k
        x, y = (a + total, b + total) if step > 0 else (a - total - size, b - total - size)
        inside = (x >= 0) & (y < len(names))
        equal = names[np.where(inside, x, 0)] == names[np.where(inside, y, 0)]
        total += np.where(inside & equal, size, 0)
    return total


def segment_runs(codes: np.ndarray, min_length: int, min_periods: int) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of one segment."""
    m, found = len(codes), []
    levels = _names(codes)
    covered = np.zeros(m, np.int64)  # where the longest known run over a word ends
    for k, names in enumerate(levels):
        s = 1 << k
        if min_periods * s > m:
            break
        anchors, lags = np.arange(0, m - 2 * s + 1, s), np.arange(s, 2 * s)
        seen = set()
        per_step = max(1, STEP // s)
        for first in range(0, len(anchors), per_step):
            a = anchors[first:first + per_step]
            b = a[:, None] + lags[None, :]
            inside = b < len(names)
            again = inside & (names[np.where(inside, b, 0)] == names[a][:, None])
            # within a known run of a period up to s, a lag up to 2s is a multiple of that period
            again &= covered[a][:, None] < b + s
            row, lag = np.nonzero(again)
            x, q = a[row], lags[lag]
            left, right = _reach(levels, x, x + q, -1), _reach(levels, x, x + q, 1)
            length = left + right + q
            long = length >= np.maximum(min_length, min_periods * q)
            seen.update(zip(q[long].tolist(), (x - left)[long].tolist(), length[long].tolist()))
        new = []
        for q, start, length in sorted(seen):
            end = start + length
            if covered[start] < end and not any(p < q and lo <= start and end <= hi for p, lo, hi in new):
                new.append((q, start, end))
        for q, start, end in new:
            found.append((start, end - start, q))
            covered[start:end] = np.maximum(covered[start:end], end)
    return found


def word_runs(words: list[str], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS):
    """All runs (start, length, period) of a list of words, by start and period."""
    if len(words) < min_length:
        return []
    numbers: dict[str, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    runs = []
    for low, high in surviving_segments(codes, min_length, min_periods):
        _, local = np.unique(codes[low:high], return_inverse=True)
        runs += [(low + start, length, q) for start, length, q in segment_runs(local, min_length, min_periods)]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed_words(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """Words without what any run repeats after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, q in runs:
        keep[start + q:start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def collapsed_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """Runs of every text, and its words without the repetitions.

    Takes ``doc_id`` and ``text``; other columns are ignored, whatever their names.
    Returns one row per input row: doc_id, n_words long, runs
    array<struct<start, length, period>> by start and period, and collapsed_text, the
    kept words joined by one space. Words are counted from 0. ``min_periods`` is three or
    more; the smallest period decides. A null, empty or blank text has no words, no
    runs and an empty collapsed text; repeated rows are treated one by one; null ids
    stay null; an empty table gives an empty result. Texts of any length are scanned
    whole: a segment of m words takes of the order of m log m steps and memory. No row
    leaves its task, so there is no shuffle and no hot key.
    """
    if min_periods < 3 or min_length < 1:
        raise ValueError("a run needs a length of one or more and three periods or more")
    id_type = dict(docs.dtypes)["doc_id"]
    run_type = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    word = re.compile(WORD)

    def row(text: str):
        words = word.findall(text)
        runs = word_runs(words, min_length, min_periods)
        named = [dict(zip(("start", "length", "period"), r)) for r in runs]
        return len(words), named, " ".join(collapsed_words(words, runs))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = 0
            while low < batch.num_rows:
                high, chars = low, 0
                rows = []
                while high < batch.num_rows and chars < HELD_CHARS:
                    text = batch.column("_text")[high].as_py()
                    rows.append(row(text))
                    chars += len(text)
                    high += 1
                yield pa.record_batch(
                    [batch.column("doc_id").slice(low, high - low), pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.list_(run_type)), pa.array([r[2] for r in rows], pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed_text"])
                low = high

    return docs.select("doc_id", text_of("text").alias("_text")).mapInArrow(
        scan, f"doc_id {id_type}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
              "collapsed_text string")


def highest_exponent(runs: str = "runs"):
    """The run with the most periods by exact fractions; the first of equals."""
    empty = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(
        runs, empty, lambda best, r: F.when(
            best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
