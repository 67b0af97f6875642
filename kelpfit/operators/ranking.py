"""Seeded ranks over a whole table without sorting it in one task.

Rows are ordered by the MD5 of their key. Ranks are located by counting hash
prefixes, so a cut "first r rows" becomes a literal predicate on the hash. Where a cut
falls between rows of one key, these are ordered by the MD5 of all their columns, found
in the same way; the predicate then asks for it at that one hash only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpfit.functions.hashing import key_hash

PREFIX_DIGITS = 3
BUCKET_ROWS = 1_000_000
HASH_DIGITS = 36  # an MD5 and what may stand before it
NONE_BELOW = ""
ALL_BELOW = "g"  # sorts after every hex digit


def row_order(seed: object, key: str | Sequence[str], shuffle: int = 0) -> Column:
    """Order column; each extra shuffle number gives an unrelated order."""
    return key_hash(f"{seed}" if not shuffle else f"{seed}/{shuffle}", key)


def content(df: DataFrame) -> Column:
    """MD5 of all columns, by name: the order of rows that share a key."""
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x02")) for c in sorted(df.columns)]
    return F.md5(F.concat_ws("\x01", *texts))


def up_to(df: DataFrame, order: Column, cut: str) -> Column:
    """Whether a row of ``df`` is at or before a cut that :func:`rank_cutoffs` gave."""
    if "/" not in cut:
        return order <= cut
    h, rest = cut.split("/")
    return (order < h) | ((order == h) & (content(df) <= rest))


def rank_cutoffs(
    df: DataFrame, order: Column, ranks: Sequence[int] | Callable[[int], Sequence[int]], digits: int | None = None,
    by_content: bool = False
) -> tuple[int, list[str]]:
    """Row count and, for every rank ``r``, the hash of the r-th row in order.

    ``ranks`` may be a function of the row count. The first pass collects a count per
    prefix of ``digits`` digits, every further one at most 4,096 per boundary; only the rows that share a boundary's
    prefix are ever ranked, and never more than ``BUCKET_ROWS`` of them: a prefix with a single hash is not
    ranked, however many rows have it. With ``by_content`` a cut may fall between rows of one hash and
    is then to be read by :func:`up_to`; without it, and for rows that are equal in all
    columns, such a cut is an error.
    """
    hashed, digits = df.select(order.alias("h")), digits or PREFIX_DIGITS
    counts = _prefix_counts(hashed, digits)
    n = sum(counts.values())
    wanted = list(ranks(n) if callable(ranks) else ranks)
    if any(r < 0 or r > n for r in wanted):
        raise ValueError(f"rank outside 0..{n}")
    inner = sorted({r for r in wanted if 0 < r < n})

    # rank -> (prefix, rank inside the prefix, rows in the prefix)
    place, settled = dict(zip(inner, _locate(counts, inner))), {}
    while digits < HASH_DIGITS:
        wide = {p for p, _, rows in place.values() if rows > BUCKET_ROWS}
        if not wide:
            break
        crowded = hashed.where(F.substring("h", 1, digits).isin(sorted(wide)))
        single = _single_hashes(crowded, digits)
        for r, (prefix, inside, rows) in list(place.items()):
            if prefix in single:
                settled[r] = (single[prefix], inside, inside < rows)
                del place[r]
        wide -= set(single)
        if not wide:
            break
        finer = _prefix_counts(
            hashed.where(F.substring("h", 1, digits).isin(sorted(wide))), digits + PREFIX_DIGITS
        )
        for r, (prefix, inside, rows) in place.items():
            if prefix in wide:
                part = {p: c for p, c in finer.items() if p.startswith(prefix)}
                place[r] = _locate(part, [inside])[0]
        digits += PREFIX_DIGITS

    edge = {0: NONE_BELOW, n: ALL_BELOW}
    for r, (h, nth, tied) in (settled | _rows_at(hashed, place)).items():
        edge[r] = h
        if tied and not by_content:
            raise ValueError("the key columns do not identify rows uniquely")
        if tied:
            edge[r] = f"{h}/{rank_cutoffs(df.where(order == h), content(df), [nth])[1][0]}"
    return n, [edge[r] for r in wanted]


def _prefix_counts(hashed: DataFrame, digits: int) -> dict[str, int]:
    rows = hashed.groupBy(F.substring("h", 1, digits).alias("p")).count().collect()
    return {r["p"]: r["count"] for r in rows}


def _single_hashes(hashed: DataFrame, digits: int) -> dict[str, str]:
    """Prefixes all of whose rows have one hash, with that hash."""
    rows = hashed.groupBy(F.substring("h", 1, digits).alias("p")).agg(
        F.min("h").alias("low"), F.max("h").alias("high")).where("low = high").collect()
    return {r["p"]: r["low"] for r in rows}


def _locate(counts: dict[str, int], ranks: Sequence[int]) -> list[tuple[str, int, int]]:
    out, seen, position = [], 0, 0
    ordered = sorted(counts.items())
    for r in sorted(ranks):
        while seen + ordered[position][1] < r:
            seen += ordered[position][1]
            position += 1
        out.append((ordered[position][0], r - seen, ordered[position][1]))
    return out


def _rows_at(hashed: DataFrame, place: dict[int, tuple[str, int, int]]) -> dict[int, tuple[str, int, bool]]:
    """Per rank the hash, the place among the rows that have it, and whether more of them follow."""
    if not place:
        return {}
    lengths = sorted({len(p) for p, _, _ in place.values()})
    prefixes = sorted({p for p, _, _ in place.values()})
    prefix = F.coalesce(
        *[
            F.when(F.substring("h", 1, n).isin([p for p in prefixes if len(p) == n]),
                   F.substring("h", 1, n))
            for n in lengths
        ]
    )
    w = Window.partitionBy("p").orderBy("h")
    ranked = (
        hashed.select("h", prefix.alias("p"))
        .where(F.col("p").isNotNull())
        .withColumn("r", F.row_number().over(w))
        .withColumn("next", F.lead("h").over(w))
        .withColumn("nth", F.row_number().over(Window.partitionBy("p", "h").orderBy("r")))
    )
    spots = {(p, inside): r for r, (p, inside, _) in place.items()}
    wanted = F.struct(F.col("p"), F.col("r")).isin(
        [F.struct(F.lit(p), F.lit(inside)) for p, inside in spots]
    )
    found = {}
    for row in ranked.where(wanted).collect():
        found[spots[(row["p"], row["r"])]] = (row["h"], row["nth"], row["h"] == row["next"])
    return found


def with_position(df: DataFrame, order: Column, name: str = "position") -> DataFrame:
    """Add each row's 0-based place in the seeded order.

    Rows are ranked inside hash-prefix buckets and shifted by the count of the
    buckets before theirs; the prefix length follows the table size, and the
    offset table holds at most one row per prefix.
    """
    hashed = df.withColumn("_h", order)
    n, digits = df.count(), 1
    while 16 ** digits * max(1, BUCKET_ROWS // 16) < n:
        digits += 1
    hashed = hashed.withColumn("_p", F.substring("_h", 1, digits))
    offsets = (
        hashed.groupBy("_p")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_before",
            F.coalesce(
                F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .drop("_n")
    )
    inside = F.row_number().over(Window.partitionBy("_p").orderBy("_h")) - 1
    # one offset row per prefix: a few bytes each, sent to all tasks while there are few
    if digits <= 4:
        offsets = F.broadcast(offsets)
    return (
        hashed.withColumn("_inside", inside)
        .join(offsets, "_p")
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_h", "_p", "_inside", "_before")
    )
