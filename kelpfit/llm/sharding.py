"""Sharding through a fixed number of virtual slots.

A record's slot is a hash of its key, for ever. Which shard owns a slot is a small
versioned table: the first version deals slots in turn, later versions are edits of
it, made after adding up the bytes of every slot. Moving a slot moves no other.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kelpfit.llm.common import numbered, stored

SLOTS = 8192
#: Bytes that a record takes besides its text.
OVERHEAD = 8


@dataclass(frozen=True)
class SlotMap:
    """Owner of every slot. ``owners`` has one shard per slot, so its size is fixed."""

    version: int
    shards: int
    owners: tuple[int, ...]

    @staticmethod
    def dealt(shards: int, slots: int = SLOTS) -> SlotMap:
        if not 1 <= shards <= slots:
            raise ValueError("shards must be between 1 and the number of slots")
        return SlotMap(1, shards, tuple(s % shards for s in range(slots)))

    def rebalanced(self, load: dict[int, int]) -> SlotMap:
        """Next version: slots move from the fullest to the emptiest shard while that helps."""
        owned: list[list[tuple[int, int]]] = [[] for _ in range(self.shards)]
        for slot, shard in enumerate(self.owners):
            if load.get(slot, 0):
                owned[shard].append((load[slot], slot))
        total = [sum(b for b, _ in own) for own in owned]
        for own in owned:
            own.sort()
        owners = list(self.owners)
        while True:
            full, empty = total.index(max(total)), total.index(min(total))
            # the largest slot that leaves both sides nearer to each other than before
            gap = total[full] - total[empty]
            moved = next((x for x in reversed(owned[full]) if 2 * x[0] <= gap), None)
            swap = None
            if moved is None:
                swap = _best_swap(owned[full], owned[empty], gap)
                if swap is None:
                    break
                moved = swap[0]
                owned[empty].remove(swap[1])
                owned[full].append(swap[1])
                owned[full].sort()
                owners[swap[1][1]] = full
            owned[full].remove(moved)
            owned[empty].append(moved)
            owned[empty].sort()
            owners[moved[1]] = empty
            shift = moved[0] - (swap[1][0] if swap else 0)
            total[full] -= shift
            total[empty] += shift
        return SlotMap(self.version + 1, self.shards, tuple(owners))

    def grown(self) -> SlotMap:
        """Next version with one more shard, which takes slots from all others and gives none."""
        new, owners = self.shards, list(self.owners)
        heap = [(-owners.count(s), s) for s in range(self.shards)]
        heapq.heapify(heap)
        by_shard = {s: [i for i, o in enumerate(owners) if o == s] for s in range(self.shards)}
        for _ in range(len(owners) // (self.shards + 1)):
            count, shard = heapq.heappop(heap)
            owners[by_shard[shard].pop()] = new
            heapq.heappush(heap, (count + 1, shard))
        return SlotMap(self.version + 1, self.shards + 1, tuple(owners))

    def owner_of(self, slot: Column) -> Column:
        """Shard of a slot, looked up in a literal array of fixed length."""
        table = F.split(F.lit(",".join(map(str, self.owners))), ",").cast("array<int>")
        return F.element_at(table, (slot + 1).cast("int"))

    def save(self, spark: SparkSession, folder: str) -> None:
        """Add this version to the stored map; versions are never overwritten."""
        rows = spark.range(len(self.owners)).select(
            F.col("id").cast("int").alias("slot"), self.owner_of(F.col("id")).alias("shard"),
            F.lit(self.shards).alias("shards"))
        rows.coalesce(1).write.parquet(f"{folder.rstrip('/')}/version={self.version}")

    @staticmethod
    def load(spark: SparkSession, folder: str, version: int | None = None) -> SlotMap:
        """A stored version, the latest unless one is named."""
        rows = spark.read.option("basePath", folder).parquet(folder)
        if version is None:
            version = rows.agg(F.max("version")).first()[0]
        rows = rows.where(F.col("version") == version).orderBy("slot").collect()  # one row per slot
        return SlotMap(int(version), rows[0]["shards"], tuple(r["shard"] for r in rows))


def _best_swap(full, empty, gap):
    """Pair of slots whose exchange narrows the gap most, or None."""
    best, found, j = gap, None, 0
    for x in full:
        # partners are walked in step: the wanted size rises with x
        while j < len(empty) - 1 and abs(gap - 2 * (x[0] - empty[j + 1][0])) <= abs(gap - 2 * (x[0] - empty[j][0])):
            j += 1
        if empty and x[0] > empty[j][0]:
            left = abs(gap - 2 * (x[0] - empty[j][0]))
            if left < best:
                best, found = left, (x, empty[j])
    return found


def slot_of(parts: list[Column], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(slots)).cast("int")


def record_sizes(docs: DataFrame) -> DataFrame:
    """_rid, doc_id, size and text_crc32 of every record."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return numbered(docs.select("doc_id", "text")).select(
        "_rid", "doc_id", (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"),
        F.crc32(raw).cast("long").alias("text_crc32"))


RECORD = ["doc_id", "text_crc32", "size"]


def with_slots(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Add ``copy`` and ``virtual_slot`` to stored records: a hash of the record itself.

    ``copy`` counts fully equal records from 0 on, so that many of them still spread; which
    of them gets which number makes no difference. They are numbered within their input
    partition first and then across partitions, so that a hot record is no task.
    """
    repeated = stored(rows.groupBy(*RECORD).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "repeated")
    marked = rows.withColumn("copy", F.lit(0).cast("long"))
    if repeated.limit(1).count():
        l, r = rows.alias("l"), repeated.alias("r")
        equal = reduce(lambda x, y: x & y, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in RECORD])
        again = l.join(r, equal, "left_semi").withColumn("_part", F.shiftright("_rid", 33))
        w = Window.partitionBy(*RECORD, "_part").orderBy("_rid")
        again = again.withColumn("_place", F.row_number().over(w) - 1)
        parts = again.groupBy(*RECORD, "_part").agg(F.count(F.lit(1)).alias("_n"))
        before = F.sum("_n").over(Window.partitionBy(*RECORD).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
        parts = parts.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(RECORD)], F.col("_part").alias("_p"),
                             F.coalesce(before, F.lit(0)).alias("_before"))
        on = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(RECORD)])
        again = again.join(parts, on & (F.col("_part") == F.col("_p"))).withColumn("copy", F.col("_before") + F.col("_place"))
        single = l.join(r, equal, "left_anti")
        marked = again.select(*rows.columns, "copy").unionByName(
            single.select(*rows.columns, F.lit(0).cast("long").alias("copy")))
    return marked.withColumn("virtual_slot", slot_of([F.col(c) for c in (*RECORD, "copy")], slots))


def shard_by_bytes(docs: DataFrame, shards: int = 24, slots: int = SLOTS, base: SlotMap | None = None,
                   folder: str | None = None) -> DataFrame:
    """Put records into shards of nearly equal bytes.

    Takes ``doc_id`` and ``text``; other columns are ignored. Returns one row per
    input row: doc_id, size, text_crc32, virtual_slot, map_version, shard, slot. The
    virtual slot depends on the record alone (doc_id, checksum, size, and a count of
    fully equal records), not on the files it is read from. ``slot`` numbers the rows of
    a shard from 0 without gaps, by virtual slot and then by doc_id. A null text has no
    bytes (checksum 0) and the fixed overhead; null ids, repeated rows, ties and very
    long texts are ordinary records. An empty table gives an empty result. ``base`` is
    the map to edit (default: dealt in turn); with ``folder`` both versions are stored
    there, and records are placed by the map that is read back.
    """
    spark = docs.sparkSession
    rows = stored(with_slots(stored(record_sizes(docs), "sizes"), slots), "records")
    sums = rows.groupBy("virtual_slot").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()  # at most one row per slot
    before = base or SlotMap.dealt(shards, slots)
    if folder is not None and base is None:
        before.save(spark, folder)
        before = SlotMap.load(spark, folder, before.version)
    after = before.rebalanced({r["virtual_slot"]: r["size"] for r in sums})
    if folder is not None:
        after.save(spark, folder)
        after = SlotMap.load(spark, folder, after.version)
    counts, next_free, first = {r["virtual_slot"]: r["n"] for r in sums}, [0] * shards, []
    for slot, shard in enumerate(after.owners):
        first.append(next_free[shard])
        next_free[shard] += counts.get(slot, 0)
    starts = F.split(F.lit(",".join(map(str, first))), ",").cast("array<bigint>")
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "copy"))
    return rows.select(
        "doc_id", "size", "text_crc32", "virtual_slot", F.lit(after.version).alias("map_version"),
        after.owner_of(F.col("virtual_slot")).alias("shard"),
        (F.element_at(starts, F.col("virtual_slot") + 1) + place - 1).cast("long").alias("slot"))
