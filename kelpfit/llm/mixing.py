"""Mixing sources to target weights by systematic sampling.

Every document of a source expects target / source size copies. With the documents
of a source in a fixed order (by size, so that neighbours are alike), running sums
of the expected copies are shifted by one random offset per source; a document is
emitted once for each integer that its interval crosses. A source's taken words
then differ from its target by less than its longest document, since every running
sum of copies is off by less than one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelpfit.functions.hashing import hash_uniform
from kelpfit.llm.common import WORD, numbered, packed, stored, text_of, unpacked

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2.0


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   most: float = MOST_COPIES) -> DataFrame:
    """source, source_size, n_docs, target from one row (source, source_size, n_docs) per source.

    Sources in code-point order (null last) get the weights in turn. They share
    ``share`` of all words by weight; no target exceeds ``most`` times its source,
    and what is over is shared again among the others until none is above. That
    fixed point is found in one pass: sources with the least room per weight fill
    up first, so sorted by room per weight the full ones come first.

    There is one row per source, and sources are few: the two windows here span them all.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("_w", weight).withColumn("_room", F.lit(float(most)) * F.col("source_size"))
    by_room = Window.orderBy(F.col("_room") / F.col("_w"), F.col("source").isNull(), "source")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0.0)
    rows = (
        rows.withColumn("_full", F.coalesce(F.sum("_room").over(before), zero))
        .withColumn("_used", F.coalesce(F.sum("_w").over(before), zero))
        .withColumn("_all", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn("_weights", F.sum("_w").over(whole))
        # words per weight if all before this source are full and it is not
        .withColumn("_level", (F.col("_all") - F.col("_full")) / (F.col("_weights") - F.col("_used")))
    )
    fits = F.col("_level") * F.col("_w") <= F.col("_room")
    level = F.min(F.when(fits, F.struct(F.col("_room") / F.col("_w"), "_level"))).over(whole).getField("_level")
    return rows.withColumn("_final", level).select(
        "source", "source_size", "n_docs",
        F.when(F.col("_final").isNull(), F.col("_room"))
        .otherwise(F.least(F.col("_room"), F.col("_final") * F.col("_w"))).alias("target"))


def _ranked(rows: DataFrame) -> DataFrame:
    """Add ``rank``, from 1, inside each source by size; no task sees a whole source.

    Rows are range-partitioned in that order; a row's rank is its place in its
    partition plus the rows of its source in earlier partitions.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["source", "size", "_h", "doc_id", "_rid"]
    rows = stored(
        rows.withColumn("_h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).repartitionByRange(parts, *order)
        .withColumn("_part", F.spark_partition_id()), "by_size")
    earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("source", "_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("source", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    same = (F.col("r._part") == F.col("o._part")) & F.col("r.source").eqNullSafe(F.col("o.source"))
    place = F.row_number().over(Window.partitionBy("_part", "source").orderBy(*order[1:]))
    placed = rows.withColumn("_place", place)
    return placed.alias("r").join(offsets.alias("o"), same).select(
        "r._rid", "r.doc_id", "r.source", "r.size", (F.col("_place") + F.col("_before")).alias("rank"))


def sampled_copies(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   most: float = MOST_COPIES, seed: int = 0) -> DataFrame:
    """How often the mix takes each document.

    Takes ``doc_id``, ``text`` and ``source``; other columns are ignored. Returns
    one row per input row: _rid, doc_id, size, source, source_size, target, copies, taken.
    Size is the number of words; a null text has none and is taken as often as
    others of its source, for nothing. Null sources form one source, the last.
    Repeated rows are documents of their own. A source without words has the target
    0 and no copies. An empty table gives an empty result. Reruns over the same
    files agree: order and offset come from hashes.
    """
    rows = stored(numbered(docs.select("doc_id", "text", "source")).select(
        "_rid", "doc_id", F.col("source").cast("string").alias("source"),
        F.regexp_count(text_of("text"), F.lit(WORD)).cast("long").alias("size")), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = source_targets(sizes, weights, share, most)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = hash_uniform(f"mix-{seed}", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")))
    targets = targets.select(F.col("source").alias("_s"), "source_size", "target",
                             expected.alias("_e"), offset.alias("_u"))
    upto = lambda rank: F.floor(F.col("_e") * rank + F.col("_u"))
    copies = (upto(F.col("rank")) - upto(F.col("rank") - 1)).cast("long")
    return (
        _ranked(rows).join(targets, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("copies", copies)
        .select("_rid", "doc_id", "size", "source", "source_size", "target", "copies",
                (F.col("copies") * F.col("size")).alias("taken"))
    )


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
          most: float = MOST_COPIES, seed: int = 0) -> DataFrame:
    """The mix itself: the documents with all their columns, each as often as it is taken."""
    taken = sampled_copies(docs, weights, share, most, seed).where("copies > 0").select("_rid", "copies")
    rows = numbered(packed(docs)).join(taken, "_rid")
    again = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")
    return unpacked(rows.select("_row", again), docs.columns)
