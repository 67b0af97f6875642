"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of a fixed number of code points. Sorting the distinct
blocks gives every block an integer name; then adjacent pairs of names are named
in the same way, level by level, until one name stands for the whole text. Two
texts have the same level and name exactly when they are equal: names are ranks of
sorted values, never hashes.

A hash is only used to carry names back to the rows. Whether it can tell all
blocks apart is checked while naming; rows under an ambiguous hash are matched by
the block itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpfit.llm.common import BLANK, hex_sha256, numbered, packed, stored, text_of, unpacked

BLOCK_CHARS = 2048
#: Names are ranks inside a slice of the hash space, so that no task sorts all values.
SLICES = 65536


def _ranked(distinct: DataFrame, values: list[str]) -> DataFrame:
    """Add ``name``, an integer that is one to one with the distinct ``values``."""
    order = Window.partitionBy("_slice").orderBy("_h", *values)
    rank = F.row_number().over(order).cast("long") - 1
    return distinct.withColumn("_slice", F.pmod("_h", F.lit(SLICES))).withColumn(
        "name", rank * SLICES + F.col("_slice"))


def _name_blocks(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """``rows`` without text but with the ``name`` of its block.

    ``blocks`` has the same rows with the block; both carry the hash ``_h``.
    """
    named = _ranked(blocks.select("_h", "_block").distinct(), ["_block"])
    same = Window.partitionBy("_slice").orderBy("_h", "_block")
    unsure = (F.col("_h").eqNullSafe(F.lag("_h").over(same))
              | F.col("_h").eqNullSafe(F.lead("_h").over(same)))
    named = named.withColumn("_unsure", unsure)
    names = stored(named.select(
        "_h", "name", "_unsure", F.when(F.col("_unsure"), F.col("_block")).alias("_block")), "names")
    clear = names.where(~F.col("_unsure")).select("_h", "name")
    out = rows.join(clear, "_h").drop("_h")
    if names.where("_unsure").limit(1).count():
        by_text = names.where("_unsure").select("_block", "name")
        out = out.unionByName(blocks.join(by_text, "_block").drop("_h", "_block"))
    return out


def _name_pairs(pairs: DataFrame) -> DataFrame:
    named = _ranked(pairs.select("_a", "_b").distinct().withColumn("_h", F.xxhash64("_a", "_b")), ["_a", "_b"])
    return pairs.join(named.select("_a", "_b", "name"), ["_a", "_b"]).drop("_a", "_b")


def block_names(texts: DataFrame, carry: list[str], block_chars: int = BLOCK_CHARS,
                hash_of: Column | None = None) -> DataFrame:
    """One row per row of ``texts`` (_rid, _norm, *carry): _rid, *carry, level, name.

    Equal ``_norm`` have equal (level, name), different ones differ. ``hash_of``
    replaces the hash of ``_block`` in tests.
    """
    hash_of = F.xxhash64("_block") if hash_of is None else hash_of
    cut = F.regexp_extract_all("_norm", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    cut = F.when(F.col("_norm") == "", F.array(F.lit(""))).otherwise(cut)
    # what a row carries travels with its first block only
    first = lambda c: F.when(F.col("_pos") == 0, F.col(c)).alias(c)
    blocks = (
        texts.withColumn("_cut", cut).withColumn("_left", F.size("_cut").cast("long"))
        .select("_rid", *carry, "_left", F.posexplode("_cut").alias("_pos", "_block"))
        .select("_rid", *[first(c) for c in carry], "_left", F.col("_pos").cast("long").alias("_pos"), "_block")
        .withColumn("_h", hash_of)
    )
    level = 0
    rows = stored(_name_blocks(blocks.drop("_block"), blocks), "level0")
    carried = rows.where("_pos = 0").select("_rid", *carry)
    done = rows.where("_left = 1").select("_rid", F.lit(0).alias("level"), "name")
    while True:
        rest = rows.where("_left > 1")
        if not rest.limit(1).count():
            break
        level += 1
        half = F.floor(F.col("_pos") / 2).cast("long")
        odd = F.col("_pos") % 2 == 1
        pairs = rest.groupBy("_rid", half.alias("_pos"), F.floor((F.col("_left") + 1) / 2).cast("long").alias("_left")).agg(
            F.max(F.when(~odd, F.col("name"))).alias("_a"),
            # a name without a right neighbour is paired with -1, which is no name
            F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("_b"))
        rows = stored(_name_pairs(pairs).select("_rid", "_pos", "_left", "name"), f"level{level}")
        done = done.unionByName(rows.where("_left = 1").select("_rid", F.lit(level).alias("level"), "name"))
    return carried.join(done, "_rid")


def normalised(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    return F.regexp_replace(text, f"{BLANK}+", "")


def exact_groups(docs: DataFrame, block_chars: int = BLOCK_CHARS, hash_of: Column | None = None) -> DataFrame:
    """Group documents whose texts are equal once blanks are deleted.

    Takes ``doc_id`` and ``text``; other columns are ignored. Returns one row per
    input row: _rid, doc_id, keep_id, group_size, kept, text_sha256, level, name. Of a
    group the row with the longest original text stays, then the smallest doc_id
    (null last), then the first row. Null texts count as empty, and empty texts are
    equal to each other. Repeated rows are members like any other. An empty table
    gives an empty result.
    """
    text = text_of("text")
    texts = numbered(docs.select("doc_id", "text")).select(
        "_rid", "doc_id", F.length(text).cast("long").alias("_chars"), normalised(text).alias("_norm"))
    texts = texts.withColumn("_sha", F.unhex(hex_sha256(F.col("_norm"))))
    rows = stored(block_names(texts, ["doc_id", "_chars", "_sha"], block_chars, hash_of), "named")
    order = F.struct(
        (-F.col("_chars")).alias("c"), F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"),
        F.col("_rid").alias("r"))
    groups = rows.groupBy("level", "name").agg(
        F.min(order).alias("_keep"), F.count(F.lit(1)).alias("group_size"))
    return rows.join(groups, ["level", "name"]).select(
        "_rid", "doc_id", F.col("_keep.d").alias("keep_id"), "group_size",
        (F.col("_keep.r") == F.col("_rid")).alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256"),
        "level", "name")


def drop_exact(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns, whatever these are called."""
    rows = numbered(packed(docs))
    kept = exact_groups(docs).where("kept").select("_rid")
    return unpacked(rows.join(kept, "_rid", "left_semi"), docs.columns)
