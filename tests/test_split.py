import hashlib

import pytest
from pyspark.sql import functions as F

from kelpfit.operators import ranking, split


def order(seed, keys):
    return sorted(keys, key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())


def ids(df):
    return [r["id"] for r in df.select("id").collect()]


def test_sizes_follow_fractions_counts_and_defaults():
    assert split.resolve_sizes(10) == (7, 3)
    assert split.resolve_sizes(10, training_size=0.6) == (6, 4)
    assert split.resolve_sizes(10, training_size=4) == (4, 6)
    assert split.resolve_sizes(10, testing_size=3) == (7, 3)
    assert split.resolve_sizes(10, training_size=0.5, testing_size=0.2) == (5, 2)
    assert split.resolve_sizes(10, training_size=4, testing_size=5) == (4, 5)


def test_share_is_rounded_down_in_double_arithmetic():
    assert split.resolve_sizes(10, training_size=1 - 0.9) == (0, 10)


@pytest.mark.parametrize("sizes", [
    dict(training_size=1.5), dict(testing_size=-0.1), dict(training_size=-1),
    dict(training_size=0.7, testing_size=0.7), dict(training_size=8, testing_size=8),
    dict(testing_size=11),
])
def test_bad_sizes_are_rejected(sizes):
    with pytest.raises(ValueError):
        split.resolve_sizes(10, **sizes)


def test_size_types_are_checked():
    with pytest.raises(TypeError):
        split.resolve_sizes(10, training_size="half")
    with pytest.raises(TypeError):
        split.resolve_sizes(10, training_size=True)


def test_split_takes_the_first_hashes(spark):
    train, test = split.train_test_split(spark.range(1000), "id", training_size=0.3, random_state=5)
    expected = order(5, range(1000))
    assert set(ids(train)) == set(expected[:300])
    assert set(ids(test)) == set(expected[300:])


def test_both_sizes_leave_surplus_rows_out(spark):
    train, test = split.train_test_split(
        spark.range(10), "id", training_size=3, testing_size=4, random_state=1)
    expected = order(1, range(10))
    assert (set(ids(train)), set(ids(test))) == (set(expected[:3]), set(expected[3:7]))


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_split_ignores_partitioning(spark, partitions):
    df = spark.range(500).repartition(partitions)
    train, _ = split.train_test_split(df, "id", training_size=0.5, random_state=9, sort=True)
    assert ids(train) == sorted(order(9, range(500))[:250])


def test_empty_and_full_training_side(spark):
    train, test = split.train_test_split(spark.range(10), "id", training_size=0.0, random_state=1)
    assert (train.count(), test.count()) == (0, 10)
    train, test = split.train_test_split(spark.range(10), "id", training_size=1.0, random_state=1)
    assert (train.count(), test.count()) == (10, 0)


def test_paired_split_keeps_pairs_through_shuffles(spark):
    X = spark.range(40).select("id", (F.col("id") * 2).alias("x"))
    y = spark.range(40).repartition(7).select("id", (F.col("id") * 3).alias("y"))
    X1, X2, y1, y2 = split.paired_split(X, y, "id", training_size=0.6, random_state=3, num_shuffles=2)
    assert set(ids(X1)) == set(ids(y1)) and set(ids(X2)) == set(ids(y2))
    assert (X1.count(), X2.count()) == (24, 16)
    plain = split.paired_split(X, y, "id", training_size=0.6, random_state=3)[0]
    assert set(ids(plain)) != set(ids(X1))


def test_paired_split_needs_equal_lengths(spark):
    with pytest.raises(ValueError):
        split.paired_split(spark.range(5), spark.range(6), "id")


def test_duplicate_keys_at_the_cut_are_reported(spark):
    df = spark.range(10).select(F.lit(1).alias("id"))
    with pytest.raises(ValueError, match="uniquely"):
        split.train_test_split(df, "id", training_size=0.5, random_state=1)


def test_a_cut_may_fall_between_rows_of_one_key(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"), F.lit(None).cast("string").alias("s"))
    train, test = split.train_test_split(df, "k", training_size=0.55, random_state=4)
    assert (train.count(), test.count()) == (550, 450)
    assert {r["v"] for r in train.collect()}.isdisjoint(r["v"] for r in test.collect())
    keys = [{r["k"] for r in part.collect()} for part in (train, test)]
    assert len(keys[0] & keys[1]) == 1
    assert split.with_split(df, "k", training_size=10, random_state=4).where("split = 'train'").count() == 10
    assert split.sample_rows(df, "k", 77, 4).count() == 77
    again = split.train_test_split(df.repartition(7), "k", training_size=0.55, random_state=4)[0]
    assert sorted(r["v"] for r in again.collect()) == sorted(r["v"] for r in train.collect())


def test_crowded_prefixes_are_narrowed(spark, monkeypatch):
    monkeypatch.setattr(ranking, "PREFIX_DIGITS", 1)
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 3)
    expected = order(2, range(400))
    n, cuts = ranking.rank_cutoffs(
        spark.range(400), ranking.row_order(2, "id"), [0, 1, 57, 58, 200, 399, 400])
    hashes = [hashlib.md5(f"2:{k}".encode()).hexdigest() for k in expected]
    assert n == 400
    assert cuts == ["", hashes[0], hashes[56], hashes[57], hashes[199], hashes[398], "g"]


def test_rows_of_one_key_are_never_ranked_in_one_window(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 40)
    ranked, rows_at = [], ranking._rows_at
    monkeypatch.setattr(ranking, "_rows_at", lambda hashed, place: ranked.extend(
        rows for _, _, rows in place.values()) or rows_at(hashed, place))
    df = spark.range(1500).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    train, test = split.train_test_split(df, "k", training_size=0.55, random_state=4)
    assert max(ranked) <= 40
    keys = order(4, range(3))
    first = [r["v"] for r in train.collect()]
    assert len(first) == 825 and test.count() == 675 and {v % 3 for v in first} == {keys[0], keys[1]}
    cut = sorted((v for v in range(1500) if v % 3 == keys[1]), key=lambda v: hashlib.md5(f"{v % 3}\x01{v}".encode()).hexdigest())
    assert set(first) == {v for v in range(1500) if v % 3 == keys[0]} | set(cut[:325])


def test_permutation_and_sample(spark):
    expected = order(4, range(300))
    rows = split.permute(spark.range(300), "id", 4).collect()
    assert [r["id"] for r in rows] == expected
    assert [r["position"] for r in rows] == list(range(300))
    assert set(ids(split.sample_rows(spark.range(300), "id", 7, 4))) == set(expected[:7])


@pytest.mark.parametrize("n, sizes", [(7, [1] * 7), (25, [2] * 12 + [1]), (100, [10] * 10)])
def test_mini_batches(spark, n, sizes):
    rows = split.with_batches(spark.range(n), "id", 6, 2).groupBy("batch").count().collect()
    assert [c for _, c in sorted((r["batch"], r["count"]) for r in rows)] == sizes
