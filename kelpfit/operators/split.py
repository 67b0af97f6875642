"""Exact-count seeded splits, samples, permutations and mini-batches."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpfit.checks import require_columns
from kelpfit.operators.ranking import ALL_BELOW, PREFIX_DIGITS, rank_cutoffs, row_order, up_to, with_position
from kelpfit.session import dealt

#: Epochs whose batch cuts are looked for together, with one hash per row and epoch.
EPOCHS_CUT = 8

Size = float | int | None


def check_sizes(training_size: Size, testing_size: Size) -> None:
    for name, size in (("training_size", training_size), ("testing_size", testing_size)):
        if size is None:
            continue
        if isinstance(size, bool) or not isinstance(size, (int, float)):
            raise TypeError(f"{name} must be a float or an int")
        if isinstance(size, float) and not 0 <= size <= 1:
            raise ValueError(f"{name} must be between 0 and 1")
        if isinstance(size, int) and size < 0:
            raise ValueError(f"{name} must not be negative")
    if isinstance(training_size, float) and isinstance(testing_size, float):
        if training_size + testing_size > 1:
            raise ValueError("training_size + testing_size cannot exceed 1")


def resolve_sizes(n: int, training_size: Size = None, testing_size: Size = None) -> tuple[int, int]:
    """Row counts of both sides. Floats are shares of ``n``, integers are counts.

    A missing side takes the remaining rows; with neither given the training
    share is 0.75. Shares are rounded down in double arithmetic.
    """
    check_sizes(training_size, testing_size)
    if training_size is None and testing_size is None:
        training_size = 0.75

    def count(size: Size) -> int:
        return size if isinstance(size, int) else math.floor(size * n)

    if training_size is None:
        train = n - testing_size if isinstance(testing_size, int) else math.floor((1 - testing_size) * n)
        test = n - train
    else:
        train = count(training_size)
        test = n - train if testing_size is None else count(testing_size)
    if train < 0 or test < 0 or train + test > n:
        raise ValueError("training_size + testing_size cannot exceed the number of rows")
    return train, test


def _seed(random_state: int | None) -> int:
    return random.randint(1, 2**31) if random_state is None else random_state


def _shuffle_number(num_shuffles: int | None) -> int:
    if num_shuffles is None:
        return 0
    if isinstance(num_shuffles, bool) or not isinstance(num_shuffles, int) or num_shuffles < 0:
        raise ValueError("num_shuffles must be a non-negative integer")
    return num_shuffles


def split_cutoffs(
    df: DataFrame,
    key: str | Sequence[str],
    training_size: Size = None,
    testing_size: Size = None,
    random_state: int = 0,
    num_shuffles: int | None = None,
    by_content: bool = False,
) -> tuple[int, str, str]:
    """Row count, and the cuts that end the training and the testing part."""
    order = row_order(random_state, key, _shuffle_number(num_shuffles))

    def ranks(n: int) -> list[int]:
        train, test = resolve_sizes(n, training_size, testing_size)
        return [train, train + test]

    n, (train_end, test_end) = rank_cutoffs(df, order, ranks, by_content=by_content)
    return n, train_end, test_end


def train_test_split(
    df: DataFrame,
    key: str | Sequence[str],
    training_size: Size = None,
    testing_size: Size = None,
    random_state: int | None = None,
    num_shuffles: int | None = None,
    sort: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Split one table into exactly sized, disjoint parts.

    Both parts are filters on the seeded hash of ``key``: no join, no shuffle,
    and the filter reaches whatever plan ``df`` is. The key may repeat, as long as rows
    differ in some column where a part ends between them.
    """
    require_columns(df, [key] if isinstance(key, str) else key)
    check_sizes(training_size, testing_size)
    seed = _seed(random_state)
    _, train_end, test_end = split_cutoffs(df, key, training_size, testing_size, seed, num_shuffles, True)
    return _parts(df, key, seed, num_shuffles, train_end, test_end, sort)


def _parts(df, key, seed, num_shuffles, train_end, test_end, sort):
    h = row_order(seed, key, _shuffle_number(num_shuffles))
    train = df.where(up_to(df, h, train_end))
    test = df.where(~up_to(df, h, train_end) & up_to(df, h, test_end))
    if sort:
        keys = [key] if isinstance(key, str) else list(key)
        train, test = train.orderBy(*keys), test.orderBy(*keys)
    return train, test


def paired_split(
    X: DataFrame,
    y: DataFrame,
    key: str | Sequence[str],
    training_size: Size = None,
    testing_size: Size = None,
    random_state: int | None = None,
    num_shuffles: int | None = None,
    sort: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Split features and targets, kept in two tables, along the same keys.

    The predicate depends on the key alone, so the pairing holds without
    joining the tables.
    """
    keys = [key] if isinstance(key, str) else list(key)
    require_columns(X, keys)
    require_columns(y, keys)
    seed = _seed(random_state)
    n, train_end, test_end = split_cutoffs(X, key, training_size, testing_size, seed, num_shuffles)
    if y.count() != n:
        raise ValueError("all tables must have the same number of rows")
    X_train, X_test = _parts(X, key, seed, num_shuffles, train_end, test_end, sort)
    y_train, y_test = _parts(y, key, seed, num_shuffles, train_end, test_end, sort)
    return X_train, X_test, y_train, y_test


def with_split(
    df: DataFrame,
    key: str | Sequence[str],
    training_size: Size = None,
    testing_size: Size = None,
    random_state: int | None = None,
    num_shuffles: int | None = None,
    name: str = "split",
) -> DataFrame:
    """Mark every row ``train`` or ``test``; rows in neither part get NULL."""
    seed = _seed(random_state)
    _, train_end, test_end = split_cutoffs(df, key, training_size, testing_size, seed, num_shuffles, True)
    h = row_order(seed, key, _shuffle_number(num_shuffles))
    return df.withColumn(name, F.when(up_to(df, h, train_end), "train").when(up_to(df, h, test_end), "test"))


def permute(df: DataFrame, key: str | Sequence[str], random_state: int | None = None,
            name: str = "position") -> DataFrame:
    """Whole-table random permutation: a new 0-based index, rows sorted by it."""
    return with_position(df, row_order(_seed(random_state), key), name).orderBy(name)


def sample_rows(df: DataFrame, key: str | Sequence[str], k: int,
                random_state: int | None = None) -> DataFrame:
    """``k`` rows drawn without replacement: those up to the k-th in the seeded order."""
    order = row_order(_seed(random_state), key)
    n, ends = rank_cutoffs(df, order, lambda n: [min(k, n)] if min(k, n) > 0 else [], by_content=True)
    return df.where(up_to(df, order, ends[0])) if ends else df.limit(0)


def batch_cutoffs(df: DataFrame, key: str | Sequence[str], seed: int, epoch: int,
                  batches: int = 10) -> list[str]:
    """Hashes that end each mini-batch of one epoch.

    A batch holds ``max(1, n // batches)`` rows; a shorter last batch is kept.
    """

    def ranks(n: int) -> list[int]:
        size = max(1, n // batches)
        return [min(end, n) for end in range(size, n + size, size)]

    return rank_cutoffs(df, row_order(f"{seed}:{epoch}", key), ranks)[1]


def epoch_cutoffs(df: DataFrame, key: str | Sequence[str], seed: int, epochs: Sequence[int],
                  batches: int = 10) -> dict[int, list[str]]:
    """:func:`batch_cutoffs` of several epochs, from the same passes over the table."""
    tags = {epoch: f"{i:02x}" for i, epoch in enumerate(epochs)}
    if len(tags) > 256:
        raise ValueError("256 epochs at most")
    tagged = df.select(F.explode(F.array(*[
        F.concat(F.lit(tag), row_order(f"{seed}:{epoch}", key)) for epoch, tag in tags.items()])).alias("_order"))
    ends: list[int] = []

    def ranks(total: int) -> list[int]:
        n = total // len(tags)
        size = max(1, n // batches)
        ends.extend(min(end, n) for end in range(size, n + size, size))
        return [i * n + end for i in range(len(tags)) for end in ends]

    found = rank_cutoffs(tagged, F.col("_order"), ranks, PREFIX_DIGITS + 2)[1]
    cut = {epoch: [h[2:] for h in found[i * len(ends):(i + 1) * len(ends)]] for i, epoch in enumerate(tags)}
    return {epoch: [*own[:-1], ALL_BELOW] if own else [] for epoch, own in cut.items()}


def with_batches(df: DataFrame, key: str | Sequence[str], seed: int, epoch: int,
                 batches: int = 10, name: str = "batch") -> DataFrame:
    """Add the 0-based mini-batch number of every row."""
    return numbered_batches(df, key, seed, epoch, batch_cutoffs(df, key, seed, epoch, batches), name)


def numbered_batches(df: DataFrame, key: str | Sequence[str], seed: int, epoch: int, ends: Sequence[str],
                     name: str = "batch") -> DataFrame:
    """Add the 0-based mini-batch number of every row, from the hashes that end the batches."""
    h = row_order(f"{seed}:{epoch}", key)
    number = F.lit(0)
    for end in ends[:-1]:
        number = number + (h > end).cast("int")
    return df.withColumn(name, number)


def epoch_batches(df: DataFrame, key: str | Sequence[str], seed: int, epochs: int,
                  batches: int = 10) -> Iterator[tuple[int, Iterator[DataFrame]]]:
    """Epochs, from 1, and their mini-batches as tables; use the batches of one before asking for the next.

    The cuts of several epochs are found together. An epoch then reads the table once, to
    write it with a folder per batch, and every batch reads its own folder.
    """
    for first in range(1, epochs + 1, EPOCHS_CUT):
        some = range(first, min(epochs + 1, first + EPOCHS_CUT))
        for epoch, ends in epoch_cutoffs(df, key, seed, some, batches).items():
            with dealt(numbered_batches(df, key, seed, epoch, ends, "_batch"), "_batch") as table:
                yield epoch, (table.where(F.col("_batch") == i).drop("_batch") for i in range(len(ends)))
