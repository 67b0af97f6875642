"""Periodic runs against a scan of every lag."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kelpfit.llm import periodic

BLANK = r"[\x20\x09-\x0D]+"


def brute(words, min_length=24, min_periods=3):
    found = []
    for q in range(1, len(words) // min_periods + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            inside = any(p < q and s <= start and s + n >= start + length for s, n, p in found)
            if i > start and length >= max(min_length, min_periods * q) and not inside:
                found.append((start, length, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcde"), min_size=1, max_size=12), st.integers(1, 9)), max_size=8))
def test_runs_of_repeated_blocks(blocks):
    words = [w for block, n in blocks for w in block * n]
    assert periodic.word_runs(words) == brute(words)
    assert periodic.word_runs(words, 6, 4) == brute(words, 6, 4)


def test_nested_and_touching_runs():
    words = (["a"] * 30 + ["b"]) * 4 + ["x", "y"] * 13 + ["x"] * 25
    runs = periodic.word_runs(words)
    assert runs == brute(words) and {q for *_, q in runs} == {1, 31, 2}
    assert periodic.collapsed_words(words, runs) == kept(words, runs)


def test_long_segments_take_few_steps():
    words = [str(i % 4001) for i in range(40_000)]
    assert periodic.word_runs(words) == [(0, 40_000, 4001)]
    assert periodic.word_runs(["a"] * 100_000) == [(0, 100_000, 1)]


def test_too_few_periods_are_refused(messy):
    with pytest.raises(ValueError):
        periodic.collapsed_runs(messy, min_periods=2)


def test_texts_of_every_kind(spark, messy):
    random.seed(3)
    extra = spark.createDataFrame(
        [(100 + i, " \t\n".join(random.choice("pqr") for _ in range(60)) + " end" * i) for i in range(40)],
        "doc_id long, text string")
    rows = messy.unionByName(extra, allowMissingColumns=True)
    got = sorted(map(str, periodic.collapsed_runs(rows).collect()))
    want = []
    for r in rows.collect():
        words = [w for w in re.split(BLANK, r.text or "") if w]
        runs = brute(words) if len(words) < 1000 else periodic.word_runs(words)
        want.append((r.doc_id, len(words), runs, " ".join(kept(words, runs))))
    assert len(got) == len(want)
    have = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed_text)
                   for r in periodic.collapsed_runs(rows).collect()), key=str)
    assert have == sorted(want, key=str)


def test_empty_table(nothing):
    assert periodic.collapsed_runs(nothing).collect() == []
