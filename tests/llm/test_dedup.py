"""Exact groups, near groups and repeated lines against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kelpfit.llm import exact_dedup, graph, line_dedup, ngram_join


def exact_brute(rows):
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc is None, doc or 0, i))
    out = {}
    for members in groups.values():
        best = min(members)
        for m in members:
            out[m[3]] = (rows[best[3]][0], len(members), m[3] == best[3])
    return sorted((rows[i][0] or -1, *((v[0] or -1), v[1], v[2])) for i, v in out.items())


def exact_rows(df):
    return sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in df.collect())


def some_texts(seed, n):
    r = random.Random(seed)
    base = ["".join(r.choice("ab \n") for _ in range(r.choice([0, 1, 3, 9, 17, 40]))) for _ in range(n)]
    return [(i, t if r.random() < 0.5 else t.replace(" ", "\t ")) for i, t in enumerate(base + base[: n // 2])]


@pytest.mark.parametrize("hash_of", [None, "collide"])
def test_exact_groups_equal_brute_force_even_if_all_hashes_collide(spark, hash_of):
    rows = some_texts(3, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    by = F.pmod(F.xxhash64("_block"), F.lit(3)) if hash_of else None
    got = exact_dedup.exact_groups(df, block_chars=4, hash_of=by)
    assert exact_rows(got) == exact_brute(rows)


def test_exact_messy(messy, nothing):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    assert exact_rows(exact_dedup.exact_groups(messy)) == exact_brute(rows)
    kept = exact_dedup.drop_exact(messy)
    assert kept.columns == messy.columns
    assert kept.count() == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows})
    assert exact_dedup.exact_groups(nothing).count() == 0
    assert exact_dedup.drop_exact(nothing).count() == 0


def near_brute(rows, n, percent):
    sets = [ngram_join.ngrams_of(t or "", n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        root = find(i)
        known = smallest.get(root)
        smallest[root] = doc if known is None else known if doc is None else min(doc, known)
    return sorted((d or -1, len(sets[i]), smallest[find(i)] or -1) for i, (d, _) in enumerate(rows))


def near_rows(df):
    return sorted((r.doc_id or -1, r.n_ngrams, r.component_id or -1) for r in df.collect())


def near_texts(seed, groups, sizes):
    r = random.Random(seed)
    vocabulary, out = [f"w{i}" for i in range(200)], []
    for _ in range(groups):
        base = [r.choice(vocabulary) for _ in range(r.choice([2, 3, 9, 12, 40, 150]))]
        for _ in range(r.choice(sizes)):
            words = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 4])):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            if r.random() < 0.2:
                base = words
            out.append((len(out), " ".join(words)))
    return out


@pytest.mark.parametrize("n,percent,block", [(3, 90, 128), (5, 80, 6)])
def test_near_components_equal_brute_force(spark, n, percent, block):
    rows = near_texts(n, 12, [1, 3, 25])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_rows(ngram_join.ngram_components(df, n, percent, block)) == near_brute(rows, n, percent)


def test_near_messy(messy, nothing):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    assert near_rows(ngram_join.ngram_components(messy)) == near_brute(rows, 3, 90)
    assert ngram_join.one_of_each(messy).columns == messy.columns
    assert ngram_join.ngram_components(nothing).count() == 0
    assert ngram_join.one_of_each(nothing).count() == 0


def test_tree_finds_what_pairs_find():
    r = random.Random(7)
    sets = [sorted(r.sample(range(30), r.randint(1, 25))) for _ in range(60)]
    for percent in (50, 70, 90):
        group = list(range(60))
        list(ngram_join.Tree(sets).links(percent, group))
        got = set()
        for i in range(60):
            j = i
            while group[j] != j:
                j = group[j]
            got.add((i, j))
        want = near_brute([(i + 1, " ".join(f"n{x}" for x in s)) for i, s in enumerate(sets)], 1, percent)
        assert Counter(Counter(j for _, j in got).values()) == Counter(Counter(c for _, _, c in want).values())


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


def lines_brute(rows, least):
    keyed = [[(x, x.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})) for x in (t or "").split("\n")]
             for _, t in rows]
    seen = Counter(k for lines in keyed for k in {k for _, k in lines if k})
    return sorted((d or -1, len(lines), sum(seen[k] >= least for _, k in lines),
                   "\n".join(x for x, k in lines if seen[k] < least)) for (d, _), lines in zip(rows, keyed))


def line_rows(df):
    return sorted((r.doc_id or -1, r.n_lines, r.n_dropped, r.kept_text) for r in df.collect())


@pytest.mark.parametrize("bits", [1 << 18, line_dedup.FILTER_BITS])
def test_common_lines_equal_brute_force_whatever_the_filter(spark, bits):
    r = random.Random(2)
    pool = [f"Line {i}" for i in range(60)] + ["", " ", "é", "LINE 3 "]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(1, 12)))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = spark.createDataFrame(df.collect(), df.schema)
    assert line_rows(line_dedup.drop_repeated_lines(df, 10, 1, bits=bits)) == lines_brute(rows, 10)


def test_first_occurrence_stays(spark):
    df = spark.createDataFrame([(1, "a\nb\nA"), (2, "b\nc"), (3, "a ")], "doc_id long, text string").coalesce(1)
    got = line_rows(line_dedup.drop_repeated_lines(df, min_count=2, keep="first"))
    assert got == [(1, 3, 1, "a\nb"), (2, 2, 1, "c"), (3, 1, 1, "")]


def test_lines_messy(messy, nothing):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    assert line_rows(line_dedup.drop_repeated_lines(messy, 2)) == lines_brute(rows, 2)
    assert line_dedup.drop_repeated_lines(nothing).count() == 0
    with pytest.raises(ValueError):
        line_dedup.drop_repeated_lines(nothing, keep="last")
