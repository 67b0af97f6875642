"""Jaccard join of n-gram sets: groups of documents that may link, then a prefix tree in each.

**Who may link.** Two sets whose similarity is high enough differ in at most D
n-grams, a number that follows from their sizes. Each set is dealt by hash into k =
D + 1 + m segments; two sets that link have at least m + 1 segments in common, whole.
So of its segments a document may drop up to m, as long as it drops by a rule that
looks at a segment's content only: first the smallest ones (up to m1), then the
ones that most documents have (up to m2 = m - m1). A pair that links still shares a
segment that both keep. Segments hold several n-grams, so unlike single n-grams
they stay rare as the corpus grows, and what is common (boilerplate, passages)
is what gets dropped. Documents that share a kept segment form clusters. Inside a
cluster, sketches with one byte of every segment are compared place by place: linked
sets differ in few places, texts with a passage in common in many. What is left
connected are the candidate clusters.

**Who links.** The sets of a cluster meet in one task. There they are sorted in one
global order, rare n-grams first, and stored in a tree that shares common
beginnings. Every set walks the tree once, adding up overlaps on shared paths, and
leaves a subtree as soon as what remains of both sides cannot reach the overlap
that the sizes in the subtree ask for. Clusters too large for a task are dealt into
blocks; blocks that still hold different components meet pairwise, so no link
between components is lost and no pair inside one is looked at again.

Equal sets are one class from the start: copies never multiply.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpfit.llm.common import numbered, packed, stored, text_of, unpacked
from kelpfit.llm.graph import components

#: Most documents and n-grams of one task's tree (one document may exceed the second).
BLOCK_DOCS = 128
BLOCK_NGRAMS = 200_000
#: The same for sketches, which are about a third of a byte per n-gram.
SKETCH_DOCS = 2048
SKETCH_NGRAMS = 20_000_000
#: Size classes grow by this factor; it must exceed 1 / similarity.
CLASS_RATIO = 1.4
#: Length of the broadcast membership table used to skip texts early.
BUCKETS = 1 << 20

_U = np.uint64


def words_of(text: str) -> list[bytes]:
    """Words between blanks, A-Z lower-cased (bytes methods touch ASCII only)."""
    return text.encode("utf-8").lower().split()


def ngrams_of(text: str, n: int) -> set[bytes]:
    """Distinct n-grams; with fewer words the whole sequence is the only one."""
    words = words_of(text)
    if len(words) <= n:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class Scheme:
    """Size classes, and how sets of a class are cut into segments, for one threshold."""

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError("percent must be between 50 and 100")
        self.percent = percent
        ratio = max(CLASS_RATIO, 100 / percent * 1.05)
        self.limits = [1]
        while self.limits[-1] < 1 << 40:
            self.limits.append(int(self.limits[-1] * ratio) + 1)
        # most n-grams in which two linked sets of up to r each differ
        self.differ = [2 * r * (100 - percent) // (100 + percent) for r in self.limits]
        self.small = [max(1, d // 3) for d in self.differ]
        self.common = [max(1, d // 8) for d in self.differ]

    def classes(self, n: int) -> list[int]:
        """Class of a set of n, and the next one if a larger partner may be there."""
        own = bisect.bisect_left(self.limits, n)
        other = bisect.bisect_left(self.limits, 100 * n // self.percent)
        return [c for c in range(own, other + 1) if self.differ[c] > 0]

    def allowed(self, n: int, c: int) -> int:
        """Most common segments that a set of n may drop in class c.

        It may differ from a partner in fewer n-grams than sets of the class's limit.
        """
        partner = min(self.limits[c], 100 * n // self.percent)
        own = (n + partner) * (100 - self.percent) // (100 + self.percent)
        return self.common[c] + self.differ[c] - own

    def segments(self, hashes: np.ndarray, c: int) -> tuple[np.ndarray, bytes]:
        """Signatures of the segments that a set of distinct hashes keeps in class c, and a byte of every one."""
        k = self.differ[c] + 1 + self.small[c] + self.common[c]
        where = (_mix(hashes ^ _U(0x9E3779B97F4A7C15)) % _U(k)).astype(np.int64)
        sizes = np.bincount(where, minlength=k)
        order = np.argsort(where, kind="stable")
        starts = np.zeros(k, np.int64)
        np.cumsum(sizes[:-1], out=starts[1:])
        sums = np.zeros(k, np.uint64)
        full = sizes > 0
        sums[full] = np.add.reduceat(_mix(hashes[order]), starts[full])
        # drop the smallest: all sizes up to the largest one that stays within the allowance
        upto = np.cumsum(np.bincount(sizes))
        least = int(np.searchsorted(upto, self.small[c], side="right"))
        keep = np.flatnonzero(sizes >= least)
        kept = _mix(sums[keep] + _U(c * 0x1F123BB5) + keep.astype(np.uint64) * _U(0xD6E8FEB86659FD93))
        return kept, (sums >> _U(20)).astype(np.uint8).tobytes()


def needed(a: int, b: int, percent: int) -> int:
    """Least overlap of linked sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


class _Hasher:
    """64-bit hashes of n-grams, from word hashes that are kept between texts."""

    def __init__(self, n: int):
        self.n, self.known = n, {}
        self.factors = _mix(np.arange(1, n + 1, dtype=np.uint64)) | _U(1)

    def __call__(self, text: str) -> np.ndarray:
        words = words_of(text)
        known = self.known
        if len(known) > 2_000_000:
            known.clear()
        out = np.empty(len(words), np.uint64)
        for i, w in enumerate(words):
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh64_intdigest(w)
            out[i] = h
        if len(words) <= self.n:
            grams = np.array([0], np.uint64) if words else np.empty(0, np.uint64)
            for k in range(len(words)):
                grams = _mix(grams + out[k:k + 1] * self.factors[k])
            return grams
        total = len(words) - self.n + 1
        grams = np.zeros(total, np.uint64)
        for k in range(self.n):
            grams = _mix(grams + out[k:k + total] * self.factors[k])
        return np.unique(grams)


def set_rows(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """_rid, doc_id, n_ngrams, set_a, set_b (hash of the whole set), cls, and per class of two:
    how many common segments may go (drops), signatures of segments, and a sketch with a byte of each."""
    scheme = Scheme(percent)
    id_type = dict(docs.dtypes)["doc_id"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _Hasher(n)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                sizes, ones, twos, classes, drops = [], [], [], [], []
                segments, sketches = ([], []), ([], [])
                for text in part.column("_text").to_pylist():
                    h = hashed(text)
                    sizes.append(len(h))
                    sums = [int(np.add.reduce(_mix(h ^ _U(s)))) - (1 << 63) for s in (1, 2)]
                    ones.append(sums[0])
                    twos.append(sums[1])
                    found = scheme.classes(len(h)) if len(h) else []
                    classes.append(found[0] if found else None)
                    drops.append([scheme.allowed(len(h), c) for c in found])
                    # two classes at most, and the second follows the first
                    for i in range(2):
                        kept, sketch = scheme.segments(h, found[i]) if len(found) > i else (None, None)
                        segments[i].append(None if kept is None else kept.view(np.int64))
                        sketches[i].append(sketch)
                longs = pa.list_(pa.int64())
                yield pa.record_batch([
                    part.column("_rid"), part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ones, pa.int64()),
                    pa.array(twos, pa.int64()), pa.array(classes, pa.int32()), pa.array(drops, pa.list_(pa.int32())),
                    pa.array(segments[0], longs), pa.array(segments[1], longs),
                    pa.array(sketches[0], pa.binary()), pa.array(sketches[1], pa.binary())],
                    names=["_rid", "doc_id", "n_ngrams", "set_a", "set_b", "cls", "drops", "segments", "more",
                           "sketch", "more_sketch"])

    return docs.mapInArrow(
        scan, f"_rid long, doc_id {id_type}, n_ngrams long, set_a long, set_b long, cls int, "
              "drops array<int>, segments array<long>, more array<long>, sketch binary, more_sketch binary")


def _bucket(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int").alias("_bucket")


def candidate_edges(rows: DataFrame) -> DataFrame:
    """Edges a, b that connect all documents with a common kept segment; one row per distinct set goes in."""
    def posts(column: str, i: int) -> DataFrame:
        return rows.where(F.col(column).isNotNull()).select(
            "_rid", (F.col("cls") + i).alias("cls"), F.get("drops", F.lit(i)).alias("_drop"), F.explode(column).alias("sig"))

    posted = posts("segments", 0).unionByName(posts("more", 1))
    same = Window.partitionBy("sig")
    shared = posted.withColumn("_n", F.count(F.lit(1)).over(same)).where("_n > 1")
    # a document has few shared segments or is near another; the commonest may go
    commoner = F.count(F.lit(1)).over(Window.partitionBy("_rid", "cls").orderBy(F.col("_n").desc()))
    kept = shared.withColumn("_above", commoner).where(F.col("_above") > F.col("_drop"))
    first = F.min("_rid").over(same)
    return kept.select(F.col("_rid").alias("b"), first.alias("a")).where("a <> b").distinct()


class Tree:
    """Sorted sets in a tree of shared beginnings; a node holds the stretch up to the next branch."""

    STEP = 32

    def __init__(self, sets: list[list[int]]):
        self.order = sorted(range(len(sets)), key=sets.__getitem__)
        self.sets = [sets[i] for i in self.order]
        self.root = self._node(0, len(sets), 0) if sets else None

    def _node(self, lo: int, hi: int, depth: int):
        first, last = self.sets[lo], self.sets[hi - 1]
        end, most = depth, min(len(first), len(last))
        while end < most and first[end] == last[end]:
            end += 1
        cuts = range(depth, end, self.STEP)
        steps = [(frozenset(first[i:min(i + self.STEP, end)]), first[min(i + self.STEP, end) - 1]) for i in cuts]
        here = lo
        while here < hi and len(self.sets[here]) == end:
            here += 1
        children, start = [], here
        while start < hi:
            stop = start + 1
            while stop < hi and self.sets[stop][end] == self.sets[start][end]:
                stop += 1
            children.append(self._node(start, stop, end))
            start = stop
        sizes = [len(s) for s in self.sets[lo:hi]]
        return steps, (lo, here, hi), children, min(sizes), max(sizes)

    def links(self, percent: int, group: list[int]):
        """Pairs that link and join groups not joined before: i, j, overlap. ``group`` is updated."""

        def find(i: int) -> int:
            while group[i] != i:
                group[i] = group[group[i]]
                i = group[i]
            return i

        out = []
        for i, probe in enumerate(self.sets):
            have, a = set(probe), len(probe)
            stack = [(self.root, 0, 0)]
            while stack:
                (steps, (lo, here, hi), children, small, large), overlap, depth = stack.pop()
                if hi <= i + 1 or 100 * large < percent * a or 100 * a < percent * small:
                    continue
                own = find(self.order[i])
                if hi - lo == 1 and find(self.order[lo]) == own:
                    continue
                least = needed(a, max(small, -(-percent * a // 100)), percent)
                for elements, last in steps:
                    overlap += len(have & elements)
                    depth += len(elements)
                    left = a - bisect.bisect_right(probe, last)
                    if overlap + min(left, large - depth) < least:
                        break
                else:
                    for j in range(max(lo, i + 1), here):
                        x, y = find(self.order[i]), find(self.order[j])
                        if x != y and 100 * overlap >= percent * (a + len(self.sets[j]) - overlap):
                            group[max(x, y)] = min(x, y)
                            out.append((self.order[i], self.order[j], overlap))
                    stack.extend((c, overlap, depth) for c in children)
        return out


def _tree_links(rids: list[int], texts: list[str], groups: list[int], n: int, percent: int):
    sets = [ngrams_of(t, n) for t in texts]
    seen = Counter(g for s in sets for g in s)
    place = {g: i for i, g in enumerate(sorted(seen, key=lambda g: (seen[g], g)))}
    first: dict[int, int] = {}
    group = [first.setdefault(g, i) for i, g in enumerate(groups)]
    for i, j, overlap in Tree([sorted(place[g] for g in s) for s in sets]).links(percent, group):
        yield rids[i], rids[j], overlap, len(sets[i]) + len(sets[j]) - overlap


def _by_block(rows: DataFrame, most: int | None, per_task: int) -> DataFrame:
    """Rows of a block together, in no more tasks than ``most`` rows are worth."""
    rows = rows.repartition("block")
    if most is not None:
        rows = rows.coalesce(most // per_task + 1)
    return rows.sortWithinPartitions("block", "_rid")


def links_in_blocks(docs: DataFrame, assigned: DataFrame, n: int, percent: int, most: int | None = None) -> DataFrame:
    """a, b, overlap, total: links inside blocks. ``assigned`` has _rid, block, group (joined before)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows):
            found = list(_tree_links(*map(list, zip(*rows)), n, percent)) if len(rows) > 1 else []
            columns = list(zip(*found)) or [[]] * 4
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "overlap", "total"])

        block, rows = None, []
        for batch in batches:
            for key, rid, text, group in zip(*[batch.column(c).to_pylist() for c in ("block", "_rid", "_text", "group")]):
                if key != block:
                    yield done(rows)
                    block, rows = key, []
                rows.append((rid, text, group))
        yield done(rows)

    # texts of documents in no block mostly stop at a table of fixed length
    near = docs.join(F.broadcast(assigned.select(_bucket("_rid")).distinct()), _bucket("_rid") == F.col("_bucket"), "left_semi")
    rows = near.select("_rid", "_text").join(assigned, "_rid").select("block", "_rid", "_text", "group")
    return _by_block(rows, most, BLOCK_DOCS).mapInArrow(scan, "a long, b long, overlap long, total long")


def sketches_in_blocks(rows: DataFrame, assigned: DataFrame, percent: int, most: int | None = None) -> DataFrame:
    """a, b: pairs inside blocks whose sketches agree in as many places as linked sets must.

    Two sets that differ in d n-grams differ in d segments at most, so this drops no
    link; pairs that join nothing new are left out. ``assigned`` is as in :func:`links_in_blocks`.
    """
    scheme = Scheme(percent)

    def pairs(block: list[tuple]) -> list[tuple[int, int]]:
        rids, sizes, classes, own, more, groups = map(list, zip(*block))
        first: dict[int, int] = {}
        parent = [first.setdefault(g, i) for i, g in enumerate(groups)]

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        out = []
        for c in sorted(set(classes)):
            here = [(i, own[i]) for i in range(len(rids)) if classes[i] == c]
            here += [(i, more[i]) for i in range(len(rids)) if classes[i] == c - 1 and more[i] is not None]
            at = np.array([i for i, _ in here])
            places = np.frombuffer(b"".join(x for _, x in here), np.uint8).reshape(len(here), -1)
            n = np.array([sizes[i] for i in at])
            for x in range(len(here) - 1):
                root = find(int(at[x]))
                rest = np.array([y for y in range(x + 1, len(here)) if find(int(at[y])) != root], np.int64)
                if not len(rest):
                    continue
                differ = np.count_nonzero(places[rest] != places[x], axis=1)
                for y in rest[differ * (100 + scheme.percent) <= (n[rest] + n[x]) * (100 - scheme.percent)]:
                    i, j = find(int(at[x])), find(int(at[y]))
                    if i != j:
                        parent[max(i, j)] = min(i, j)
                        out.append((rids[at[x]], rids[at[y]]))
        return out

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ("block", "_rid", "n_ngrams", "cls", "sketch", "more_sketch", "group")

        def done(block):
            found = list(zip(*pairs(block))) if len(block) > 1 else []
            return pa.record_batch([pa.array(x, pa.int64()) for x in found or ([], [])], names=["a", "b"])

        key, block = None, []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in columns]):
                if row[0] != key:
                    yield done(block)
                    key, block = row[0], []
                block.append(row[1:])
        yield done(block)

    near = assigned.join(rows.select("_rid", "n_ngrams", "cls", "sketch", "more_sketch"), "_rid").select(
        "block", "_rid", "n_ngrams", "cls", "sketch", "more_sketch", "group")
    return _by_block(near, most, SKETCH_DOCS // 4).mapInArrow(scan, "a long, b long")


def _dealt(members: DataFrame, by: list[str], docs_most: int, ngrams_most: int) -> DataFrame:
    """Add ``part``, which deals the members of each ``by`` into parts of bounded expected size."""
    totals = members.groupBy(*by).agg(F.count(F.lit(1)).alias("_docs"), F.sum("n_ngrams").alias("_ngrams"))
    parts = F.ceil(F.greatest(F.col("_docs") / docs_most, F.col("_ngrams") / ngrams_most)).cast("long")
    totals = totals.select(*by, parts.alias("parts"))
    return members.join(totals, by).withColumn("part", F.pmod(F.xxhash64("_rid"), F.col("parts")))


def _linked_in_clusters(members: DataFrame, join: Callable[[DataFrame, int | None], DataFrame], block_docs: int,
                        block_ngrams: int) -> DataFrame:
    """Links that connect all that is linked inside each cluster. ``members``: _rid, cluster, n_ngrams.

    ``join`` finds links inside the blocks of a table _rid, block, group of a number of
    rows, at least enough of them to connect what is linked and in different groups.
    """
    members = stored(_dealt(members, ["cluster"], block_docs, block_ngrams), "members")
    links = stored(join(members.select(
        "_rid", F.xxhash64("cluster", "part").alias("block"), F.col("_rid").alias("group")), members.count()), "links")
    large = members.where("parts > 1").drop("part", "parts")
    most = large.count()
    if not most:
        return links
    # large clusters are few: only their own links are followed here
    inside = large.select(F.col("_rid").alias("a"))

    def labelled() -> DataFrame:
        within = links.select("a", "b").join(inside, "a", "left_semi")
        roots = components(within, links.count()).select(F.col("node").alias("_rid"), "root")
        found = large.join(roots, "_rid", "left").withColumn("group", F.coalesce("root", "_rid")).drop("root")
        several = found.groupBy("cluster").agg(F.min("group").alias("_x"), F.max("group").alias("_y")).where("_x <> _y")
        return stored(found.join(several.select("cluster"), "cluster"), "labelled", most)

    # one document of every component first: large groups of near copies fall together here
    heads = _dealt(labelled().where("_rid = group"), ["cluster"], block_docs, block_ngrams)
    more = join(heads.select("_rid", F.xxhash64("cluster", "part").alias("block"), "group"), most)
    links = stored(links.unionByName(more), "links")
    rest = labelled()
    if not rest.limit(1).count():
        return links
    # then every two blocks that are not of one and the same component
    half = max(1, block_docs // 2)
    sizes = rest.groupBy("cluster", "group").agg(F.count(F.lit(1)).alias("_size"))
    rest = rest.join(sizes, ["cluster", "group"]).withColumn("pure", F.when(F.col("_size") >= half, F.col("group")))
    rest = stored(_dealt_pure(rest, half, block_ngrams // 2), "pieces", most)
    blocks = rest.select("cluster", "piece", "pure").distinct()
    left, right = blocks.alias("l"), blocks.alias("r")
    pairs = left.join(right, (F.col("l.cluster") == F.col("r.cluster")) & (F.col("l.piece") <= F.col("r.piece"))
                      & ~F.coalesce(F.col("l.pure") == F.col("r.pure"), F.lit(False)))
    pairs = stored(pairs.select(F.col("l.piece").alias("x"), F.col("r.piece").alias("y")).withColumn(
        "block", F.xxhash64("x", "y")), "pairs")
    sides = pairs.select(F.col("x").alias("piece"), "block").unionByName(
        pairs.where("x <> y").select(F.col("y").alias("piece"), "block"))
    last = join(rest.join(sides, "piece").select("_rid", "block", "group"), pairs.count() * block_docs)
    return stored(links.unionByName(last), "links")


def all_links(docs: DataFrame, rows: DataFrame, n: int, percent: int, block_docs: int = BLOCK_DOCS,
              sketch_docs: int = SKETCH_DOCS) -> DataFrame:
    """Links that connect every component: a, b, overlap, total. ``rows``: one per distinct set."""
    sizes = rows.select("_rid", "n_ngrams")

    def clustered(edges: DataFrame, most: int | None = None) -> DataFrame:
        return components(edges.select("a", "b"), most).select(
            F.col("node").alias("_rid"), F.col("root").alias("cluster")).join(sizes, "_rid")

    # clusters by shared segments also hold documents that merely have passages in common
    near = _linked_in_clusters(clustered(candidate_edges(rows)),
                               lambda b, most: sketches_in_blocks(rows, b, percent, most), sketch_docs, SKETCH_NGRAMS)
    return _linked_in_clusters(clustered(near, near.count()), lambda b, most: links_in_blocks(docs, b, n, percent, most),
                               block_docs, BLOCK_NGRAMS)


def _dealt_pure(rest: DataFrame, half: int, ngrams_most: int) -> DataFrame:
    """Add ``piece``: part of one large component, or a mix of small ones, of one cluster."""
    key = F.coalesce(F.col("pure"), F.lit(-1))
    rest = _dealt(rest.withColumn("_key", key), ["cluster", "_key"], half, ngrams_most)
    return rest.withColumn("piece", F.xxhash64("cluster", "_key", "part")).drop("_key", "part", "parts")


def ngram_components(docs: DataFrame, words: int = 3, percent: int = 90, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Components of documents whose n-gram sets have a Jaccard similarity of ``percent`` % or more.

    Takes ``doc_id`` and ``text``; other columns are ignored. Returns one row per
    input row: _rid, doc_id, n_ngrams, class_rid (first row with the same set),
    root_rid (first row of the component) and component_id (smallest doc_id of the
    component). Texts without words, null ones too, have an empty set and are linked
    with nothing. Repeated rows and equal sets are linked. Null ids stay null and
    count for component_id only where there is no other. An empty table gives an
    empty result. Sizes and set identity use 64- and 128-bit hashes of n-grams,
    overlaps the n-grams themselves.
    """
    texts = numbered(docs.select("doc_id", "text")).select("_rid", "doc_id", text_of("text").alias("_text"))
    rows = stored(set_rows(texts, words, percent), "sets")
    same = ["n_ngrams", "set_a", "set_b"]
    classes = rows.where("n_ngrams > 0").groupBy(*same).agg(
        F.min("_rid").alias("class_rid"), F.min("doc_id").alias("_doc"), F.count(F.lit(1)).alias("_copies"))
    classes = stored(classes, "classes")
    # segments of sets without copies go straight on; the others keep one row per class
    doubled = F.broadcast(classes.where("_copies > 1").select(_bucket("set_a")).distinct())
    on = _bucket("set_a") == F.col("_bucket")
    unsure = rows.where("n_ngrams > 0").join(doubled, on, "left_semi")
    firsts = unsure.join(classes.select(F.col("class_rid").alias("_rid")), "_rid", "left_semi")
    single = rows.where("n_ngrams > 0").join(doubled, on, "left_anti")
    links = all_links(texts, single.unionByName(firsts), words, percent, block_docs, 16 * block_docs)
    roots = components(links.select("a", "b"), links.count()).select(
        F.col("node").alias("class_rid"), F.col("root").alias("root_rid"))
    classes = stored(classes.join(roots, "class_rid", "left").withColumn(
        "root_rid", F.coalesce("root_rid", "class_rid")), "classes")
    smallest = classes.groupBy("root_rid").agg(F.min("_doc").alias("component_id"))
    known = classes.join(smallest, "root_rid").select(*same, "class_rid", "root_rid", "component_id")
    linked = rows.where("n_ngrams > 0").select("_rid", "doc_id", *same).join(known, same)
    alone = rows.where("n_ngrams = 0").select(
        "_rid", "doc_id", "n_ngrams", F.col("_rid").alias("class_rid"), F.col("_rid").alias("root_rid"),
        F.col("doc_id").alias("component_id"))
    return linked.select(*alone.columns).unionByName(alone)


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents with all their columns, one of every component: the smallest doc_id, then the first row."""
    found = stored(ngram_components(docs, words, percent).select("_rid", "doc_id", "root_rid"), "components")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("_rid").alias("r")))
    kept = found.groupBy("root_rid").agg(best.alias("_best")).select(F.col("_best.r").alias("_rid"))
    return unpacked(numbered(packed(docs)).join(kept, "_rid", "left_semi"), docs.columns)
