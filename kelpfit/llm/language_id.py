"""Language identification by interpolated Kneser-Ney character models.

Every language gets a character trigram model; bigram and unigram probabilities come
from continuation counts, as Kneser and Ney define them. All n-grams that any
language has seen are kept in sorted arrays of hashes, with one column of
log-probabilities per language. A text goes to the language with the lowest
cross-entropy per character. How high that may be before the answer counts as
doubtful is calibrated per language on labelled texts that the models have not seen.

Languages are estimated and looked up in groups of bounded size, one broadcast each, so
there may be any number of them; a text carries its best language so far from group
to group. All groups share one alphabet, so their probabilities compare.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpfit.llm.common import numbered, stored, text_of

#: Labelled documents per language that the models are fitted on: a hash of the
#: doc_id picks them, so their number is near this bound for any size of input.
FIT_DOCS = 2000
#: The same for calibration, on a part that is not fitted on.
CALIBRATION_DOCS = 500
#: Languages whose models are held and looked up together; more take further looks.
GROUP = 64
DISCOUNT = 0.75
UNKNOWN = "und"
_SPACE = 32
_SHIFT = np.uint64(21)


def _letter_table() -> np.ndarray:
    """For every code point its lower-cased letter, or a blank."""
    table = np.full(sys.maxunicode + 1, _SPACE, np.uint32)
    for cp in range(sys.maxunicode + 1):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


_TABLE: list[np.ndarray] = []


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts, each text between two blanks, other characters as single blanks; starts of texts."""
    if not _TABLE:
        _TABLE.append(_letter_table())
    joined = "\n".join(["", *texts, ""])
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])  # the blank before each text
    low = _TABLE[0][raw]
    blank = low == _SPACE
    keep = ~(blank & np.concatenate([[False], blank[:-1]]))
    keep[starts] = True  # a text's own border stays, even after a blank
    return low[keep], np.cumsum(keep)[starts] - 1


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Code of the n characters that end at each place from n - 1 on; code points take 21 bits."""
    out = codes[n - 1:].astype(np.uint64)
    for k in range(1, n):
        out |= codes[n - 1 - k:len(codes) - k].astype(np.uint64) << (_SHIFT * np.uint64(k))
    return out


def _positions(starts: np.ndarray, total: int) -> np.ndarray:
    """Places whose trigram lies inside one text."""
    inside = np.ones(total, bool)
    inside[starts] = False
    inside[np.minimum(starts + 1, total - 1)] = False
    return inside[2:]


@dataclass
class Model:
    """Sorted hash arrays of n-grams with log2-probabilities, one column per language."""

    languages: list[str]
    tri: np.ndarray
    tri_logp: np.ndarray
    #: contexts of two characters: log2 of the weight left to the bigram
    context: np.ndarray
    context_back: np.ndarray
    bi: np.ndarray
    bi_p: np.ndarray
    #: contexts of one character: weight left to the unigram
    single: np.ndarray
    single_back: np.ndarray
    uni: np.ndarray
    uni_p: np.ndarray
    floor: float
    #: per language: entropies above this count as doubtful
    limit: np.ndarray | None = None

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return at, table[at] == keys

    def lower(self, grams: np.ndarray) -> np.ndarray:
        """Bigram probabilities of the last two characters of trigrams."""
        mask1, mask2 = (np.uint64(1) << _SHIFT) - np.uint64(1), (np.uint64(1) << (_SHIFT * np.uint64(2))) - np.uint64(1)
        at, known = self._find(self.uni, grams & mask1)
        p = np.where(known[:, None], self.uni_p[at], self.floor)
        at, known = self._find(self.single, (grams & mask2) >> _SHIFT)
        backed = p * np.where(known[:, None], self.single_back[at], 1.0)
        at, known = self._find(self.bi, grams & mask2)
        return np.where(known[:, None], self.bi_p[at], backed)

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        at, known = self._find(self.tri, grams)
        out = self.tri_logp[at]
        rest = np.flatnonzero(~known)
        if len(rest):
            g = grams[rest]
            at, known = self._find(self.context, g >> _SHIFT)
            back = np.where(known[:, None], self.context_back[at], 1.0)
            out[rest] = np.log2(back * self.lower(g)).astype(np.float32)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of every text under every language, and which texts have a letter."""
        if not texts:
            return np.zeros((0, len(self.languages))), np.zeros(0, bool)
        codes, starts = letters(texts)
        inside = _positions(starts, len(codes))
        has = np.add.reduceat((codes != _SPACE).astype(np.int64), starts[:-1]) > 0
        grams = _grams(codes, 3)
        totals = np.zeros((len(texts), len(self.languages)))
        counts = np.zeros(len(texts))
        of = np.repeat(np.arange(len(texts)), np.diff(starts))
        of = np.concatenate([of, np.full(len(codes) - len(of), len(texts) - 1)])[2:]
        at = np.flatnonzero(inside)
        for lo in range(0, len(at), 1 << 20):
            part = at[lo:lo + (1 << 20)]
            logp, who = self.log_probabilities(grams[part]), of[part]
            first = np.concatenate([[0], np.flatnonzero(np.diff(who)) + 1])
            totals[who[first]] += np.add.reduceat(logp.astype(np.float64), first, axis=0)
            counts[who[first]] += np.diff(np.concatenate([first, [len(who)]]))
        return -totals / np.maximum(counts, 1)[:, None], has


def _estimate(languages: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]], discount: float,
              alphabet: np.ndarray | None = None) -> Model:
    """Model from sorted trigram codes and counts of every language, over the characters of all languages."""
    one, two = _SHIFT, _SHIFT * np.uint64(2)
    mask1, mask2 = (np.uint64(1) << one) - np.uint64(1), (np.uint64(1) << two) - np.uint64(1)

    def union(parts):
        return np.unique(np.concatenate(parts))

    tri = union([g for g, _ in counts.values()])
    bi, uni = union([tri & mask2]), union([tri & mask1]) if alphabet is None else alphabet
    context, single = union([tri >> one]), union([(tri & mask2) >> one])
    shape = len(languages)
    uni_p, bi_p = np.zeros((len(uni), shape)), np.zeros((len(bi), shape))
    single_back, context_back = np.ones((len(single), shape)), np.ones((len(context), shape))
    tri_p = np.zeros((len(tri), shape))
    for k, language in enumerate(languages):
        grams, n = counts[language]
        # how many different characters come before: the counts of the lower orders
        seen2, n2 = np.unique(grams & mask2, return_counts=True)
        seen1, n1 = np.unique(seen2 & mask1, return_counts=True)
        # interpolated with a uniform share, so that no known character has probability 0
        p1 = np.full(len(uni), discount * len(seen1) / n1.sum() / len(uni))
        p1[np.searchsorted(uni, seen1)] += np.maximum(n1 - discount, 0) / n1.sum()
        uni_p[:, k] = p1
        at = np.searchsorted(single, seen2 >> one)
        total, kinds = np.zeros(len(single)), np.zeros(len(single))
        np.add.at(total, at, n2)
        np.add.at(kinds, at, 1)
        single_back[:, k] = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        own = np.zeros(len(bi))
        own[np.searchsorted(bi, seen2)] = np.maximum(n2 - discount, 0) / total[at]
        p2 = own + single_back[np.searchsorted(single, bi >> one), k] * p1[np.searchsorted(uni, bi & mask1)]
        bi_p[:, k] = p2
        at = np.searchsorted(context, grams >> one)
        total, kinds = np.zeros(len(context)), np.zeros(len(context))
        np.add.at(total, at, n)
        np.add.at(kinds, at, 1)
        context_back[:, k] = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        own = np.zeros(len(tri))
        own[np.searchsorted(tri, grams)] = np.maximum(n - discount, 0) / total[at]
        tri_p[:, k] = own + context_back[np.searchsorted(context, tri >> one), k] * p2[np.searchsorted(bi, tri & mask2)]
    floor = float(uni_p.min()) / 10 if len(uni) else 1e-6
    return Model(languages, tri, np.log2(tri_p).astype(np.float32), context, context_back, bi, bi_p,
                 single, single_back, uni, uni_p, floor)


def _picked(share: str) -> Column:
    """Rows whose doc_id hashes below a share."""
    return F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 30)) < F.col(share) * (1 << 30)


def fit(labelled: DataFrame, calibrate: Column, fit_docs: int = FIT_DOCS, calibration_docs: int = CALIBRATION_DOCS,
        discount: float = DISCOUNT, group: int = GROUP) -> list[Model]:
    """Models of all languages in ``labelled`` (doc_id, _text, lang without nulls), ``group`` of them in each.

    Rows where ``calibrate`` holds only set the rejection limits, unless a language has no
    other rows. Both parts are bounded in documents per language (see the constants);
    trigrams are counted by Spark and only the counts of one group's bounded part are in
    the driver at a time. A language without a letter in its part has no model. Without
    labelled rows the list is empty.
    """
    labelled = labelled.select("doc_id", "_text", F.col("lang").cast("string").alias("lang"),
                               F.coalesce(calibrate, F.lit(False)).alias("_check"))
    sizes = labelled.groupBy("lang").agg(
        F.count(F.when(~F.col("_check"), 1)).alias("n"), F.count(F.when(F.col("_check"), 1)).alias("m"))
    sizes = stored(sizes.select(
        "lang", (F.col("n") == 0).alias("_only"),
        F.least(F.lit(1.0), fit_docs / F.when(F.col("n") > 0, F.col("n")).otherwise(F.col("m"))).alias("_fit_share"),
        F.least(F.lit(1.0), calibration_docs / F.greatest(F.col("m"), F.lit(1))).alias("_check_share")), "languages")
    # one short row per language
    named = labelled.join(F.broadcast(sizes), "lang")
    use = (~F.col("_check") | F.col("_only")) & _picked("_fit_share")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column("_text").to_pylist(), batch.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                codes, starts = letters([t for t, x in zip(texts, langs) if x == lang])
                grams = _grams(codes, 3)[_positions(starts, len(codes))]
                found, n = np.unique(grams, return_counts=True)
                yield pa.record_batch([
                    pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"])

    grams = named.where(use).select("_text", "lang").mapInArrow(count, "lang string, gram long, n long")
    grams = stored(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    languages = [r["lang"] for r in grams.select("lang").distinct().orderBy("lang").collect()]
    characters = grams.select(F.col("gram").bitwiseAND(F.lit((1 << 21) - 1)).alias("c")).distinct().collect()
    alphabet = np.array(sorted(r["c"] for r in characters), np.uint64)
    models = []
    for first in range(0, len(languages), group):
        some, counts = languages[first:first + group], {}
        for lang, part in grams.where(F.col("lang").isin(some)).toPandas().groupby("lang"):
            order = np.argsort(part["gram"].to_numpy().view(np.uint64))
            counts[lang] = (part["gram"].to_numpy().view(np.uint64)[order], part["n"].to_numpy()[order])
        models.append(_estimate(some, counts, discount, alphabet))
    floor = min((m.floor for m in models), default=0.0)
    for model in models:
        model.floor = floor
        model.limit = _limits(named, model)
    return models


def _limits(named: DataFrame, model: Model) -> np.ndarray:
    """Entropies beyond which a text is doubtful, from texts of each language that were not fitted on."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, has = model.entropies(batch.column("_text").to_pylist())
            own = [model.languages.index(x) for x in batch.column("lang").to_pylist()]
            yield pa.record_batch([
                batch.column("lang"), pa.array(bits[np.arange(len(own)), own]), pa.array(has)], names=["lang", "bits", "has"])

    rows = named.where(F.col("_check") & ~F.col("_only") & F.col("lang").isin(model.languages) & _picked("_check_share"))
    seen = rows.select("_text", "lang").mapInArrow(measure, "lang string, bits double, has boolean").where("has").groupBy(
        "lang").agg(F.avg("bits").alias("mean"), F.stddev_pop("bits").alias("sd")).collect()
    known = {r["lang"]: r["mean"] + 4 * r["sd"] + 0.25 for r in seen}
    return np.array([known.get(x, np.inf) for x in model.languages])


def predicted(docs: DataFrame, models: list[Model], sharpness: float = 8.0) -> DataFrame:
    """Language of every text.

    Takes ``doc_id`` and ``text``; other columns are ignored, ``lang`` too. Returns
    one row per input row: _rid, doc_id, lang_pred, score, bits, accepted. Texts
    that are null or have no letter, and all texts if there is no model, get
    ``und``, score 0 and null bits; a very long text is read whole. ``score`` is the share
    of the winner when entropies are weighed by 2 ^ -(sharpness * bits); ties go to the
    first language by name. ``accepted`` is false where the entropy is above the winner's
    calibrated limit. Repeated rows get the same answer; an empty table gives an empty
    result.
    """
    id_type = dict(docs.dtypes)["doc_id"]
    rows = numbered(docs.select("doc_id", "text")).select(
        "_rid", "doc_id", text_of("text").alias("_text"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("_weight"),
        F.lit(None).cast("double").alias("bits"), F.lit(False).alias("accepted"))
    schema = f"_rid long, doc_id {id_type}, _text string, lang_pred string, _weight double, bits double, accepted boolean"

    def look(shared):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            for batch in batches:
                for lo in range(0, batch.num_rows, 512):
                    part = batch.slice(lo, 512)
                    h, has = m.entropies(part.column("_text").to_pylist())
                    best = h.argmin(axis=1)
                    low = h[np.arange(len(h)), best]
                    before = np.array([np.inf if x is None else x for x in part.column("bits").to_pylist()])
                    least = np.minimum(low, before)
                    # weights are relative to the lowest entropy so far
                    known = np.where(np.isinf(before), 0.0, part.column("_weight").to_numpy() * np.exp2(
                        -sharpness * (np.where(np.isinf(before), 0.0, before) - least)))
                    weight = known + np.exp2(-sharpness * (h - least[:, None])).sum(axis=1)
                    new = has & (low < before)
                    names = [m.languages[b] if n else x for n, b, x in zip(new, best, part.column("lang_pred").to_pylist())]
                    fine = np.where(new, low <= m.limit[best], part.column("accepted").to_numpy(zero_copy_only=False))
                    yield pa.record_batch([
                        part.column("_rid"), part.column("doc_id"), part.column("_text"), pa.array(names, pa.string()),
                        pa.array(np.where(has, weight, 0.0)), pa.array(np.where(has, least, 0.0), mask=~has),
                        pa.array(fine.astype(bool))],
                        names=["_rid", "doc_id", "_text", "lang_pred", "_weight", "bits", "accepted"])
        return scan

    for model in models:
        # bounded by the fitted sample of a group
        rows = rows.mapInArrow(look(docs.sparkSession.sparkContext.broadcast(model)), schema)
    score = F.when(F.col("_weight") > 0, 1 / F.col("_weight")).otherwise(0.0)
    return rows.select("_rid", "doc_id", "lang_pred", score.alias("score"), "bits", "accepted")
