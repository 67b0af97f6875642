"""Quality rules: counts that fail a text outright, then its distance from its language.

A text's histogram of character classes and its histogram of common words are
compared with the same histograms of all texts of each language, by the
Jensen-Shannon distance (base 2, from 0 to 1). A text far from every language is
rejected. Texts too short for a histogram to mean something are not judged by it.

Words that are not common fill most of every histogram, so a text without a single
common word is hardly farther away than a short clean one. How many of its words are
common is therefore judged by itself: against the median share of its language, in
standard deviations of what a text of its length may have. That needs no length
guard, and medians do not follow the junk among the texts.

Languages without listed words get theirs from counts over all their texts, and
their texts are compared with them as well. Where a language has too few texts
for that, or a text has no language, distances decide nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpfit.llm.common import BLANK, numbered, packed, stored, text_of, unpacked

# Common words of the languages that texts are compared with.
COMMON_WORDS = {
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im",
           "dem", "nicht", "ein", "eine", "als", "auch", "es", "an", "werden"),
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on",
           "not", "he", "this", "are", "or", "his", "from", "at"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no",
           "una", "su", "al", "lo", "como", "más", "es", "o"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "a",
           "par", "plus", "pas", "au", "sur", "ne", "se", "ou"),
}
# Character classes, each counted in what the classes before it leave.
CLASSES = (
    ("lower", "[a-z]+"), ("upper", "[A-Z]+"), ("digit", "[0-9]+"), ("blank", f"{BLANK}+"),
    ("point", "[.,;:!?'\"()-]+"), ("symbol", "[#*$%&|<>]+"), ("letter", r"\p{L}+"),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CLASS_CHARS = 200
MIN_COMMON_WORDS = 150
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.33
#: Standard deviations by which a text may have fewer common words than its language.
MAX_SHORTFALL = 3.0
#: Steps of a share, and of a standard deviation, in the counted histograms.
SHARE_STEPS = 1000
DEVIATION_STEPS = 20
#: Rounds in which shares are taken anew from the texts that the last ones leave.
SHARE_ROUNDS = 4
#: Texts that pass the base rules from which on a language without listed words has references.
MIN_REFERENCE_TEXTS = 30
#: Common words of such a language, as many as are listed for the others.
COUNTED_WORDS = 24
#: Word positions take 24 bits of a packed integer; longer texts use pairs.
PACKED_WORDS = 1 << 24


def vocabulary() -> list[str]:
    return sorted({w for words in COMMON_WORDS.values() for w in words})


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words in a three-word window found twice or more in ``_words``.

    Window hashes are sorted together with their positions; equal neighbours are
    repeats. Packed into one integer (40 bits of hash), neighbours are compared word
    by word as well; with 64 bits of hash they are not. Each step is a column of its
    own, for what stands inside a lambda is computed for every element.
    """
    words, n = F.col("_words"), F.size("_words")
    hashed = lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
    place = lambda x: x.bitwiseAND(F.lit(PACKED_WORDS - 1)).cast("int")

    def alike(x: Column, y: Column) -> Column:
        i, j = place(x), place(y)
        return (F.shiftright(x, 24) == F.shiftright(y, 24)) & reduce(
            lambda a, b: a & b, [F.get(words, i + k) == F.get(words, j + k) for k in range(3)])

    def starts(column: str, same, position) -> Column:
        near = lambda x, k: (F.coalesce(same(x, F.get(F.col(column), k - 1)), F.lit(False))
                             | F.coalesce(same(x, F.get(F.col(column), k + 1)), F.lit(False)))
        return F.transform(F.filter(column, near), position)

    small = F.transform("_windows", lambda w, i: F.shiftleft(hashed(w, i), 24).bitwiseOR(i.cast("long")))
    large = F.transform("_windows", lambda w, i: F.struct(hashed(w, i).alias("h"), i.alias("i")))
    return (
        rows.withColumn("_windows", F.when(n >= 3, F.slice("_words", F.lit(1), n - 2)))
        .withColumn("_small", F.when(n <= PACKED_WORDS, F.sort_array(small)))
        .withColumn("_large", F.when(n > PACKED_WORDS, F.sort_array(large)))
        .withColumn("_starts", F.when(n <= PACKED_WORDS, starts("_small", alike, place)).otherwise(
            starts("_large", lambda x, y: x["h"] == y["h"], lambda x: x["i"])))
        .withColumn("n_repeat_words", F.coalesce(F.size(F.array_distinct(F.concat(
            "_starts", F.transform("_starts", lambda p: p + 1), F.transform("_starts", lambda p: p + 2)))),
            F.lit(0)).cast("long"))
        .withColumn("n_repeat_words", F.greatest("n_repeat_words", F.lit(0)))
        .drop("_windows", "_small", "_large", "_starts")
    )


def features(docs: DataFrame) -> DataFrame:
    """One row per input row: _rid, doc_id, lang, the base counts and both histograms.

    ``classes`` counts code points by class (the last entry is what no class takes);
    ``common`` counts the words of :func:`vocabulary` (the last entry: other words).
    """
    rows = numbered(docs.select("doc_id", "text", "lang")).select(
        "_rid", "doc_id", F.col("lang").cast("string").alias("lang"), text_of("text").alias("_t"))
    # nested replacements: every class is removed before the next is counted
    rows = rows.withColumn("_left0", F.col("_t"))
    for k, (_, pattern) in enumerate(CLASSES):
        rows = rows.withColumn(f"_left{k + 1}", F.regexp_replace(f"_left{k}", pattern, ""))
    lengths = [F.length(f"_left{k}") for k in range(len(CLASSES) + 1)]
    rows = rows.select(
        "_rid", "doc_id", "lang", "_t",
        F.array(*[a - b for a, b in zip(lengths, lengths[1:])], lengths[-1]).alias("classes"),
        F.filter(F.split("_t", f"{BLANK}+"), lambda w: w != "").alias("_words"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    words, names = vocabulary(), [k for k, _ in CLASSES]
    longest = max(map(len, words))
    listed = F.array(*[F.lit(w) for w in words])
    # one letter per common word, so that counting a word is counting a letter
    letters = "".join(chr(0x4E00 + k) for k in range(len(words)))
    code = lambda w: F.substring(F.lit(letters), F.array_position(listed, w).cast("int"), F.lit(1))
    coded = F.array_join(F.transform(
        F.filter("_words", lambda w: (F.length(w) <= longest) & F.array_contains(listed, w)), code), "")
    rows = _with_repeats(rows.withColumn("_coded", coded))
    counts = [F.length("_coded") - F.length(F.replace("_coded", F.lit(letters[k]), F.lit("")))
              for k in range(len(words))]
    n_words = F.size("_words")
    return rows.select(
        "_rid", "doc_id", "lang", n_words.cast("long").alias("n_words"),
        (reduce(lambda a, b: a + b, [F.get("classes", F.lit(k)) for k in range(len(names) + 1)])
         - F.get("classes", F.lit(names.index("blank")))).cast("long").alias("word_chars"),
        F.get("classes", F.lit(names.index("symbol"))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", "classes",
        F.concat(F.array(*counts), F.array(n_words - F.length("_coded"))).alias("common"))


def base_failed(min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def language_references(rows: DataFrame, languages: Sequence[str] = tuple(COMMON_WORDS)) -> dict:
    """Shares of classes and common words per language, over all rows that pass the base rules.

    Collects one row per listed language, of fixed width.
    """
    widths = {"classes": len(CLASSES) + 1, "common": len(vocabulary()) + 1}
    sums = [F.sum(F.get(c, F.lit(k)).cast("long")).alias(f"{c}{k}") for c, n in widths.items() for k in range(n)]
    found = rows.where(~base_failed() & F.col("lang").isin(list(languages))).groupBy("lang").agg(*sums).collect()
    out = {}
    for r in found:
        shares = {c: [r[f"{c}{k}"] for k in range(n)] for c, n in widths.items()}
        if all(sum(v) for v in shares.values()):
            out[r["lang"]] = {c: [x / sum(v) for x in v] for c, v in shares.items()}
    return out


def _own_common(language: str) -> Column:
    """How many words of a text are common in a listed language."""
    at = {w: k for k, w in enumerate(vocabulary())}
    return reduce(lambda a, b: a + b, [F.get("common", F.lit(at[w])) for w in COMMON_WORDS[language]])


def _quantile(counts: dict[int, int], q: float) -> int:
    """First key up to which a share ``q`` of all counted rows lies."""
    left = q * sum(counts.values())
    for key in sorted(counts):
        left -= counts[key]
        if left <= 0:
            return key
    return max(counts)


def common_shares(rows: DataFrame) -> dict[str, tuple[float, float]]:
    """Per language the median share of common words, and how much wider than binomial it spreads.

    ``rows`` has ``lang``, ``n_words`` and ``_own``, the common words of a text's own
    language, of all texts that pass the base rules. Histograms of fixed width are
    counted over all of them. Junk has few common words, so the spread is that of
    the upper half, and texts that fall short are left out of the next round.
    """
    found: dict[str, tuple[float, float]] = {}
    for _ in range(SHARE_ROUNDS):
        before = found
        found = _common_shares(rows, before)
        if found == before:
            break
    return found


def _by_language(values: dict[str, float]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("lang"))


def _common_shares(rows: DataFrame, known: dict[str, tuple[float, float]]) -> dict[str, tuple[float, float]]:
    """One round of :func:`common_shares`, over the texts that do not fall short of the ``known`` shares."""
    if known:
        share, spread = (_by_language({k: v[i] for k, v in known.items()}) for i in range(2))
        rows = rows.where(F.coalesce(shortfall(F.col("_own"), share, spread), F.lit(0.0)) <= MAX_SHORTFALL)

    def histograms(value: Column, most: int) -> dict[str, dict[int, int]]:
        step = F.least(F.greatest(F.floor(value), F.lit(-most)), F.lit(most)).cast("int").alias("step")
        out: dict[str, dict[int, int]] = {}
        for r in rows.groupBy("lang", step).agg(F.count(F.lit(1)).alias("n")).collect():
            out.setdefault(r["lang"], {})[r["step"]] = r["n"]
        return out

    n = F.greatest(F.col("n_words"), F.lit(1))
    counted = histograms(F.col("_own") * SHARE_STEPS / n, SHARE_STEPS)
    medians = {k: (_quantile(v, 0.5) + 0.5) / SHARE_STEPS for k, v in counted.items() if _quantile(v, 0.5) > 0}
    medians = {k: v for k, v in medians.items() if v < 1}
    if not medians:
        return {}
    share = _by_language(medians)
    above = (F.col("_own") - n * share) / F.sqrt(n * share * (1 - share)) * DEVIATION_STEPS
    spread = histograms(F.coalesce(above, F.lit(0.0)), 1000 * DEVIATION_STEPS)
    # 0.9 of a normal distribution lie below 1.2816 standard deviations
    wide = {k: (_quantile(v, 0.9) - _quantile(v, 0.5)) / DEVIATION_STEPS / 1.2816 for k, v in spread.items()}
    return {k: (v, max(1.0, wide[k])) for k, v in medians.items()}


def shortfall(common: Column, share: Column | float, spread: Column | float) -> Column:
    """Standard deviations by which ``common`` of ``n_words`` words lie below a share of them.

    None where a text has half of that share: long texts differ by their subject as well.
    """
    n = F.col("n_words")
    share, spread = (x if isinstance(x, Column) else F.lit(x) for x in (share, spread))
    return F.when(2 * common >= n * share, 0.0).when(n > 0, (n * share - common) / (spread * F.sqrt(n * share * (1 - share))))


def _plogp(x: Column) -> Column:
    return F.when(x > 0, x * F.log2(x)).otherwise(0.0)


def distance(counts: Column, total: Column, shares: Sequence[float] | Column) -> Column:
    """Jensen-Shannon distance between a histogram of counts and a distribution; null if it is empty.

    ``total`` is the sum of the counts.
    """
    if isinstance(shares, Column):
        entropy = F.aggregate(shares, F.lit(0.0), lambda a, q: a + _plogp(q))
    else:
        entropy = F.lit(sum(q * math.log2(q) for q in shares if q > 0))
        shares = F.array(*[F.lit(float(q)) for q in shares])
    terms = F.zip_with(counts, shares, lambda x, q: (
        _plogp(x / total) / 2 - _plogp((x / total + q) / 2)))
    spread = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) + entropy / 2
    return F.when(total > 0, F.sqrt(F.greatest(spread, F.lit(0.0))))


def counted_references(docs: DataFrame, rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """Stored features with references of the languages that have no listed words, and these languages.

    Adds ``own_common`` (counts of the language's own common words, then other words),
    ``own_classes_q`` and ``own_common_q`` (its shares); null for other rows. Collects
    a fixed number of rows per language.
    """
    other = rows.where(~base_failed() & ~F.col("lang").isin(list(COMMON_WORDS)))
    counts = other.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_REFERENCE_TEXTS)
    languages = sorted(r["lang"] for r in counts.collect())
    if not languages:
        return rows, []
    texts = numbered(docs.select("doc_id", "text", "lang")).select(
        "_rid", F.col("lang").cast("string").alias("lang"),
        F.filter(F.split(text_of("text"), f"{BLANK}+"), lambda w: w != "").alias("_words"))
    texts = texts.where(F.col("lang").isin(languages))
    passed = texts.join(other.select("_rid"), "_rid", "left_semi")
    # separators and figures are no words of a language
    found = passed.select("lang", F.explode("_words").alias("word")).where(F.col("word").rlike(r"^[\p{L}\p{M}'’-]+$"))
    found = found.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    words: dict[str, list[str]] = {}
    for r in found.withColumn("k", F.row_number().over(best)).where(F.col("k") <= COUNTED_WORDS).collect():
        words.setdefault(r["lang"], []).append(r["word"])
    words = {k: sorted(v) + [""] * (COUNTED_WORDS - len(v)) for k, v in words.items()}  # no word is empty
    if not words:
        return rows, []
    spark = docs.sparkSession
    listed = spark.createDataFrame(list(words.items()), "lang string, listed array<string>")
    counted = F.transform("listed", lambda w: F.size(F.filter("_words", lambda x: x == w)).cast("long"))
    own = texts.join(F.broadcast(listed), "lang").select("_rid", "_words", counted.alias("_counted")).select(
        "_rid", F.concat("_counted", F.array(
            F.size("_words") - F.aggregate("_counted", F.lit(0).cast("long"), lambda a, x: a + x))).alias("own_common"))
    rows = stored(rows.join(own, "_rid", "left"), "features")
    sums = [F.sum(F.get("own_common", F.lit(k))).alias(f"w{k}") for k in range(COUNTED_WORDS + 1)]
    sums += [F.sum(F.get("classes", F.lit(k)).cast("long")).alias(f"c{k}") for k in range(len(CLASSES) + 1)]
    shares = []
    for r in rows.where(~base_failed() & F.col("lang").isin(list(words))).groupBy("lang").agg(*sums).collect():
        of = [[r[f"{c}{k}"] for k in range(n)] for c, n in (("c", len(CLASSES) + 1), ("w", COUNTED_WORDS + 1))]
        shares.append((r["lang"], *[[x / sum(v) for x in v] for v in of]))
    shares = spark.createDataFrame(shares, "lang string, own_classes_q array<double>, own_common_q array<double>")
    return rows.join(F.broadcast(shares), "lang", "left"), sorted(words)


def _measured(rows: DataFrame, references: dict, counted: Sequence[str]) -> DataFrame:
    """Base counts and distances of stored :func:`features`, which stay with them.

    ``counted`` are the languages of :func:`counted_references`.
    """
    known = F.col("lang").isin([*COMMON_WORDS, *counted])

    def nearest(column: str, total: Column, guard: Column) -> Column:
        found = [distance(F.col(column), total, r[column]) for r in references.values()]
        if counted:
            own = "own_common" if column == "common" else column
            found.append(distance(F.col(own), total, F.col(f"own_{column}_q")))
        if not found:
            return F.lit(None).cast("double")
        return F.when(guard & known, F.least(*found) if len(found) > 1 else found[0])

    blank = F.get("classes", F.lit([k for k, _ in CLASSES].index("blank")))
    chars = F.col("_chars")
    return rows.withColumn("_chars", F.col("word_chars") + blank).select(
        "_rid", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        nearest("classes", chars, chars >= MIN_CLASS_CHARS).alias("class_distance"),
        nearest("common", F.col("n_words"), F.col("n_words") >= MIN_COMMON_WORDS).alias("word_distance"),
        "lang", "common", *(["own_common"] if counted else []))


def _near(max_class_distance: float, max_word_distance: float) -> Column:
    far = (F.coalesce(F.col("class_distance"), F.lit(0.0)) > max_class_distance) | (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) > max_word_distance)
    return ~F.col("base_failed") & ~far


def judged_by_distance(docs: DataFrame) -> DataFrame:
    """As :func:`judged`, by the base rules and the two distances only."""
    rows = stored(features(docs), "features")
    references = language_references(rows)
    rows, counted = counted_references(docs, rows)
    rows = _measured(rows, references, counted).drop("lang", "common", "own_common")
    return rows.withColumn("kept", _near(MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE))


def judged(docs: DataFrame, max_class_distance: float = MAX_CLASS_DISTANCE,
           max_word_distance: float = MAX_WORD_DISTANCE, max_shortfall: float = MAX_SHORTFALL) -> DataFrame:
    """Base counts and verdict of every document.

    Takes ``doc_id``, ``text`` and ``lang``; other columns are ignored. Returns one
    row per input row: _rid, doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, class_distance, word_distance, common_shortfall, kept.
    The distances are those to the nearest of the listed languages and the text's own,
    null where the text is below the length guard or its language has no references
    (a null one has none); the shortfall is the least of these languages and has no
    length guard. What is null rejects no text. A null text has no words and fails
    the base rules. Repeated rows are judged one by one. An empty table gives an
    empty result.
    """
    rows = stored(features(docs), "features")
    references = language_references(rows)
    rows, counted = counted_references(docs, rows)
    own = F.coalesce(*[F.when(F.col("lang") == k, _own_common(k)) for k in COMMON_WORDS])
    if counted:
        own = F.coalesce(own, F.col("n_words") - F.get("own_common", F.lit(COUNTED_WORDS)))
    usable = [*references, *counted]
    shares = common_shares(rows.where(~base_failed() & F.col("lang").isin(usable)).select(
        "lang", "n_words", own.alias("_own"))) if usable else {}
    short = [shortfall(_own_common(k), *v) for k, v in shares.items() if k in COMMON_WORDS]
    theirs = {k: v for k, v in shares.items() if k not in COMMON_WORDS}
    if theirs:
        short.append(shortfall(own, *(_by_language({k: v[i] for k, v in theirs.items()}) for i in range(2))))
    least = (F.least(*short) if len(short) > 1 else short[0]) if short else F.lit(None).cast("double")
    judgeable = F.col("lang").isin(list(shares)) if shares else F.lit(False)
    rows = _measured(rows, references, counted).withColumn("common_shortfall", F.when(judgeable, least)).drop(
        "lang", "common", "own_common")
    enough = F.coalesce(F.col("common_shortfall"), F.lit(0.0)) <= max_shortfall
    return rows.withColumn("kept", _near(max_class_distance, max_word_distance) & enough)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns, whatever these are called."""
    kept = judged(docs).where("kept").select("_rid")
    return unpacked(numbered(packed(docs)).join(kept, "_rid", "left_semi"), docs.columns)
