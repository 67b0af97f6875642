"""Registered queries of the text operators, with SQL where it can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpfit.llm import (
    bpe, chat, exact_dedup, hard_negatives, html_text, language_id, line_dedup, mixing, ngram_join, packing, periodic,
    quality, sharding)
from kelpfit.llm.common import WORD, hex_sha256, shared_folder, text_of
from kelpfit.plans.registry import sql_uniform
from kelpfit.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_exact_dedup", """
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents),
h AS (SELECT doc_id, chars, sha256(norm) AS text_sha256, norm FROM n)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       first_value(doc_id) OVER w = doc_id AS kept,
       text_sha256
FROM h WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id)
""")
def exact_dedup_query(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op5_shard_by_bytes")
def shard_query(spark, sf_dir):
    folder = f"{shared_folder(spark).rstrip('/')}/slot-map-{uuid.uuid4().hex}"
    rows = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=24, folder=folder)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")


@query("op8_mix_sources", f"""
WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
           FROM documents),
z AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
w AS (SELECT *, [5::DOUBLE, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
             2::DOUBLE * source_size AS room FROM z),
l AS (SELECT *, ((SELECT sum(source_size) * 1.5::DOUBLE FROM z) - coalesce(sum(room) OVER b, 0))
                / ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER b, 0)) AS level
      FROM w WINDOW b AS (ORDER BY room / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(room, coalesce(
        w * (SELECT level FROM l WHERE level * w <= room ORDER BY room / w, level LIMIT 1), room)) AS target FROM l),
r AS (SELECT s.*, source_size, target,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS e,
             {sql_uniform('mix-0', "coalesce('=' || s.source, 'null')")} AS u,
             row_number() OVER (PARTITION BY s.source ORDER BY size, md5(doc_id::VARCHAR), doc_id) AS i
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(floor(e * i + u) - floor(e * (i - 1) + u) AS BIGINT) * size AS taken,
       source, CAST(floor(e * i + u) - floor(e * (i - 1) + u) AS BIGINT) AS copies FROM r
""")
def mix_query(spark, sf_dir):
    return mixing.sampled_copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def _quality_sql() -> str:
    """Counts, histograms, references and distances, row by row."""
    removed, n = "SELECT *, t AS r0 FROM d", len(quality.CLASSES)
    for k, (_, pattern) in enumerate(quality.CLASSES):
        literal = pattern.replace("'", "''")
        removed = f"SELECT *, regexp_replace(r{k}, '{literal}', '', 'g') AS r{k + 1} FROM ({removed})"
    at = {name: k for k, (name, _) in enumerate(quality.CLASSES)}
    spent = lambda name: f"(length(r{at[name]}) - length(r{at[name] + 1}))"
    classes = ", ".join([*[spent(name) for name in at], f"length(r{n})"])
    words = ", ".join(f"('{w}', {i})" for i, w in enumerate(quality.vocabulary()))
    languages = ", ".join(f"'{k}'" for k in quality.COMMON_WORDS)
    plogp = lambda x: f"(CASE WHEN {x} > 0 THEN {x} * log2({x}) ELSE 0 END)"
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
c AS MATERIALIZED (
  SELECT doc_id, lang, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, length(t) AS chars,
         length(t) - {spent('blank')} AS word_chars, {spent('symbol')} AS n_symbols, [{classes}] AS classes,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM ({removed})),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS again
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM c)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE again > 1)
      GROUP BY doc_id),
b AS MATERIALIZED (
  SELECT c.*, len(ws) AS n_words, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words,
         len(ws) < {quality.MIN_WORDS} OR 100 * coalesce(r.n, 0) > {quality.MAX_REPEAT_PERCENT} * len(ws) AS base_failed
  FROM c LEFT JOIN r USING (doc_id)),
v(word, i) AS (VALUES {words}),
m AS (SELECT doc_id, i, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS word FROM b) JOIN v USING (word) GROUP BY ALL),
h AS MATERIALIZED (
  SELECT doc_id, 'class' AS kind, unnest(range(0, {n + 1})) AS i, unnest(classes) AS n, chars AS total FROM b
  UNION ALL SELECT b.doc_id, 'word', v.i, coalesce(m.n, 0), n_words
            FROM b CROSS JOIN v LEFT JOIN m ON m.doc_id = b.doc_id AND m.i = v.i
  UNION ALL SELECT b.doc_id, 'word', -1, n_words - coalesce(sum(m.n), 0), n_words
            FROM b LEFT JOIN m USING (doc_id) GROUP BY b.doc_id, n_words),
q AS MATERIALIZED (
  SELECT lang, kind, i, sum(n)::DOUBLE / sum(sum(n)) OVER (PARTITION BY lang, kind) AS q
  FROM h JOIN b USING (doc_id) WHERE NOT base_failed AND lang IN ({languages}) GROUP BY lang, kind, i),
j AS (SELECT doc_id, kind, lang, sqrt(greatest(sum(
        {plogp('p')} / 2 + {plogp('q')} / 2 - {plogp('((p + q) / 2)')}), 0)) AS distance
      FROM (SELECT doc_id, kind, i, n / total AS p FROM h WHERE total > 0) JOIN q USING (kind, i) GROUP BY ALL),
e AS (SELECT doc_id, min(distance) FILTER (kind = 'class') AS cd, min(distance) FILTER (kind = 'word') AS wd
      FROM j GROUP BY doc_id),
{_share_sql()},
f AS (SELECT b.*, CASE WHEN chars >= {quality.MIN_CLASS_CHARS} THEN cd END AS cd,
             CASE WHEN n_words >= {quality.MIN_COMMON_WORDS} THEN wd END AS wd, short
      FROM b LEFT JOIN e USING (doc_id) LEFT JOIN least_short USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       round(cd, 6) AS class_distance, round(wd, 6) AS word_distance, round(short, 6) AS common_shortfall,
       NOT base_failed AND coalesce(cd, 0) <= {quality.MAX_CLASS_DISTANCE}
       AND coalesce(wd, 0) <= {quality.MAX_WORD_DISTANCE} AND coalesce(short, 0) <= {quality.MAX_SHORTFALL} AS kept
FROM f"""


def _short_sql(common: str, share: str, spread: str) -> str:
    """Standard deviations by which a text has fewer common words than a share of its words."""
    return (f"CASE WHEN 2 * {common} >= n_words * {share} THEN 0::DOUBLE WHEN n_words > 0 THEN (n_words * {share} - {common}) "
            f"/ ({spread} * sqrt(n_words * {share} * (1 - {share}))) END")


def _share_sql() -> str:
    """Median share of common words and its spread by language, in rounds, and every text's least shortfall."""
    at = {w: i for i, w in enumerate(quality.vocabulary())}
    listed = ", ".join(f"('{k}', {at[w]})" for k, words in quality.COMMON_WORDS.items() for w in words)
    steps, per = quality.SHARE_STEPS, quality.DEVIATION_STEPS
    sql = f"""cw(lang, i) AS (VALUES {listed}),
oc AS MATERIALIZED (
  SELECT b.doc_id, b.lang AS own, l.lang, n_words, coalesce(sum(m.n), 0)::BIGINT AS c
  FROM b CROSS JOIN (SELECT DISTINCT lang FROM cw) l
       LEFT JOIN (SELECT doc_id, cw.lang, n FROM m JOIN cw USING (i)) m ON m.doc_id = b.doc_id AND m.lang = l.lang
  GROUP BY ALL),
w0 AS MATERIALIZED (
  SELECT oc.doc_id, oc.lang, greatest(oc.n_words, 1) AS n, oc.n_words, c FROM oc JOIN b USING (doc_id)
  WHERE own = oc.lang AND NOT base_failed AND oc.lang IN (SELECT lang FROM q)),
k0 AS (SELECT NULL::VARCHAR AS lang, NULL::DOUBLE AS share, NULL::DOUBLE AS spread WHERE FALSE)"""
    for r in range(1, quality.SHARE_ROUNDS + 1):
        quantile = lambda t, q: f"""(SELECT lang, min(step) AS step FROM (
    SELECT lang, step, sum(n) OVER (PARTITION BY lang ORDER BY step) AS upto, sum(n) OVER (PARTITION BY lang) AS total
    FROM (SELECT lang, step, count(*) AS n FROM {t} GROUP BY ALL)) WHERE upto >= {q}::DOUBLE * total GROUP BY lang)"""  # noqa: E731
        sql += f""",
w{r} AS MATERIALIZED (
  SELECT w0.*, least(greatest(floor(c * {steps} / n), -{steps}), {steps})::INTEGER AS step FROM w0 LEFT JOIN k{r - 1} USING (lang)
  WHERE coalesce({_short_sql('c', 'share', 'spread')}, 0) <= {quality.MAX_SHORTFALL}),
s{r} AS MATERIALIZED (
  SELECT lang, (step + 0.5::DOUBLE) / {steps} AS share FROM {quantile(f'w{r}', 0.5)} WHERE step > 0 AND (step + 0.5::DOUBLE) / {steps} < 1),
d{r} AS MATERIALIZED (
  SELECT lang, least(greatest(floor(coalesce((c - n * share) / sqrt(n * share * (1 - share)) * {per}, 0)), -{1000 * per}),
                     {1000 * per})::INTEGER AS step
  FROM w{r} LEFT JOIN s{r} USING (lang)),
k{r} AS MATERIALIZED (
  SELECT lang, share, greatest(1::DOUBLE, (h.step - l.step)::DOUBLE / {per} / 1.2816::DOUBLE) AS spread
  FROM s{r} JOIN {quantile(f'd{r}', 0.9)} h USING (lang) JOIN {quantile(f'd{r}', 0.5)} l USING (lang))"""
    last = f"k{quality.SHARE_ROUNDS}"
    return sql + f""",
least_short AS (SELECT doc_id, min({_short_sql('c', 'share', 'spread')}) AS short FROM oc JOIN {last} USING (lang)
                WHERE own IN (SELECT lang FROM {last}) GROUP BY doc_id)"""


@query("op4_quality_rules", _quality_sql())
def quality_query(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *[F.round(c, 6).alias(c) for c in ("class_distance", "word_distance", "common_shortfall")])


@query("op9_line_dedup", """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c USING (key) GROUP BY doc_id
""")
def line_dedup_query(spark, sf_dir):
    rows = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"), min_count=10, min_chars=1)
    return rows.select("doc_id", "n_lines", "n_dropped", hex_sha256(F.col("kept_text")).alias("kept_sha256"))


@query("op6_bpe_encode")
def bpe_query(spark, sf_dir):
    rows = bpe.encoded(table(spark, sf_dir, "documents"), tokenizer_file(), decode=True)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        hex_sha256(bpe.id_text("ids")).alias("ids_sha256"), hex_sha256(F.col("decoded")).alias("decoded_sha256"))


@query("op1_ngram_join", """
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT x, y FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id
                   WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(y) AS component_id
FROM r JOIN w ON x = doc_id LEFT JOIN n USING (doc_id) GROUP BY doc_id
""")
def ngram_query(spark, sf_dir):
    rows = ngram_join.ngram_components(table(spark, sf_dir, "documents"), words=3, percent=90)
    return rows.select("doc_id", F.col("n_ngrams").alias("n_shingles"), "component_id")


@query("op10_language_id")
def language_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % 4
    learned = docs.where((fold != 2) & F.col("lang").isNotNull()).select(
        "doc_id", "lang", F.coalesce("text", F.lit("")).alias("_text"), (fold == 3).alias("_calibrate"))
    model = language_id.fit(learned, F.col("_calibrate"))
    held_out = (F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % 4 == 2).alias("held_out")
    return language_id.predicted(docs, model).select("doc_id", held_out, "lang_pred", "score", "bits", "accepted")


CONTROL_SQL = r"\\|\[INST\]|\[/INST\]|<s>|</s>|<<SYS>>|<</SYS>>|<<:>>"


@query("op7_chat_format", f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (SELECT *, length(text) + len(regexp_extract_all(text, '{CONTROL_SQL}')) + CASE role
        WHEN 'user' THEN 15 WHEN 'assistant' THEN 7
        ELSE 20 + length(role) + len(regexp_extract_all(role, '{CONTROL_SQL}')) END AS chars FROM c),
g AS (SELECT conv_id, count(*) AS n_turns, CAST(sum(chars) AS BIGINT) AS formatted_chars,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss
      FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars FROM g
""")
def chat_query(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    lines = F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n")))
    return chat.formatted_conversations(turns).select(
        "conv_id", F.size("roles").cast("long").alias("n_turns"),
        hex_sha256(F.array_join(lines, "")).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), hex_sha256(F.col("loss_text")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@query("op2_pack_tokens")
def packing_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return packing.packed_tokens(docs, tokenizer_file(), width=2048, end_id=50256, pad_id=50256)


#: CRC-32 of the decimal doc_id, bit by bit.
SQL_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
  string_split(doc_id::VARCHAR, ''), lambda x: [ord(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, x: xor(xor(c, x) >> 1, 3988292384::BIGINT * (xor(c, x) & 1))), 4294967295::BIGINT)"""


def _planted(docs: DataFrame) -> DataFrame:
    """Every tenth text, by checksum of its id, goes on from some word in circles."""
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1))
    ws = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    n = F.size("_ws").cast("long")
    g = F.floor(h / 10)
    turned = F.array_join(F.transform("_ws", lambda w, i: F.when(i < F.col("_a"), w).otherwise(
        F.get("_ws", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int")))), " ")
    docs = docs.select("doc_id", text_of("text").alias("text"))
    chosen = docs.where(h % 10 == 0).withColumn("_ws", ws).withColumn("_a", F.when(n > 0, g % n)).withColumn(
        "_p", 1 + F.floor((n - F.col("_a")) / (3 + g % 8))).select(
        "doc_id", F.when(n > 0, turned).otherwise("").alias("text"))
    return docs.where(h % 10 != 0).unionByName(chosen)


@query("op13_periodic_runs", f"""
WITH h AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {SQL_CRC32} AS h FROM documents),
a AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS d, doc_id, n, CASE WHEN a IS NULL THEN w
           ELSE list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS w FROM p),
g AS MATERIALIZED (
  SELECT d, i, array_to_string(w[i + 1:i + 16], ' ') AS gram, CASE WHEN i > 0 THEN w[i] END AS before
  FROM (SELECT d, w, unnest(range(0, n - 15)) AS i FROM d)),
m AS (SELECT x.d, x.i AS i, y.i - x.i AS q FROM g x JOIN g y ON x.d = y.d AND x.gram = y.gram AND x.i < y.i
      WHERE x.i = 0 OR x.before <> y.before),
l AS (SELECT m.d, i, q, coalesce(list_filter(range(0, n - i - q), lambda k: w[i + k + 1] <> w[i + q + k + 1])[1], n - i - q) + q
             AS length FROM m JOIN d USING (d)),
s AS (SELECT * FROM l WHERE length >= greatest(24, 3 * q)),
r AS MATERIALIZED (
  SELECT * FROM s WHERE NOT EXISTS (
    SELECT 1 FROM s t WHERE t.d = s.d AND t.q < s.q AND t.i <= s.i AND t.i + t.length >= s.i + s.length)),
b AS (SELECT d, count(*) AS n_runs, string_agg(i || ',' || length || ',' || q || chr(10), '' ORDER BY i, q) AS runs,
             list(struct_pack(lo := i + q, hi := i + length)) AS gone FROM r GROUP BY d),
t AS (SELECT x.* FROM r x WHERE NOT EXISTS (
        SELECT 1 FROM r y WHERE y.d = x.d AND (y.length * x.q > x.length * y.q OR y.length * x.q = x.length * y.q
          AND (y.i < x.i OR y.i = x.i AND y.q < x.q))))
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, t.i AS start, t.length, t.q AS period, 1000 * t.length // t.q AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(array_to_string(list_transform(list_filter(range(0, n), lambda k: gone IS NULL OR len(list_filter(
         gone, lambda z: z.lo <= k AND k < z.hi)) = 0), lambda k: w[k + 1]), ' ')) AS collapsed_sha256
FROM d LEFT JOIN b USING (d) LEFT JOIN t USING (d)
""")
def periodic_query(spark, sf_dir):
    rows = periodic.collapsed_runs(_planted(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = periodic.highest_exponent("runs")
    return rows.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.floor(F.expr("1000 * _best.length div _best.period")).alias("exponent_milli"),
        hex_sha256(F.array_join(line, "")).alias("runs_sha256"), hex_sha256(F.col("collapsed_text")).alias("collapsed_sha256"))


@query("op12_html_text", """
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') AS body FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(body, '</?(?:p|h1)>'), lambda x:
        trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
          regexp_replace(x, '<br>', ' ', 'g'), '</?[a-z][^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'),
          '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '\\s+', ' ', 'g'))) AS parts FROM a),
c AS (SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), ' ') AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM c
""")
def html_query(spark, sf_dir):
    return html_text.main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query("op11_hard_negatives", """
WITH e AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""")
def hard_negative_query(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)
