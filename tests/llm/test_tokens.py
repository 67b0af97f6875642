"""Encoding, packing and chat formatting: equal to the library, or an exact round trip."""

import hashlib
import random
from collections import defaultdict

import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kelpfit.llm import bpe, chat, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_joined_leaves_equal_the_library(library):
    one, r = bpe.codec(PATH), random.Random(5)
    bits = ["abc", "the", "ing ", "'", "s", "'re", " ", "  ", "\n\n\t", "1", "23", "é", "日本", "!!", "<|endoftext|>",
            "<|endof", "text|>", " ", "🙂", "a" * 50, "7" * 30, " " * 40, "#" * 30, "qxz"]
    for _ in range(400):
        some = r.sample(bits, r.randint(1, 8))
        text = "".join(r.choice(some) for _ in range(r.choice([3, 20, 60])))
        parts = [(t, one.encode(t)) for t in bpe._cut(text, r.choice([1, 2, 7, 20, 64]))]
        assert one.concatenated(parts) == ids_of(library, text)


@pytest.mark.parametrize("letters", ["abcdefghij", "ab", "éàbc", "0123456789", "日本語"])
def test_long_runs_equal_the_library(library, letters):
    one, r = bpe.codec(PATH), random.Random(6)
    text = "".join(r.choice(letters) for _ in range(9000))
    assert one.concatenated([(t, one.encode(t)) for t in bpe._cut(text, 600)]) == ids_of(library, text)


def test_encoding_messy(messy, nothing, library):
    rows = messy.collect()
    for leaf in (bpe.LEAF_CHARS, 500):
        got = sorted(((x.doc_id or -1, x.ids, x.decoded) for x in bpe.encoded(messy, PATH, leaf, decode=True).collect()))
        assert got == sorted((x.doc_id or -1, ids_of(library, x.text), x.text or "") for x in rows)
    assert bpe.encoded(nothing, PATH).count() == 0


def test_best_fit_decreasing_equals_a_search_of_all_sequences():
    r = random.Random(1)
    for _ in range(200):
        width = r.randint(1, 40)
        lengths = [r.randint(1, width) for _ in range(r.randint(0, 60))]
        want = []
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fits = [s for s in want if width - sum(s) >= lengths[i]]
            if fits:
                max(fits, key=sum).append(lengths[i])
            else:
                want.append([lengths[i]])
        got = packing.best_fit_decreasing(lengths, width)
        assert sorted(sum(got, [])) == list(range(len(lengths)))
        assert sorted(sum(lengths[i] for i in s) for s in got) == sorted(map(sum, want))


@pytest.mark.parametrize("end", [None, 50256])
def test_packing_round_trip(messy, nothing, library, end):
    packed = packing.packed_tokens(messy, PATH, width=64, end_id=end, window_tokens=3000)
    tail = [] if end is None else [end]
    want = sorted(ids_of(library, x.text) + tail for x in messy.collect())
    got = sorted(x.ids for x in packing.unpacked_tokens(packed, 64).collect())
    assert got == [w for w in want if w]
    for x in packed.collect():
        places = [int.from_bytes(x.positions[i:i + 2], "little") for i in range(0, 128, 2)]
        assert x.cu_seqlens[-1] == x.n_tokens <= 64
        for a, b in zip(x.cu_seqlens, x.cu_seqlens[1:]):
            assert places[a:b] == list(range(b - a))
    assert packing.packed_tokens(nothing, PATH).count() == 0


def test_matrices_are_saved(messy, tmp_path):
    packed = packing.packed_tokens(messy, PATH, width=64)
    packing.write_matrices(packed, str(tmp_path / "m"))
    assert messy.sparkSession.read.parquet(str(tmp_path / "m")).count() == packed.count()


def test_escaping_is_reversible():
    r = random.Random(2)
    for _ in range(3000):
        text = "".join(r.choice(["\\", "<", "[", ">", "]", "/", "s", "x", " ", *chat.CONTROLS]) for _ in range(r.randint(0, 9)))
        assert chat.unescaped(chat.escaped(text)) == text
        assert not any(c in chat.escaped(text) for c in chat.CONTROLS)
        turns = [("user", text), ("assistant", text[::-1]), ("tool<<:>>", text)]
        assert chat.parsed("".join(chat.formatted(*t)[0] for t in turns)) == turns


@pytest.fixture
def talks(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c % k}") for c in range(40)
            for k in [3 + c % 4] for t in range(1 + c % 5)]
    rows += [(100, 0, "system", "<<SYS>>"), (100, 1, None, None), (100, 2, "assistant", ""), (100, 2, "assistant", ""),
             (None, None, "user", "x\\"), (101, 0, "assistant", "</s>" * 40)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("path", F.lit(1))


@pytest.mark.parametrize("chars", [50, chat.PACK_CHARS])
def test_conversations_are_read_back(talks, chars):
    want = defaultdict(list)
    for x in talks.collect():
        want[x.conv_id].append((-1 if x.turn is None else x.turn, x.role or "", x.text or ""))
    packed = chat.packs(talks, pack_chars=chars)
    got = {x.conv_id: x for x in chat.read_back(packed).collect()}
    assert got.keys() == want.keys()
    for c, turns in want.items():
        turns.sort()
        assert list(zip(got[c].roles, got[c].texts)) == [t[1:] for t in turns]
        assert got[c].loss_text == "".join(t for _, r, t in turns if r == "assistant")


def test_shared_turns_are_written_once(talks):
    one = talks.where("conv_id < 40")
    conf = talks.sparkSession.conf
    conf.set("spark.sql.shuffle.partitions", "1")
    try:
        packs = chat.packs(one, pack_chars=10**9).collect()
    finally:
        conf.set("spark.sql.shuffle.partitions", "4")
    assert len(packs) == 1
    pack, paths = packs[0], set()
    for last in pack.last_node:
        path = []
        while last >= 0:
            path.append(pack.text[pack.node_start[last]:pack.node_end[last]])
            last = pack.node_parent[last]
        path.reverse()
        paths |= {tuple(path[:i + 1]) for i in range(len(path))}
    assert len(pack.node_start) == len(paths)
    for i, up in enumerate(pack.node_parent):
        before = 0 if up < 0 else pack.node_position[up] + pack.node_end[up] - pack.node_start[up]
        assert pack.node_position[i] == before
        spans = pack.node_attends[i]
        assert sum(b - a for a, b in zip(spans[::2], spans[1::2])) == before + pack.node_end[i] - pack.node_start[i]


def test_no_conversations(spark):
    assert chat.packs(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_pipeline_equals_its_brute_force(spark, tmp_path, library):
    import duckdb
    import test_dedup as D
    import corpus_pipeline
    from kelpfit.llm import quality, queries

    def in_sql(name, docs):
        con = duckdb.connect()
        con.register("documents", docs.toPandas())
        found = con.execute(queries.ORACLES[name])
        columns = [d[0] for d in found.description]
        return [dict(zip(columns, r)) for r in found.fetchall()]

    r = random.Random(8)
    texts = [t for _, t in D.near_texts(8, 14, [1, 4])]
    prose = [" ".join([t, *(r.choice(quality.COMMON_WORDS["en"]) + str(i % 37) for i in range(60))]) for t in texts]
    rows = [(i, t, "en", r.choice("abc"), len(t or "")) for i, t in enumerate(texts + prose + prose[:5] + [None, ""])]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    good = {x["doc_id"] for x in in_sql("op4_quality_rules", docs) if x["kept"]}
    rows = [x for x in rows if x[0] in good]
    exact = {}
    for x in rows:
        key = "".join(x[1].split())
        if key not in exact or (-len(x[1]), x[0]) < (-len(exact[key][1]), exact[key][0]):
            exact[key] = x
    rows = list(exact.values())
    near = D.near_brute([x[:2] for x in rows], 5, 80)
    rows = [x for x in rows if any(d == x[0] == c for d, _, c in near)]
    assert 0 < len(rows) < len(good)
    left = spark.createDataFrame(rows, schema)
    want = []
    for x in in_sql("op8_mix_sources", left):
        ids = ids_of(library, next(t for d, t, *_ in rows if d == x["doc_id"]))
        want += [(x["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())] * x["copies"]
    got = [(x.doc_id, x.n_tokens, x.ids_sha256) for x in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)


def test_pipeline_stages_take_odd_tables(spark, messy, nothing, tmp_path):
    import corpus_pipeline
    from kelpfit.llm import quality

    r = random.Random(2)
    prose = [" ".join(r.choice(quality.COMMON_WORDS["en"]) + ("" if r.random() < 0.4 else str(r.randint(0, 99)))
                      for _ in range(90)) for _ in range(6)]
    rows = [(1, prose[0]), (1, prose[0]), (None, prose[1]), (None, prose[1] + " "), (2, prose[2]), (3, prose[2] + " x"), (4, prose[3])]
    odd = spark.createDataFrame([(i, t, "en", s, "x", 1.5, "y") for (i, t), s in zip(rows, ["a", None] * 4)],
                                "doc_id long, text string, lang string, source string, _rid string, name double, level string")
    for docs in (messy.unionByName(odd, allowMissingColumns=True), nothing):
        columns = docs.columns
        docs.write.parquet(str(tmp_path / f"t{len(columns)}"))
        docs = spark.read.parquet(str(tmp_path / f"t{len(columns)}"))
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}{len(columns)}")
            stage(spark, docs, "").write.parquet(path)
            docs = spark.read.parquet(path)
            if name != "bpe":
                assert docs.columns == columns
            if name == "ngram_join" and len(columns) > 4:
                texts = sorted(x.text.strip().removesuffix(" x") for x in docs.collect())
                assert texts == sorted(prose[i] for i in range(4))
        assert (docs.count() > 0) == (len(columns) > 4)
