"""Every registered text query over the small driver tables, against SQL or brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import test_dedup as dedup
import test_rules as rules
from kelpfit.llm import queries
from kelpfit.llm.packing import unpacked_tokens


@pytest.fixture(scope="module")
def documents(folder):
    return pq.read_table(f"{folder}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def run(spark, folder):
    return lambda name: queries.QUERIES[name](spark, folder)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_with_sql(run, folder, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found = con.execute(queries.ORACLES[name])
    columns = sorted(d[0] for d in found.description)
    at = [[d[0] for d in found.description].index(c) for c in columns]
    want = sorted((tuple(r[i] for i in at) for r in found.fetchall()), key=str)
    df = run(name)
    assert sorted(df.columns) == columns
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=str) == want


def test_ngram_join(run, documents):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in run("op1_ngram_join").collect())
    want = dedup.near_brute([(d["doc_id"], d["text"]) for d in documents], 3, 90)
    # the brute-force helper writes 0 as -1, as it does nulls
    assert sorted((d or -1, n, c or -1) for d, n, c in got) == want


def test_packed_tokens(run, documents):
    library = Tokenizer.from_file(queries.tokenizer_file())
    back = Counter(tuple(r.ids) for r in unpacked_tokens(run("op2_pack_tokens")).collect())
    assert back == Counter((*library.encode(d["text"], add_special_tokens=False).ids, 50256) for d in documents)


def test_quality_counts(run, documents):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = {r.doc_id: r for r in run("op4_quality_rules").collect()}
    for d in documents:
        r = got[d["doc_id"]]
        assert tuple(r[n] for n in names) == rules.counts(d["text"])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_shards(run, documents):
    texts, load, slots = {d["doc_id"]: d["text"].encode() for d in documents}, Counter(), defaultdict(list)
    for r in run("op5_shard_by_bytes").collect():
        assert (r["size"], r.text_crc32) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]))
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    mean = sum(load.values()) / 24
    assert set(load) <= set(range(24)) and max(load.values()) <= max(1.05 * mean, 8 + max(map(len, texts.values())))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_encoding(run, documents):
    library, got = Tokenizer.from_file(queries.tokenizer_file()), {r.doc_id: r for r in run("op6_bpe_encode").collect()}
    for d in documents:
        ids, r = library.encode(d["text"], add_special_tokens=False).ids, got[d["doc_id"]]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_conversations(run, folder):
    turns = defaultdict(list)
    for r in pq.read_table(f"{folder}/conversations.parquet").to_pylist():
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    turns[-1] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in run("op7_chat_format").collect()}
    assert got.keys() == turns.keys()
    for c, rows in turns.items():
        rows.sort()
        loss = "".join(t for _, r, t in rows if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in rows)
        assert (got[c].n_turns, got[c].loss_chars) == (len(rows), len(loss))
        assert got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_mix(run, documents):
    words = {d["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"])) for d in documents}
    sizes, taken, target, longest = Counter(), Counter(), {}, Counter()
    for d in documents:
        sizes[d["source"]] += words[d["doc_id"]]
    want = rules.targets_brute(sizes)
    for r in run("op8_mix_sources").collect():
        assert (r["size"], r.source_size) == (words[r.doc_id], sizes[r.source])
        assert r.target == pytest.approx(want[r.source]) and r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r["size"])
    assert all(abs(taken[k] - want[k]) <= longest[k] + 1 for k in want)


def test_languages(run, documents):
    truth = {d["doc_id"]: d["lang"] for d in documents}
    got = run("op10_language_id").collect()
    assert len(got) == len(documents)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.95 * len(held)
