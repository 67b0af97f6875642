"""Byte-pair encoding of whole texts, with long texts encoded in pieces side by side.

A long text is cut in halves, again and again, down to leaves of bounded length.
Leaves are rows of their own, so Spark encodes them in parallel. The encodings are
then joined pairwise, like the tree they came from: around every join a growing
window is encoded again until it agrees with both sides.

Agreement is exact. A window that starts and ends where the pre-tokenizer always
splits (between a letter or digit and another class of character, before a blank,
and so on) can be replaced as it is. Inside a run without such a place, the window
is a number of tokens of each side, encoded as bytes; if its first and last token
come out as they were, all neighbouring tokens are pairs that byte-pair encoding
leaves apart, and a sequence of such pairs is the encoding of its bytes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpfit.llm.common import numbered, text_of

LEAF_CHARS = 32768
# Fixed value: how byte-level vocabularies of this family split a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Places where that pattern always splits, whatever stands further away.
SURE = (r"(?<=\p{L})(?=[^\p{L}])|(?<=\p{N})(?=[^\p{N}])|(?<=\S)(?=\s)"
        r"|(?<=[^\s\p{L}\p{N}'])(?=[\p{L}\p{N}])")


def _byte_letters() -> dict[str, int]:
    """The printable letter that a byte-level vocabulary writes for every byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Codec:
    """Encodes and decodes with the vocabulary of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = _byte_letters()
        self.ranks = {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items()
                      if word not in self.special}
        self.model = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=self.ranks,
                                       special_tokens=self.special)
        self.bytes_of = {i: b for b, i in self.ranks.items()} | {
            i: w.encode("utf-8") for w, i in self.special.items()}
        either = "|".join(regex.escape(w) for w in sorted(self.special, key=len, reverse=True))
        self.sure = regex.compile(f"({either})|{SURE}" if either else f"(?!)()|{SURE}")
        self.longest_special = max(map(len, self.special), default=0)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, allowed_special=set(self.special), disallowed_special=())

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    def sure_places(self, text: str) -> Iterator[int]:
        """Places inside ``text`` where it is always split; a special token's edges, never its inside."""
        for m in self.sure.finditer(text):
            if m.group(1) is None:
                yield m.start()
            else:
                yield from (m.start(), m.end())

    def join(self, left: tuple[str, list[int]], right: tuple[str, list[int]], window: int = 64) -> tuple[str, list[int]]:
        """Encoding of two adjacent texts from the encodings of both."""
        (a, x), (b, y) = left, right
        text = a + b
        if not a or not b:
            return text, x + y
        size = window
        while True:
            lo, hi = max(0, len(a) - size), min(len(text), len(a) + size)
            # places near a window's edge may be cut specials: look at more text than is used
            margin = self.longest_special + 2
            start = max(0, lo - margin)
            places = [p + start for p in self.sure_places(text[start:min(len(text), hi + margin)])]
            before = [p for p in places if lo <= p < len(a)] if lo else [0]
            after = [p for p in places if len(a) < p <= hi] if hi < len(text) else [len(text)]
            if before and after:
                begin, end = before[0], after[-1]
                new = self.encode(text[begin:end])
                head = self._drop(x, len(a[begin:].encode()), last=True)
                tail = self._drop(y, len(b[:end - len(a)].encode()), last=False)
                if head is not None and tail is not None:
                    return text, head + new + tail
            elif size > 8 * window:
                joined = self._join_run(a, x, b, y)
                if joined is not None:
                    return text, joined
            size *= 2

    def _drop(self, ids: list[int], n_bytes: int, last: bool) -> list[int] | None:
        """``ids`` without those of its last (or first) bytes; None if no token ends there."""
        k = 0
        while n_bytes > 0:
            k += 1
            n_bytes -= len(self.bytes_of[ids[-k] if last else ids[k - 1]])
        if n_bytes < 0:
            return None
        return (ids[:len(ids) - k] if last else ids[k:])

    def _join_run(self, a: str, x: list[int], b: str, y: list[int]) -> list[int] | None:
        """Join inside one long run of letters or of digits; None if it is not in one."""
        edge = a[-1] + b[0]
        if not (regex.fullmatch(r"\p{L}{2}", edge) or regex.fullmatch(r"\p{N}{2}", edge)):
            return None
        left = len(a[len(a) - self._run_end(a):].encode())
        right = len(b[:self._run_start(b)].encode())
        # tokens that lie wholly inside the run; its first character may belong to a token with more before it
        xs = self._inside(x, left - 8, True)
        ys = self._inside(y, right - 8, False)
        k = 8
        while k <= min(xs, ys):
            head, tail = x[len(x) - k:], y[:k]
            new = self.model._encode_single_piece(b"".join(self.bytes_of[i] for i in head + tail))
            if new[0] == head[0] and new[-1] == tail[-1]:
                return x[:len(x) - k] + new + y[k:]
            k *= 2
        return None

    @staticmethod
    def _run_end(text: str) -> int:
        # the pattern runs over the reversed text, where the run is at the start
        return regex.match(r"\p{L}+|\p{N}+", text[::-1]).end()

    @staticmethod
    def _run_start(text: str) -> int:
        return regex.match(r"\p{L}+|\p{N}+", text).end()

    def _inside(self, ids: list[int], n_bytes: int, last: bool) -> int:
        k = 0
        while k < len(ids):
            n_bytes -= len(self.bytes_of[ids[-1 - k] if last else ids[k]])
            if n_bytes < 0:
                break
            k += 1
        return k

    def concatenated(self, parts: list[tuple[str, list[int]]]) -> list[int]:
        """Join a text's leaves, in order, as a balanced tree."""
        while len(parts) > 1:
            parts = [self.join(parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i]
                     for i in range(0, len(parts), 2)]
        return parts[0][1]


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def _cut(text: str, leaf_chars: int) -> list[str]:
    """Halves of halves, down to ``leaf_chars``."""
    if len(text) <= leaf_chars:
        return [text]
    middle = len(text) // 2
    return _cut(text[:middle], leaf_chars) + _cut(text[middle:], leaf_chars)


def encoded(docs: DataFrame, path: str, leaf_chars: int = LEAF_CHARS, decode: bool = False) -> DataFrame:
    """Token ids of every text.

    Takes ``doc_id`` and ``text``; other columns are ignored. Returns one row per
    input row: _rid, doc_id, ids array<int> and, with ``decode``, the text that the
    ids decode to. ``path`` is a tokenizer file with a byte-level vocabulary; strings
    of its special tokens get their ids, none are added. A null text counts as
    empty and has no ids. Repeated rows are encoded one by one, null ids stay null,
    an empty table gives an empty result.
    """
    id_type = dict(docs.dtypes)["doc_id"]
    schema = f"_rid long, doc_id {id_type}, ids array<int>" + (", decoded string" if decode else "")
    rows = numbered(docs.select("doc_id", "text")).select("_rid", "doc_id", text_of("text").alias("_text"))

    def out(rids, ids, tokens) -> pa.RecordBatch:
        names = ["_rid", "doc_id", "ids"]
        columns = [rids, ids, pa.array(tokens, pa.list_(pa.int32()))]
        if decode:
            one = codec(path)
            names.append("decoded")
            columns.append(pa.array([one.decode(t) for t in tokens], pa.string()))
        return pa.record_batch(columns, names=names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):  # bounds the tokens held at once
                part = batch.slice(lo, 256)
                yield out(part.column("_rid"), part.column("doc_id"),
                          [one.encode(t) for t in part.column("_text").to_pylist()])

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = codec(path)
        for batch in batches:
            yield batch[["_rid", "doc_id", "leaf", "piece"]].assign(ids=[one.encode(t) for t in batch["piece"]])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rid, doc, text in zip(batch["_rid"], batch["doc_id"], batch["_text"]):
                pieces = _cut(text, leaf_chars)
                yield pd.DataFrame({"_rid": rid, "doc_id": [doc] * len(pieces), "leaf": range(len(pieces)),
                                    "piece": pieces})

    def joined(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        one = codec(path)
        part = part.sort_values("leaf")
        ids = one.concatenated([(t, list(map(int, i))) for t, i in zip(part["piece"], part["ids"])])
        row = part[["_rid", "doc_id"]].head(1).assign(ids=[ids])
        return row.assign(decoded=[one.decode(ids)]) if decode else row

    short = rows.where(F.length("_text") <= leaf_chars).mapInArrow(whole, schema)
    # a leaf is small: leaves of one text are dealt out, encoded, and meet again by text
    # (ids travel as strings there, which pandas keeps as they are even beside nulls)
    piece = "_rid long, doc_id string, leaf int, piece string"
    long = (
        rows.where(F.length("_text") > leaf_chars).withColumn("doc_id", F.col("doc_id").cast("string"))
        .mapInPandas(cut, piece)
        .repartition("_rid", "leaf")
        .mapInPandas(leaves, piece + ", ids array<int>")
        .groupBy("_rid").applyInPandas(joined, schema.replace(f"doc_id {id_type}", "doc_id string"))
        .withColumn("doc_id", F.col("doc_id").cast(id_type))
    )
    return short.unionByName(long)


def id_text(ids: str | Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(F.transform(ids, lambda i: i.cast("string")), ",")
