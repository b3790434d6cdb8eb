"""Encoding with a public byte-level BPE tokenizer by recursive DuckDB queries, one database per Python worker."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shipped

#: Default place of the vocabulary; every function takes another as a parameter.
BYTE_BPE_50K = "/opt/tokenizers/byte_bpe_50k.json"

#: Fixed value: the split of byte-level BPE vocabularies of this family into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words kept encoded in one worker; beyond that the memory is emptied and filled again.
CACHED_WORDS = 400_000

#: Rounds of one recursion: it keeps the rows of every round, so what is not done by then goes on in another one.
ROUNDS = 48

#: What null and empty texts come out as.
NO_TOKENS: list[int] = []

#: One round contracts, in every word that still has a mergeable pair, all non-overlapping occurrences of the word's
#: pair of least rank, leftmost first. A pair that contains a merged token always ranks after the merge that made it, so
#: this gives what contracting one occurrence at a time gives. A word without such a pair leaves the recursion; its rows of
#: the last round are its tokens.
ENCODE = """
WITH RECURSIVE state(step, word, pos, tok) AS (
  SELECT CAST(0 AS BIGINT), word, pos, tok FROM tokens
  UNION ALL (
  WITH neighbours AS (
    SELECT *, lead(tok) OVER (PARTITION BY word ORDER BY pos) AS right_tok FROM state WHERE step < {rounds}),
  pairs AS (
    SELECT n.step, n.word, n.pos, n.tok, m.rank, m.id
    FROM neighbours n LEFT JOIN merges m ON m.l = n.tok AND m.r = n.right_tok),
  least AS (
    SELECT word, min(rank) AS rank FROM pairs GROUP BY word HAVING min(rank) IS NOT NULL),
  marked AS (
    SELECT p.*, p.rank IS NOT DISTINCT FROM l.rank AS hit, row_number() OVER (PARTITION BY p.word ORDER BY p.pos) AS n
    FROM pairs p JOIN least l USING (word)),
  runs AS (
    SELECT *, n - row_number() OVER (PARTITION BY word, hit ORDER BY pos) AS run FROM marked),
  chosen AS (
    SELECT *, hit AND row_number() OVER (PARTITION BY word, hit, run ORDER BY pos) % 2 = 1 AS take FROM runs),
  kept AS (
    SELECT *, coalesce(lag(take) OVER (PARTITION BY word ORDER BY pos), FALSE) AS eaten FROM chosen)
  SELECT step + 1, word, pos, CASE WHEN take THEN id ELSE tok END FROM kept WHERE NOT eaten))
SELECT word, pos, tok, last
FROM (SELECT *, max(step) OVER (PARTITION BY word) AS last FROM state)
WHERE step = last
"""

#: Tokens back in order, as bytes: of words as ids, of texts as letters.
GATHER = "SELECT owner, list(tok ORDER BY pos) AS ids FROM done JOIN owners USING (word) GROUP BY owner"
DECODE = "SELECT text, string_agg(hex(bytes), '' ORDER BY pos) AS letters FROM ids_in JOIN vocab USING (id) GROUP BY text"


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself where printable, else the next code point from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or (b >= 161 and b != 173)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def merge_rows(path: str) -> tuple[dict[bytes, int], list[tuple[int, int, int, int]]]:
    """Ids by bytes, and the rows (left id, right id, rank, merged id), from a tokenizer's JSON or a file of ranks.

    A file of ranks names no pairs: there every split of a token into two tokens is a pair with the token's rank.
    """
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        byte_of = {c: b for b, c in byte_letters().items()}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        rows = [(vocab[a], vocab[b], k, vocab[a + b]) for k, (a, b) in enumerate(pairs)]
        ids = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if all(c in byte_of for c in t)}
        return ids, rows
    with open(path, "rb") as f:
        ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    rows = [(ids[t[:k]], ids[t[k:]], i, i) for t, i in ids.items() for k in range(1, len(t)) if t[:k] in ids and t[k:] in ids]
    return ids, rows


class Encoder:
    """A tokenizer in one worker: its merge table in DuckDB, and the words encoded so far."""

    def __init__(self, path: str):
        import duckdb
        import regex

        self.ids, rows = merge_rows(path)
        self.first = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int32)
        self.split = regex.compile(WORDS).findall
        self.db = duckdb.connect(config={"threads": 1})
        column = lambda k: pa.array([r[k] for r in rows], pa.int32())
        self.db.register("rows_in", pa.table({"l": column(0), "r": column(1), "rank": column(2), "id": column(3)}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM rows_in")
        self.db.unregister("rows_in")
        vocab = pa.table({"id": pa.array(list(self.ids.values()), pa.int32()), "bytes": pa.array(list(self.ids), pa.binary())})
        self.db.register("rows_in", vocab)
        self.db.execute("CREATE TABLE vocab AS SELECT * FROM rows_in")
        self.db.unregister("rows_in")
        self.known: dict[str, list[int]] = {}
        self.joined = np.zeros((256, 256), bool)  # bytes that stand side by side in some token; no merge crosses any others
        for t in self.ids:
            b = np.frombuffer(t, np.uint8)
            self.joined[b[:-1], b[1:]] = True

    def learn(self, words: list[str]) -> None:
        """Encode words not met before: their bytes as rows (word, pos, tok), contracted to the fixpoint, whatever their length. A word is cut where two bytes meet that no
        token holds side by side: no merge crosses such a place, and each piece is contracted by itself."""
        for at in range(0, len(words), 20_000):
            some = words[at : at + 20_000]
            raw = [w.encode() for w in some]
            n = np.array([len(b) for b in raw], dtype=np.int64)
            flat = np.frombuffer(b"".join(raw), np.uint8)
            begins = np.zeros(len(flat), bool)
            begins[np.cumsum(n) - n] = True
            begins[1:] |= ~self.joined[flat[:-1], flat[1:]]
            piece = (np.cumsum(begins) - 1).astype(np.int32)
            owner = np.repeat(np.arange(len(raw), dtype=np.int32), n)
            left = pa.table({"word": piece, "pos": np.arange(len(flat), dtype=np.int32), "tok": self.first[flat]})
            self.db.register("owners", pa.table({"word": piece[begins], "owner": owner[begins]}))
            done = []
            while left.num_rows:
                self.db.register("tokens", left)
                got = self.db.sql(ENCODE.replace("{rounds}", str(ROUNDS))).to_arrow_table()
                self.db.unregister("tokens")
                ended = pc.less(got["last"], ROUNDS)
                done.append(got.filter(ended).select(["word", "pos", "tok"]))
                left = got.filter(pc.invert(ended)).select(["word", "pos", "tok"])
            self.db.register("done", pa.concat_tables(done))
            back = self.db.sql(GATHER).to_arrow_table()
            self.db.unregister("done")
            self.db.unregister("owners")
            for w, ids in zip(back["owner"].to_pylist(), back["ids"].to_pylist()):
                self.known[some[w]] = ids

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        if len(self.known) > CACHED_WORDS:
            self.known = {}
        split = [self.split(t) if t else [] for t in texts]
        new = dict.fromkeys(w for ws in split for w in ws if w not in self.known)
        if new:
            self.learn(list(new))
        known = self.known
        return [[i for w in ws for i in known[w]] if ws else list(NO_TOKENS) for ws in split]

    def decode(self, ids: list[int]) -> str:
        return self.decode_many([ids])[0]

    def decode_many(self, lists: list[list[int] | None]) -> list[str]:
        """The texts of lists of ids, by an ordered aggregation over their tokens; an empty or null list is the empty text."""
        n = np.array([len(x or ()) for x in lists], np.int64)
        flat = np.array([i for x in lists for i in x or ()], np.int32)
        self.db.register("ids_in", pa.table({"text": np.repeat(np.arange(len(lists)), n), "pos": np.arange(len(flat)), "id": flat}))
        got = self.db.sql(DECODE).fetchall()
        self.db.unregister("ids_in")
        out = [""] * len(lists)
        for k, letters in got:
            out[k] = bytes.fromhex(letters).decode()
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str = BYTE_BPE_50K) -> Encoder:
    """The worker's encoder for ``path``, built on first use and kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str = BYTE_BPE_50K) -> DataFrame:
    """(id, ids): the token ids of each text, without special tokens; strings of special tokens are ordinary text.

    Null and empty texts give an empty list. Blank texts and any characters are encoded as they are, and decoding gives the text
    back byte for byte. Nothing is shuffled: each partition splits its texts into words, encodes words it has not met by
    recursive queries on the merge table, and joins the lists. Repeated ids give a row each; other columns are ignored.
    """
    shipped(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                ids = enc.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    return docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id)


def decoded(rows: DataFrame, id: str = "doc_id", ids: str = "ids", path: str = BYTE_BPE_50K) -> DataFrame:
    """(id, text): the text of each list of ids, which encoded() made; null and empty lists give the empty text. Nothing is shuffled."""
    shipped(rows.sparkSession)
    kind = rows.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(enc.decode_many(part.column(1).to_pylist()), pa.string())], names=["id", "text"])

    return rows.select(F.col(id).alias("id"), F.col(ids).alias("ids")).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id)


def token_counts(docs: DataFrame, keep: list[str], text: str = "text", path: str = BYTE_BPE_50K) -> DataFrame:
    """(*keep, n_tokens): how many tokens each text has; 0 for null and empty ones."""
    shipped(docs.sparkSession)
    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                n = [len(x) for x in enc.encode(part.column(len(keep)).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(n, pa.int64())], names=[*keep, "n_tokens"])

    return docs.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(run, f"{kinds}, n_tokens bigint")
