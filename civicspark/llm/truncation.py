"""Text values of which the end is missing: a completeness automaton, what ends and what goes on in the corpus, and each source's lengths."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shipped, written

#: Buckets of the table of endings: its size whatever the corpus.
BUCKETS = 1 << 20

#: A word, or its last two words, may end a text if at least this share of its occurrences end one.
LEAST_WORD, LEAST_PAIR = 0.01, 0.03

#: A length is a limit of its source where this many times more values stand than at the lengths around it, on average;
#: a source that cuts between words has its cuts within so many letters.
SPIKE, AROUND, WORD = 3.0, 24, 5

_TAG = re.compile(r"<[^<>]*>")
_BROKEN_TAG = re.compile(r"<(?:/?[A-Za-z][^<>]*|/)?$")
_BROKEN_ENTITY = re.compile(r"&(?:#x?[0-9a-fA-F]*|[A-Za-z]{1,8})$")
_BROKEN_BYTES = re.compile(r"(?:�|[ÃÂ]|â[€]?|\\(?:u[0-9a-fA-F]{0,3}|x[0-9a-fA-F]?)?)$")
_ELLIPSIS = re.compile(r"(?:…|\.{3,}|\[\s*(?:…|\.{3,})\s*\]|\(\s*(?:…|\.{3,})\s*\))$")
_BEHIND = re.compile(r"(?:\([^()]{1,80}\)|·[^·.!?]{1,60}|(?:[^\W\d_][\w ]{0,25}:\s*)?https?://\S*|\[[^\[\]]{1,80}\])$")
_ENDED = re.compile(r"[.!?…][\"'”’»)\]]*$")
_TOKEN = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*|\d+|[.!?…]|[,;:—–]")
_STOPPED_NOTE = re.compile(r"(?:\[\s*(?:…|\.{3})\s*\]|\(\s*(?:…|\.{3}|continua[^()]{0,40})\s*\))\s*\.?$", re.I)
_SHORT = re.compile(r"(?:^|[\s(])(?:arts?|nº|n|inc|al|fls?)\.$", re.I)
_OPENING = re.compile(r"[\"(\[{“«<]")
_OMITTING, _BRACKETS, _MARKS, _CUT_BYTES = frozenset("….])"), frozenset(")]"), frozenset(".!?…\"'”’»)]"), frozenset("\ufffdÃÂâ€")
_ANY = re.compile(r"\w")
_YEAR = re.compile(r"\d/\d{4}$")
_CLOSING = {")": "(", "]": "[", "}": "{", "”": "“", "»": "«"}


def _plain(raw: str) -> str:
    if "<" in raw:
        raw = _TAG.sub(" ", raw)
    return (html.unescape(raw) if "&" in raw else raw).rstrip()


#: What the automaton reads: a tag, an entity, an opening or closing mark.
_MARK = re.compile(r"<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*)?(?P<self>/?)>|&(?:#x?[0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});|(?P<open>[(\[{“«])|(?P<close>[)\]}”»])|(?P<quote>\")")

#: Elements of HTML that are never closed, and those whose closing mark may be left out.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNCLOSED = frozenset("p li dt dd tr td th option body html head tbody thead".split())


def unclosed(raw: str) -> list[str]:
    """The stack a value leaves behind: its quotes, brackets and elements that are opened and never closed, in order.

    The automaton reads the whole value. A closing bracket takes the last open one of its kind, with the brackets inside it, and is passed over if there is none (lists: "a)");
    a closing tag takes the last open element of its name and what was opened inside it; a straight quote closes an open one and opens one otherwise.
    """
    stack: list[str] = []
    for m in _MARK.finditer(raw):
        kind = m.lastgroup
        if m["tag"]:
            name = "<" + m["tag"].lower()
            if m["end"]:
                if name in stack:
                    del stack[len(stack) - 1 - stack[::-1].index(name) :]
            elif not m["self"] and name[1:] not in VOID:
                stack.append(name)
        elif kind == "open":
            stack.append(m["open"])
        elif kind == "close":
            mate = _CLOSING[m["close"]]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "<":
                    break
                if stack[k] == mate:
                    del stack[k:]
                    break
        elif kind == "quote":
            if '"' in stack:
                del stack[len(stack) - 1 - stack[::-1].index('"') :]
            else:
                stack.append('"')
    return [x for x in stack if x[1:] not in UNCLOSED or x[0] != "<"]


def read_end(value: str) -> tuple[str, str | None]:
    """(text, sign): the value without markup and without what was put behind its text, and the sign of a cut, if one shows.

    The signs are 'markup', 'entity', 'bytes' (a tag, entity, escape or multibyte letter that breaks off), 'ellipsis' (a mark of
    omission as the last of the text; inside closed brackets or quotes it is none), 'open' (the automaton ends with a bracket, quote or element never closed)
    and 'short' (the last word before a full stop is one that goes on with a number or a name: "art.", "nº.").
    """
    raw = value.rstrip()
    sign = None
    if raw.rfind("<") > raw.rfind(">") and (m := _BROKEN_TAG.search(raw, raw.rfind("<"))):
        raw, sign = raw[: m.start()].rstrip(), "markup"
    elif "&" in raw[-10:] and (m := _BROKEN_ENTITY.search(raw, max(0, len(raw) - 10))):
        raw, sign = raw[: m.start()].rstrip(), "entity"
    elif (raw[-1:] in _CUT_BYTES or "\\" in raw[-6:]) and (m := _BROKEN_BYTES.search(raw, max(0, len(raw) - 6))):
        raw, sign = raw[: m.start()].rstrip(), "bytes"
    text = _plain(raw)
    while True:
        last = text[-1:]
        if sign is None and last in _OMITTING:
            if m := _ELLIPSIS.search(text, max(0, len(text) - 20)):
                return text[: m.start()].rstrip(), "ellipsis"
            if m := _STOPPED_NOTE.search(text, max(0, len(text) - 90)):  # a note behind the cut that closes with a stop
                return text[: m.start()].rstrip(), "ellipsis"
        if last in _MARKS and _ENDED.search(text, max(0, len(text) - 20)):
            break
        if not (last in _BRACKETS or "·" in text[-62:] or "://" in text[-2000:]) or not (m := _BEHIND.search(text)):
            break
        text = text[: m.start()].rstrip()
    if sign is None and _OPENING.search(raw) and unclosed(raw):
        sign = "open"
    if sign is None and text[-1:] == "." and _SHORT.search(text, max(0, len(text) - 12)):
        sign = "short"
    return text, sign


def _tokens(text: str) -> list[str]:
    """Words in lower case, numbers as 0, ends of sentences as '.', other marks as ','; a capital word inside a sentence is
    a name and stands as '^' with its last three letters, since names are too many to have been seen."""
    out: list[str] = []
    begins = True
    for t in _TOKEN.findall(text):
        c = t[0]
        if c in ".!?…":
            out.append(".")
            begins = True
            continue
        if c in ",;:—–":
            out.append(";" if c == ";" else ",")
            begins = c in "—–:"
            continue
        if c.isdigit():
            out.append("0")
        elif c.isupper() and not begins and len(t) > 2 and t[1:].islower():
            out.append("^" + t[-3:].lower())
        else:
            out.append(t.lower())
        begins = False
    return out


def _bucket(key: str) -> int:
    return zlib.crc32(key.encode()) % BUCKETS


class _Words(dict):
    """Numbers for the tokens of a partition, given as they are met, with what each stands for."""

    def __init__(self) -> None:
        super().__init__()
        self.kind: list[int] = []  # 0 a word, 1 an end mark, 2 another mark, 3 one that begins anew, 4 the end of a value
        self.lower: list[int] = []
        self.name: list[int] = []
        self.word: dict[str, int] = {}
        self.words: list[str] = []

    def number(self, word: str) -> int:
        if word not in self.word:
            self.word[word] = len(self.words)
            self.words.append(word)
        return self.word[word]

    def __missing__(self, t: str) -> int:
        c = t[0]
        self.kind.append(4 if c == "\0" else 1 if c in ".!?…" else 3 if c in "—–:" else 2 if c in ",;" else 0)
        low = self.number("0" if c.isdigit() else t.lower())
        self.lower.append(low)
        self.name.append(self.number("^" + t[-3:].lower()) if c.isupper() and len(t) > 2 and t[1:].islower() else low)
        self[t] = n = len(self)
        return n


_TOKEN_OR_END = re.compile(_TOKEN.pattern + "|\0")


def _follow(texts: list[str], whole: list[bool], title: bool, words: _Words, ends: Counter, goes: Counter) -> None:
    """Count which words and pairs of words end texts of this kind, and behind which they go on; reads like _tokens(), for many texts at once."""
    if not texts:
        return
    t = np.fromiter(map(words.__getitem__, _TOKEN_OR_END.findall("\0".join(["", *(x.replace("\0", " ") for x in texts), ""]))), np.int64)
    kind = np.array(words.kind)[t]
    begins = np.r_[True, kind[:-1] != 0] & np.r_[True, kind[:-1] != 2]
    word = np.where(begins, np.array(words.lower)[t], np.array(words.name)[t])
    is_word = kind == 0
    after = np.r_[kind[1:], 4]
    if title:
        value = np.cumsum(kind == 4) - 1
        sound = np.r_[whole, False][np.clip(value, 0, len(whole))]
        end = is_word & (after == 4) & sound
    else:
        end = is_word & (after == 1)
    go = is_word & np.isin(after, (0, 2, 3))
    pair = np.r_[False, is_word[:-1]] & is_word
    before = np.r_[0, word[:-1]]
    for mask, into in ((end, ends), (go, goes)):
        for key, n in zip(*np.unique(word[mask], return_counts=True)):
            into[int(key)] += int(n)
        both = mask & pair
        for key, n in zip(*np.unique((before[both] + 1 << 32) + word[both], return_counts=True)):
            into[int(key)] += int(n)


def endings(values: DataFrame, text: str, title: str) -> np.ndarray:
    """A table (BUCKETS, 2) of how often words and pairs of words end a text, or a title, and how often it goes on behind them.

    All values count. Each partition sums its own and gives used buckets; one small shuffle adds them up, and at most BUCKETS rows
    come back, whatever the corpus.
    """
    shipped(values.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        counts = {name: (Counter(), Counter()) for name in "dt"}
        for b in batches:
            for name, at in (("d", 0), ("t", 1)):
                read = [read_end(v) for v in b.column(at).to_pylist() if v]
                _follow([t for t, _ in read], [sign is None for _, sign in read], name == "t", words, *counts[name])
        n: dict[int, list[int]] = {}
        known: set[int] = set()
        for name, both in counts.items():
            for j, c in enumerate(both):
                for key, k in c.items():
                    pair = key >> 32
                    text = (words.words[pair - 1] + " " if pair else "") + words.words[key & 0xFFFFFFFF]
                    n.setdefault(_bucket(name + text), [0, 0])[j] += k
                    if j and not pair:
                        known.add(key)
        for begin in {words.words[k][:j] for k in known for j in range(1, len(words.words[k]))}:  # beginnings of words known to be whole
            n.setdefault(_bucket("p" + begin), [0, 0])[1] += 1
        keys = sorted(n)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *[pa.array([n[k][j] for k in keys], pa.int64()) for j in (0, 1)]], names=["bucket", "ends", "goes"])

    rows = values.select(F.col(text).alias("d"), F.col(title).alias("t")).mapInArrow(run, "bucket bigint, ends bigint, goes bigint")
    got = rows.groupBy("bucket").agg(F.sum("ends").alias("ends"), F.sum("goes").alias("goes")).toPandas()
    out = np.zeros((BUCKETS, 2), np.int64)
    if len(got):
        out[got["bucket"].to_numpy()] = got[["ends", "goes"]].to_numpy()
    return out


def _may_end(tokens: list[str], title: bool, table: np.ndarray, year: bool = False) -> bool:
    """Whether a text may end with these words: its last word is a whole one, as it goes on elsewhere or begins no word that does,
    and ends texts often enough, alone and with the word before it. A comma, colon or dash ends
    none; a semicolon is read like a full stop. year: whether a number/year stands last."""
    kind = "t" if title else "d"
    while tokens and tokens[-1] == ";":  # closes a clause, like a full stop
        tokens = tokens[:-1]
    if not tokens or tokens[-1] == ",":
        return not tokens
    tokens = ["," if t == ";" else t for t in tokens]
    words = [w for w in tokens if w not in ".,"]
    if not words:
        return True
    w = words[-1]
    before = words[-2] if len(words) > 1 and tokens[-2:-1] == [words[-2]] else ""

    def count(key: str) -> np.ndarray:
        return table[_bucket(kind + key)]

    def whole(x: str) -> bool:
        if x == "0":
            return True
        (ends, goes), (last, on) = table[_bucket("d" + x)].tolist(), table[_bucket("t" + x)].tolist()
        return ends > 1 or goes + on > max(1, 0.1 * last) or (last > 2 and table[_bucket("p" + x), 1] == 0)

    if not whole(w) and not w.startswith("^") and len(w) > 3:
        w = "^" + w[-3:]
    if not whole(w):
        return False
    if title and (len(words) == 1 or (w == "0" and year)):  # a title that only names a kind, or a kind and a number
        return True
    e, g = count(w)
    if e < LEAST_WORD * (e + g) or e == 0:
        return False
    if before:
        e, g = count(before + " " + w)
        if e == 0 or e < LEAST_PAIR * (e + g):
            return False
        if title and g == 0 and len(w) < 4 and table[_bucket("d" + w)].any() and table[_bucket("d" + before + " " + w)].sum() < 0.2 * e:
            return False  # a short word that meets the one before at cut ends only
    return True


def classified(values: DataFrame, table: np.ndarray, id: str, source: str, fields: tuple[str, ...], titles: tuple[str, ...]) -> DataFrame:
    """(id, source, campo, n, ended, sign, blank, bare): one row per value; n its length in code points, ended whether its text ends with a
    mark, sign why it counts as cut ('words' where only its last words tell), or null; blank whether white space stands last, bare whether
    nothing was put behind the text. Null values and values without a letter
    or digit give no row."""
    spark = shipped(values.sparkSession)
    sent = spark.sparkContext.broadcast(table)  # BUCKETS x 2, a fixed size
    kind = values.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = sent.value
        for b in batches:
            for k, name in enumerate(fields):
                is_title = name in titles
                at: list[int] = []
                rows: list[tuple] = []
                for i, v in enumerate(b.column(k + 2).to_pylist()):
                    if not v or not _ANY.search(v):
                        continue
                    read, sign = read_end(v)
                    ended = bool(_ENDED.search(read))
                    alone = read[-1:].islower() and not read[-2:-1].isalnum()  # a single small letter ends no text
                    if sign is None and not ended and (alone or not _may_end(_tokens(read[-160:]), is_title, t, bool(_YEAR.search(read, max(0, len(read) - 12))))):
                        sign = "words"
                    tail = v.rstrip()
                    at.append(i)
                    rows.append((len(v), ended, sign, len(tail) < len(v), len(read) == len(tail)))
                take = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), b.column(1).take(take), pa.array([name] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.bool_()), pa.array([r[4] for r in rows], pa.bool_())],
                    names=["id", "source", "campo", "n", "ended", "sign", "blank", "bare"],
                )

    rows = values.select(F.col(id).alias("id"), F.col(source).cast("string").alias("source"), *fields)
    return rows.mapInArrow(run, f"id {kind}, source string, campo string, n int, ended boolean, sign string, blank boolean, bare boolean")


def with_baselines(rows: DataFrame) -> DataFrame:
    """The rows of classified() with the signs that only show against their source: 'limit' and 'blank', for values without an end mark.

    'limit': a value with nothing behind it at a length where the values that would pass by their words are SPIKE times as many as on average
    around, and where cut values gather as well; at that length exactly, or within WORD letters of it where a source cuts between words.
    'blank': white space stands last, in a source where it (nearly) never does behind an end mark.
    Counts per source, field and length are a small table; it meets the rows in a join of the planner's choice.
    """
    open_ = F.col("sign").isNull() & ~F.col("ended")
    key = ["source", "campo"]
    n = rows.groupBy(*key, "n").agg(
        F.count_if(open_ & F.col("bare")).alias("open"), F.count_if(F.col("sign").isin("words", "bytes", "open")).alias("cut"), F.count_if("ended").alias("ended"),
        F.count_if(F.col("ended") & F.col("blank")).alias("ended_blank"), F.count_if(~F.col("ended")).alias("rest"), F.count_if(~F.col("ended") & F.col("blank")).alias("rest_blank"),
    )
    n = written(n, "lengths")
    within = lambda c, k: F.sum(c).over(Window.partitionBy(*key).orderBy("n").rangeBetween(-k, k))  # noqa: E731  # a row per length
    near = n.select(*key, "n", "open", "cut", *[within(c, k).alias(f"{c}_{k}") for c in ("open", "cut") for k in (WORD, AROUND)])
    far = lambda c: F.col(f"{c}_{AROUND}") - F.col(f"{c}_{WORD}")
    lengths = 2 * (AROUND - WORD)
    exact = [(F.col(c) >= 3) & (F.col(c) > SPIKE * (F.col(f"{c}_{AROUND}") - F.col(c)) / (2 * AROUND)) for c in ("open", "cut")]
    wide = [(F.col(f"{c}_{WORD}") >= 5) & (F.col(f"{c}_{WORD}") / (2 * WORD + 1) > SPIKE * far(c) / lengths) for c in ("open", "cut")]
    spiked = near.select(*key, "n", (exact[0] & exact[1]).alias("exact"), (wide[0] & wide[1]).alias("wide"))
    none_near = F.max("exact").over(Window.partitionBy(*key).orderBy("n").rangeBetween(-WORD, WORD)) == F.lit(False)
    limits = spiked.withColumn("limit", F.col("exact") | (F.col("wide") & none_near)).where("limit")
    blanks = n.groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("ended", "ended_blank", "rest", "rest_blank")])
    rare = F.when(F.col("ended") > 0, F.col("ended_blank") <= 0.02 * F.col("ended")).otherwise(F.col("rest_blank") <= 0.02 * F.col("rest"))
    limits = limits.select(F.col("source").alias("s"), F.col("campo").alias("c"), F.col("n").alias("l"), "limit")
    blanks = blanks.where(rare).select(F.col("source").alias("s2"), F.col("campo").alias("c2"), F.lit(True).alias("rare"))
    both = rows.join(limits, F.col("source").eqNullSafe(F.col("s")) & (F.col("campo") == F.col("c")) & (F.col("n") == F.col("l")), "left")
    both = both.join(blanks, F.col("source").eqNullSafe(F.col("s2")) & (F.col("campo") == F.col("c2")), "left")
    sign = F.when(open_ & F.col("limit") & F.col("bare"), "limit").when(open_ & F.col("rare") & F.col("blank"), "blank").otherwise(F.col("sign"))
    return both.withColumn("sign", sign).select(*rows.columns)


def truncated(values: DataFrame, id: str = "registro", source: str = "orgao", text: str = "descricao", title: str = "titulo") -> DataFrame:
    """(id, source, campo, n, ended, sign) of every value of text and title, sign telling why its end is missing; null if it is not.

    Null, empty and mark-only values are no cases. Two passes over the whole table; nothing but counts is shuffled, what the second finds
    is written once, and rows that repeat an id are judged one by one.
    """
    table = endings(values, text, title)
    return with_baselines(written(classified(values, table, id, source, (title, text), (title,)), "read-ends"))


def truncation_shares(rows: DataFrame, source: str = "orgao") -> DataFrame:
    """(source, campo, valores, cortados, parte): values, cut values and their share, per source and field."""
    return rows.groupBy(F.col("source").alias(source), "campo").agg(
        F.count(F.lit(1)).alias("valores"), F.count("sign").alias("cortados"), (F.count("sign") / F.count(F.lit(1))).alias("parte")
    )
