"""Languages of documents and of the stretches inside them, by mixture inference on letter n-grams."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shipped, written

#: The languages told apart, and fixed values: their three-letter codes.
LANGUAGES = ("pt", "es", "en", "fr", "it", "de")
LONG_CODES = {"por": "pt", "spa": "es", "eng": "en", "fra": "fr", "fre": "fr", "ita": "it", "deu": "de", "ger": "de"}

#: Letters in a gram, buckets they are hashed into, and the count added to each bucket.
GRAM, BUCKETS, SMOOTH = 4, 1 << 16, 0.5

#: Neighbouring grams share letters: each counts as this share of independent evidence.
EVIDENCE = 0.25

#: A stretch with fewer letters is read together with the next one.
LEAST_LETTERS = 16

#: Log-likelihood another language must add to a document before it is taken in.
PENALTY = 7.0

#: Steps of the expectation-maximisation of one document.
EM_STEPS = 25

_JOIN = re.compile(r"(?<=[^\W\d_])-[ \t]*\r?\n[ \t]*(?=[^\W\d_])")
_CUT = re.compile(
    r"(?:(?<=[.!?…])[\"'»”’)\]]*\s+(?=[\"'«“‘(\[¿¡]*[^\W\d_a-zß-ÿ])|(?<=[^\W\d_]{4}[.!?…])[\"'»”’)\]]*\s+|(?<=\d\)[.!?…])\s+|\s*[\r\n]+\s*)"
)
_NO_WORDS = re.compile(r"(?i)\b(?:https?://|www\.)\S+|\S+@\S+\.\w+|<[^<>]{1,300}>|&(?:[a-z]{2,8}|#\d{1,6}|#x[0-9a-f]{1,5});")
_WRONG = re.compile(r"[ÃÂâ][\u0080-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]")
_FOLD = {ord("ß"): "ss", ord("æ"): "ae", ord("œ"): "oe", ord("ø"): "o", ord("ł"): "l", ord("đ"): "d", ord("ı"): "i"}


def repaired(text: str) -> str:
    """Text of which UTF-8 bytes were read as a one-byte encoding, put right where that can be undone."""

    def again(m: re.Match) -> str:
        for enc in ("cp1252", "latin-1"):
            try:
                return m[0].encode(enc).decode("utf-8")
            except UnicodeError:
                pass
        return m[0]

    return _WRONG.sub(again, text) if _WRONG.search(text) else text


class _Letters(dict):
    """Each character's letters a to z without accents, in lower case, or a blank; filled as characters are met."""

    def __missing__(self, code: int) -> str:
        t = unicodedata.normalize("NFKD", chr(code).lower().translate(_FOLD)) if code != 0xAD else ""
        self[code] = out = "".join(c if "a" <= c <= "z" else " " for c in t if not unicodedata.combining(c))
        return out


_LETTERS = _Letters()


def folded(text: str) -> str:
    """Only the letters a to z, in words: lower case, accents dropped, soft hyphens too, anything else one blank."""
    return " ".join(text.translate(_LETTERS).split())


def _unescaped(mark: str) -> str:
    """An entity as its letter, an address or a tag as blanks; as long as before."""
    c = html.unescape(mark) if mark[0] == "&" else ""
    return c + "\u00ad" * (len(mark) - len(c)) if len(c) == 1 and c.isalpha() else " " * len(mark)


def stretches(text: str) -> list[tuple[int, int, str]]:
    """(start, end, folded) of the sentences and lines of a text, short ones with the next; those without a letter are left out."""
    text = _JOIN.sub(lambda m: "\u00ad" * len(m[0]), text)  # as long as before, so that places stay right
    text = _NO_WORDS.sub(lambda m: _unescaped(m[0]), text)
    cuts = [0, *(m.end() for m in _CUT.finditer(text)), len(text)]
    out: list[tuple[int, int, str]] = []
    begin, letters = 0, ""
    for a, b in zip(cuts, cuts[1:]):
        letters += folded(repaired(text[a:b])) + " "
        if len(letters.replace(" ", "")) >= LEAST_LETTERS:
            out.append((begin, b, letters))
            begin, letters = b, ""
    if letters.strip():
        if out:
            out[-1] = (out[-1][0], len(text), out[-1][2] + letters)
        else:
            out.append((0, len(text), letters))
    return out


def gram_buckets(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all grams of the pieces, and the piece each belongs to."""
    plain = [" ".join(p.split()) for p in pieces]
    joined = " " + " ".join(p + "  " for p in plain)
    raw = np.frombuffer(joined.encode(), np.uint8).astype(np.int64)
    code = np.where(raw == 32, 0, raw - 96)
    n = len(code) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram = np.zeros(n, np.int64)
    for k in range(GRAM):
        gram = gram * 27 + code[k : k + n]
    lengths = np.array([len(p) + 3 for p in plain])
    owner = np.repeat(np.arange(len(pieces)), lengths)[:n]
    blank = (code[:n] == 0) & (code[1 : n + 1] == 0)
    hashed = (gram * 2654435761 >> 7) % BUCKETS
    return hashed[~blank], owner[~blank]


def plain_label(label: str | None) -> str | None:
    """The two-letter code a delivered label means; None if it means none of the languages."""
    if label is None:
        return None
    first = re.split(r"[-_]", label.strip().lower())[0]
    first = LONG_CODES.get(first, first)
    return first if first in LANGUAGES else None


def _scores(model: np.ndarray, pieces: list[str]) -> np.ndarray:
    """Log-likelihood of each piece in each language."""
    return _scores_of(model, *gram_buckets(pieces), len(pieces))


def _scores_of(model: np.ndarray, bucket: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The sums of the rows of the model by piece; the buckets of a piece stand one behind the other."""
    out = np.zeros((n, len(LANGUAGES)))
    if len(bucket):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        out[owner[starts]] = np.add.reduceat(model[bucket], starts, axis=0, dtype=np.float64)
    return out * EVIDENCE


def mixture(scores: np.ndarray, among: list[int]) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood, proportions and responsibilities of a document's stretches under a set of languages."""
    s = scores[:, among]
    top = s.max(axis=1, keepdims=True)
    like = np.exp(s - top)
    share = np.full(len(among), 1 / len(among))
    for _ in range(EM_STEPS if len(among) > 1 else 1):
        joint = like * share
        total = joint.sum(axis=1, keepdims=True)
        share = (joint / total).mean(axis=0)
    joint = like * share
    total = joint.sum(axis=1, keepdims=True)
    return float((np.log(total) + top).sum()), share, joint / total


def language_set(scores: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The languages of a document, their proportions and the responsibilities per stretch.

    From the best single language on, the language that adds most likelihood is taken in as long as it adds more than the
    penalty. Languages that end as the likeliest of no stretch are dropped again.
    """
    order = np.argsort(-scores.sum(axis=0), kind="stable")
    among = [int(order[0])]
    like, share, of = mixture(scores, among)
    wanted = sorted(set(scores.argmax(axis=1).tolist()) - set(among))
    while wanted:
        tried = [(mixture(scores, [*among, k]), k) for k in wanted]
        (new, s, r), k = max(tried, key=lambda x: (x[0][0], -x[1]))
        if new - like <= PENALTY:
            break
        among, like, share, of = [*among, k], new, s, r
        wanted.remove(k)
    seen = set(of.argmax(axis=1).tolist())
    if len(seen) < len(among):
        among = [k for j, k in enumerate(among) if j in seen]
        _, share, of = mixture(scores, among)
    return among, share, of


def parsed(docs: DataFrame, id: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """(id, label, starts, ends, pieces): the stretches of each document, read once and written, as several passes go over them. Texts without a letter give no row."""
    shipped(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                cut = [stretches(t) if t else [] for t in part.column(1).to_pylist()]
                some = pa.array([i for i, c in enumerate(cut) if c], pa.int32())
                held = [pa.array([[x[k] for x in c] for c in cut if c], pa.list_(t)) for k, t in ((0, pa.int32()), (1, pa.int32()), (2, pa.string()))]
                yield pa.RecordBatch.from_arrays([part.column(0).take(some), part.column(2).take(some), *held], names=["id", "label", "starts", "ends", "pieces"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("t"), F.col(label).cast("string").alias("l"))
    return written(rows.mapInArrow(run, f"id {kind}, label string, starts array<int>, ends array<int>, pieces array<string>"), "stretches")


def _gram_counts(read: DataFrame, model: np.ndarray | None) -> np.ndarray:
    """Grams per bucket and language over all documents: by delivered label, or by the likeliest language of each stretch.

    Each partition sums into one table of fixed size and gives its used buckets; they are summed in one small shuffle, and at most
    BUCKETS rows come back, whatever the corpus.
    """
    names = list(LANGUAGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((BUCKETS, len(names)), np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                lists = part.column(0)
                pieces = lists.flatten().to_pylist()
                bucket, owner = gram_buckets(pieces)
                if model is None:
                    marks = [plain_label(x) for x in part.column(1).to_pylist()]
                    lang = np.repeat([names.index(m) if m else -1 for m in marks], lists.value_lengths().to_numpy(zero_copy_only=False)).astype(int)
                else:
                    lang = _scores_of(model, bucket, owner, len(pieces)).argmax(axis=1)
                of = lang[owner]
                used = of >= 0
                n += np.bincount(bucket[used] * len(names) + of[used], minlength=n.size).reshape(n.shape)
        used = np.flatnonzero(n.sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), *[pa.array(n[used, k]) for k in range(len(names))]], names=["bucket", *names])

    rows = read.select("pieces", "label").mapInArrow(run, "bucket bigint, " + ", ".join(f"{x} bigint" for x in names))
    got = rows.groupBy("bucket").agg(*[F.sum(x).alias(x) for x in names]).toPandas()
    out = np.zeros((BUCKETS, len(names)))
    if len(got):
        out[got["bucket"].to_numpy()] = got[names].to_numpy()
    return out


def _log(counts: np.ndarray) -> np.ndarray:
    smooth = counts + SMOOTH
    return np.log(smooth / smooth.sum(axis=0)).astype(np.float32)


def trained_on(read: DataFrame) -> np.ndarray:
    """Log-probabilities of the gram buckets in each language, from the rows of parsed(): counts by delivered label, then once more by the likeliest language
    of each stretch, which takes wrong labels and mixed texts out. Both passes cover all documents."""
    return _log(_gram_counts(read, _log(_gram_counts(read, None))))


def trained(docs: DataFrame, text: str = "text", label: str = "lang") -> np.ndarray:
    """trained_on() the documents themselves."""
    return trained_on(parsed(docs.withColumn("__id", F.lit(0)), "__id", text, label))


def _is_right(label: str | None, found: list[str]) -> bool:
    return len(found) == 1 and plain_label(label) == found[0]


def document_languages(docs: DataFrame, model: np.ndarray, id: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """(id, label, lang, share, confidence, right, segments): a row per document and language it has a sentence in.

    share is the language's proportion of the document's sentences, confidence the mean probability of the stretches given to it,
    right whether the delivered label is the language of the whole text, segments the stretches as (start, end, confidence).
    Texts that are null, empty or have no letters a to z (after folding) give no rows. Equal evidence takes the language
    earlier in LANGUAGES.
    """
    return languages_of(parsed(docs, id, text, label), model).withColumnRenamed("id", id)


def languages_of(read: DataFrame, model: np.ndarray) -> DataFrame:
    """document_languages() from the rows of parsed()."""
    spark = read.sparkSession
    sent = spark.sparkContext.broadcast(model)  # BUCKETS x languages, a fixed size
    kind = read.schema["id"].dataType.simpleString()
    fields = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("confidence", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                labels, starts, ends = (part.column(k).to_pylist() for k in (1, 2, 3))
                scores = _scores(sent.value, part.column(4).flatten().to_pylist())
                rows: list[tuple] = []
                k = 0
                for i, begins in enumerate(starts):
                    among, share, of = language_set(scores[k : k + len(begins)])
                    k += len(begins)
                    best = of.argmax(axis=1)
                    names = [LANGUAGES[x] for x in among]
                    right = _is_right(labels[i], names)
                    for j, name in enumerate(names):
                        mine = np.flatnonzero(best == j)
                        rows.append((i, labels[i], name, float(share[j]), float(of[mine, j].mean()), right, [{"start": begins[m], "end": ends[i][m], "confidence": float(of[m, j])} for m in mine]))
                if rows:
                    ids = part.column(0).take(pa.array([r[0] for r in rows]))
                    kinds = (pa.string(), pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.list_(fields))
                    yield pa.RecordBatch.from_arrays([ids, *[pa.array([r[n + 1] for r in rows], t) for n, t in enumerate(kinds)]], names=["id", "label", "lang", "share", "confidence", "right", "segments"])

    schema = f"id {kind}, label string, lang string, share double, confidence double, right boolean, segments array<struct<start:int,end:int,confidence:double>>"
    return read.select("id", "label", "starts", "ends", "pieces").mapInArrow(run, schema)


def mislabelled(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """(id, lang): the languages of every document whose label is missing, wrong or of one language where there are more."""
    return found.where(~F.col("right")).select(id, "lang").distinct()


def segments(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """(id, start, end, lang, confidence): every stretch of every document with its language."""
    one: Column = F.explode("segments")
    return found.select(id, "lang", one.alias("s")).select(id, "s.start", "s.end", "lang", "s.confidence")
