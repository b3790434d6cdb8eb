"""Spellings of one person's name: a radius join of name parts in cells of a metric space, judged pair by pair and merged."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shipped, written

#: Slips (insert, delete, replace, two letters in each other's place) within which two family names, or two given names, may be one.
SLIPS = 2

#: A part of a name found in more states than this is a common one: a given name, or a family name of many families.
COMMON_STATES = 4

#: Names of a block among which its pivots are looked for, about, pivots of a block at most, and names of a cell met in one task.
SAMPLE, MOST_PIVOTS, CHUNK = 512, 128, 1000

#: Longest part of a name that many_slips() takes; longer ones are judged one by one.
LONGEST = 40

#: Rounds in which names with less detail join the one person they fit.
ROUNDS = 4

#: Particles, titles, and words that tell relatives apart (with their short forms).
PARTICLES = {"de", "da", "do", "das", "dos", "e", "d", "del", "di"}
TITLES = {"sen", "dep", "senador", "senadora", "deputado", "deputada", "dr", "dra", "prof", "profa", "professor", "professora", "sr", "sra", "ver", "vereador", "vereadora", "gov", "min", "exmo", "exma", "cel", "pr"}
RELATIVES = {"filho": "filho", "fo": "filho", "fh": "filho", "filha": "filha", "neto": "neto", "nt": "neto", "neta": "neta", "junior": "junior", "jr": "junior", "jnr": "junior", "sobrinho": "sobrinho", "segundo": "segundo"}

#: Short and pet names, and the given names they are used for.
PET_NAMES = {
    "ze": ("jose",), "zeca": ("jose",), "zezinho": ("jose",), "juca": ("jose",), "chico": ("francisco",), "kiko": ("francisco",), "paco": ("francisco",),
    "beto": ("roberto", "alberto", "humberto", "adalberto", "gilberto", "norberto"), "bob": ("roberto",), "robertinho": ("roberto",), "tiao": ("sebastiao",), "bastiao": ("sebastiao",),
    "toninho": ("antonio",), "tonho": ("antonio",), "tom": ("antonio",), "toni": ("antonio",), "nando": ("fernando",), "nanda": ("fernanda",), "fe": ("fernanda", "felipe", "fernando"),
    "lipe": ("felipe",), "cadu": ("carlos", "eduardo", "ricardo"), "kadu": ("carlos", "eduardo", "ricardo"), "caca": ("carlos", "claudia"), "carlinhos": ("carlos",), "dudu": ("eduardo",), "edu": ("eduardo",), "duda": ("eduarda", "eduardo"),
    "gui": ("guilherme",), "guiga": ("guilherme",), "guga": ("gustavo",), "gu": ("gustavo", "guilherme"), "gege": ("geraldo",), "gera": ("geraldo",), "gegeu": ("geraldo",), "guida": ("margarida",), "bel": ("isabel",), "bela": ("isabela",), "isa": ("isabel", "isabela", "isaura"),
    "bia": ("beatriz", "bianca"), "tati": ("tatiana",), "pati": ("patricia",), "lena": ("helena", "madalena", "marilena"), "leninha": ("helena",), "nena": ("helena",), "juju": ("juliana", "julia"), "ju": ("juliana", "julia"), "jana": ("janaina", "joana"),
    "mundico": ("raimundo",), "mundinho": ("raimundo",), "bene": ("benedito",), "dito": ("benedito",), "cica": ("cecilia",), "ceci": ("cecilia",), "ciça": ("cecilia",), "lulu": ("luisa", "lucia", "luis"), "lu": ("luisa", "luciana", "lucia", "luciano", "luis"), "luizinha": ("luisa",), "quincas": ("joaquim",), "quim": ("joaquim",), "joca": ("joao", "joaquim"),
    "mane": ("manuel", "manoel"), "manu": ("manuel", "manuela"), "neco": ("manuel",), "nelinho": ("manuel", "nelson"), "mingo": ("domingos",), "mingos": ("domingos",), "fredo": ("alfredo",), "fred": ("alfredo", "frederico"), "rafa": ("rafael", "rafaela"), "nati": ("natalia",), "naty": ("natalia",), "paulinho": ("paulo",), "paulao": ("paulo",),
    "gabi": ("gabriela", "gabriel"), "biel": ("gabriel",), "leo": ("leonardo",), "dani": ("daniela", "daniel"), "rick": ("ricardo", "henrique"), "rico": ("ricardo",), "rique": ("henrique",), "kike": ("henrique",), "marcelinho": ("marcelo",), "tche": ("marcelo",), "lelo": ("marcelo",), "tetê": ("teresa",), "tete": ("teresa",), "teca": ("teresa",), "tê": ("teresa",),
    "vivi": ("viviane", "vitoria"), "vi": ("vitoria", "vitor"), "vitinho": ("vitor",), "drica": ("adriana",), "dri": ("adriana",), "mari": ("mariana", "maria", "marina"), "mila": ("camila",), "cami": ("camila",), "dinho": ("bernardo", "eduardo"), "be": ("bernardo", "beatriz"), "cris": ("cristiano", "cristina", "cristiane"), "cristi": ("cristiano",), "rege": ("regina",), "gina": ("regina",),
    "deni": ("denise",), "dede": ("denise", "andre", "debora"), "deb": ("debora",), "debi": ("debora",), "lari": ("larissa",), "lala": ("larissa",), "claudinha": ("claudia",), "clau": ("claudia", "clarice"), "raque": ("raquel",), "quel": ("raquel",), "nel": ("nelson",), "nelsinho": ("nelson",), "ton": ("wellington", "milton"), "tuca": ("arthur", "antonio"), "guto": ("augusto",), "gugu": ("augusto", "gustavo"), "rosinha": ("rosa", "rosana"), "zana": ("rosana",), "xande": ("alexandre",), "ale": ("alexandre", "alessandra"), "lili": ("liliane", "lidia", "elisa"), "sil": ("silvia",), "silvinha": ("silvia",), "vini": ("vinicius",), "ste": ("estela",), "telinha": ("estela",), "otavinho": ("otavio",), "tavinho": ("otavio", "gustavo"), "tavo": ("gustavo", "otavio"), "si": ("simone",), "moni": ("monica",), "moca": ("monica",), "nico": ("nicolas", "anicio"), "waguinho": ("wagner",), "pri": ("priscila",), "prica": ("priscila",), "lo": ("lorena",), "lore": ("lorena",), "jo": ("joana", "jonas"), "joaninha": ("joana",), "jaque": ("jaqueline",), "line": ("jaqueline", "aline"), "fabi": ("fabiola", "fabiana"), "bibi": ("fabiola", "bianca"), "raul": (), "vicentinho": ("vicente",), "serginho": ("sergio",), "celsinho": ("celso",), "heli": ("heitor",), "maricio": ("mauricio",), "mau": ("mauricio", "mauro"), "mica": ("mirela",), "eli": ("eliseu",), "geninho": ("eugenio",), "lavo": ("olavo",), "landinho": ("orlando",), "lando": ("orlando",), "sinho": ("damiao",), "mig": ("miguel",),
}

_BESIDE = re.compile(r"\[[^\]]*\]|\([^)]*\)|\s[-–—/]\s*[A-Za-z]{2,6}(?:\s*[-/]\s*[A-Za-z]{2})?\s*$")
_PART = re.compile(r"[a-z]+")


def name_parts(name: str | None) -> tuple[list[str], str]:
    """(parts, relative): a name's parts in the order given-family, folded to a-z, without titles, particles and what stands beside the name;
    and the word that tells relatives apart, or ''. "Family, Given" is turned round. A name without a letter has no parts."""
    t = _BESIDE.sub(" ", " " + (name or "").replace("\xa0", " ").strip())
    t = t.lower().replace("fº", "filho").replace("fª", "filha").replace("º", "").replace("ª", "")
    t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    pieces = [_PART.findall(p.replace("'", "").replace("’", "")) for p in t.split(",")]
    pieces = [p for p in pieces if p]
    relative = ""
    kept: list[list[str]] = []
    for p in pieces:
        out = []
        for k, w in enumerate(p):
            if w in RELATIVES and (k or len(p) == 1) and w not in ("segundo",):
                relative = RELATIVES[w]
            elif w not in PARTICLES and not (w in TITLES and len(p) > 1 and len(w) > 1):
                out.append(w)
        if out:
            kept.append(out)
    if len(kept) == 2:
        kept.reverse()
    return [w for p in kept for w in p], relative


def edits(a: str, b: str, most: int) -> int:
    """Levenshtein distance, or most + 1 where it is greater."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, above[j] + 1, above[j - 1] + (x != y)))
        if min(row) > most:
            return most + 1
    return row[-1]


@lru_cache(maxsize=200_000)
def slips(a: str, b: str, most: int) -> int:
    """Like edits(), but two letters in each other's place are one slip (unrestricted Damerau-Levenshtein, a metric)."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    far = len(a) + len(b)
    last: dict[str, int] = {}
    d = [[far] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    for i, x in enumerate(a, 1):
        match = 0
        for j, y in enumerate(b, 1):
            k, m = last.get(y, 0), match
            if x == y:
                match = j
            d[i + 1][j + 1] = min(d[i][j] + (x != y), d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][m] + i - k + j - m - 1)
        last[x] = i
    return d[len(a) + 1][len(b) + 1]


def many_slips(a: list[str], b: list[str]) -> np.ndarray:
    """slips() of many pairs of parts at once, without a limit."""
    out = np.zeros(len(a), np.int64)
    long = [i for i in range(len(a)) if max(len(a[i]), len(b[i])) > LONGEST]
    for i in long:
        out[i] = slips(a[i], b[i], len(a[i]) + len(b[i]))
    rest = np.setdiff1d(np.arange(len(a)), long)
    for at in range(0, len(rest), 5000):
        some = rest[at : at + 5000]
        out[some] = _table_slips([a[i] for i in some], [b[i] for i in some])
    return out


def _table_slips(a: list[str], b: list[str]) -> np.ndarray:
    n, ar = len(a), np.arange(len(a))
    la, lb = (np.array([len(x) for x in s]) for s in (a, b))

    def codes(words: list[str], width: int) -> np.ndarray:
        out = np.zeros((n, width), np.int64)
        for i, w in enumerate(words):
            out[i, : len(w)] = [ord(c) - 96 if "a" <= c <= "z" else 27 for c in w]
        return out

    x, y = codes(a, la.max()), codes(b, lb.max())
    far = (la + lb).astype(np.int16)
    d = np.empty((x.shape[1] + 2, y.shape[1] + 2, n), np.int16)
    d[0], d[:, 0] = far, far
    d[1:, 1] = np.arange(x.shape[1] + 1)[:, None]
    d[1, 1:] = np.arange(y.shape[1] + 1)[:, None]
    last = np.zeros((n, 28), np.int64)
    for i in range(1, x.shape[1] + 1):
        match = np.zeros(n, np.int64)
        for j in range(1, y.shape[1] + 1):
            k, same = last[ar, y[:, j - 1]], x[:, i - 1] == y[:, j - 1]
            swapped = d[k, match, ar] + i - k + j - match - 1
            d[i + 1, j + 1] = np.minimum(np.minimum(d[i, j] + ~same, swapped), np.minimum(d[i + 1, j], d[i, j + 1]) + 1)
            match = np.where(same, j, match)
        last[ar, x[:, i - 1]] = i
    return d[la + 1, lb + 1, ar]


def _allowed(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return 0 if n < 4 else 1 if n < 7 else 2


@lru_cache(maxsize=200_000)
def same_given(a: str, b: str) -> bool:
    """Whether two given names may be one: equal, an initial of the other, a pet name of it, or a slip or two away."""
    if a == b:
        return True
    if len(a) == 1 or len(b) == 1:
        return a[0] == b[0] or any(x[0] == (a if len(a) == 1 else b) for x in PET_NAMES.get(b if len(a) == 1 else a, ()))
    for x, y in ((a, b), (b, a)):
        if any(slips(z, y, _allowed(z, y)) <= _allowed(z, y) for z in PET_NAMES.get(x, ())):
            return True
    if set(PET_NAMES.get(a, ())) & set(PET_NAMES.get(b, ())):
        return True
    return slips(a, b, _allowed(a, b)) <= _allowed(a, b) and not (a in PET_NAMES and b in PET_NAMES)


def read_names(rows: DataFrame, id: str, name: str, state: str, group: str) -> DataFrame:
    """(id, state, grp, parts, relative), without repeats: the parts of each name, the state in capitals (null where blank)."""
    shipped(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            read = [name_parts(n) for n in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([p for p, _ in read], pa.list_(pa.string())), pa.array([r for _, r in read], pa.string())],
                names=["id", "state", "grp", "parts", "relative"],
            )

    picked = rows.select(
        F.col(id).cast("string").alias("id"), F.nullif(F.upper(F.trim(F.col(state))), F.lit("")).alias("state"), F.col(group).cast("string").alias("grp"), F.col(name).cast("string").alias("name")
    )
    read = picked.where("id IS NOT NULL").distinct().mapInArrow(run, "id string, state string, grp string, parts array<string>, relative string")
    return read.where(F.size("parts") > 0)


def with_kinds(nodes: DataFrame) -> DataFrame:
    """``nodes`` with kinds: a letter per part, 'g' a common given name, 'c' a common family name, 'u' any other, 'i' an initial.

    A part is common if more than COMMON_STATES states have it; a common part is a given name if it often stands first. Names with
    letters mistyped, and the names of single families, are found in few states whatever the size of the table.
    """
    at = nodes.select("node", "state", F.posexplode("parts").alias("k", "part"))
    seen = at.groupBy("part", "state").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("k") == 0).alias("first"))  # small before states are counted
    use = seen.groupBy("part").agg(F.count("state").alias("states"), F.sum("n").alias("n"), F.sum("first").alias("first"))
    common = F.col("states") > COMMON_STATES
    kind = (
        F.when(F.length("part") == 1, "i").when(common & (F.col("first") >= 0.2 * F.col("n")), "g").when(common, "c").otherwise("u")
    )
    marked = at.join(use.select("part", kind.alias("kind")), "part")
    kinds = marked.groupBy("node").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "kind"))), lambda x: x["kind"]), "").alias("kinds"))
    return nodes.join(kinds, "node")


def _readings(parts: list[str], kinds: str) -> list[tuple[int, list[int]]]:
    """(place of the family name, places of given names in order) of each way to read a name: any rare part may be the family name."""
    places = range(len(parts))
    family = [k for k in places if kinds[k] == "u" and len(parts[k]) > 3]
    if not family:
        family = [k for k in places if kinds[k] == "c"][-1:] or [len(parts) - 1]
    out = []
    for f in family:
        given = [k for k in places if k != f and kinds[k] in "gi"]
        rare = [k for k in places if k != f and kinds[k] == "u"]
        pet = [k for k in rare if parts[k] in PET_NAMES]
        first = sorted(given + pet) or rare
        rest = [k for k in rare if k not in pet and k not in first]
        if rest and first and rest[0] < first[0] and f > rest[0]:  # a given name mistyped, before the second one
            out.append((f, sorted(first + rest)))
        else:
            out.append((f, sorted(first) + rest))
    return out


def placed_keys(nodes: DataFrame) -> DataFrame:
    """(state, initial, kind, family, given, node): the places of a name in the metric space, for each way to read it.

    A full given name stands (kind 'f') with itself and the names it is short for, each under its own initial. Names with an initial only ('o') meet all
    of that initial, which stand there without their given name ('i') and don't meet one another; names without a given name ('n') meet their like.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = set()
            for i, (parts, kinds) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                for f, given in _readings(parts, kinds):
                    g = parts[given[0]] if given else ""
                    if len(g) < 2:
                        rows.add((i, g, "o" if g else "n", parts[f], ""))
                        continue
                    for form in {g, *PET_NAMES.get(g, ())}:
                        rows |= {(i, form[0], "f", parts[f], form), (i, form[0], "i", parts[f], "")}
            rows = sorted(rows)
            take = pa.array([r[0] for r in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), *[pa.array([r[k] for r in rows], pa.string()) for k in (1, 2, 3, 4)]], names=["node", "state", "initial", "kind", "family", "given"])

    return nodes.select("node", "state", "parts", "kinds").mapInArrow(run, "node bigint, state string, initial string, kind string, family string, given string").distinct()


def _widely(rows: DataFrame, *by: str | Column) -> DataFrame:
    """Rows over all cores before a step of much work on little data, which would else be put into few tasks."""
    spark = rows.sparkSession
    return rows.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *by)


def _distances(xs: list[tuple[str, str]], ys: list[tuple[str, str]]) -> np.ndarray:
    """The greater of the slips between the first parts and those between the second ones: a metric, as the greater of two metrics is one."""
    return np.maximum(*[many_slips([x[k] for x in xs], [y[k] for y in ys]) for k in (0, 1)])


@lru_cache(maxsize=200_000)
def _bag(word: str) -> np.ndarray:
    """How often each letter stands in a word; other characters together."""
    return np.bincount([ord(c) - 97 if "a" <= c <= "z" else 26 for c in word], minlength=27).astype(np.int16) if word else np.zeros(27, np.int16)


def _once(xs: list[tuple[str, str]], ys: list[tuple[str, str]]) -> np.ndarray:
    """_distances(), with the slips between two words counted once."""
    out = np.zeros(len(xs), np.int64)
    for k in (0, 1):
        at: dict[tuple[str, str], int] = {}
        place = [at.setdefault((x[k], y[k]), len(at)) for x, y in zip(xs, ys)]
        if at:
            out = np.maximum(out, many_slips([a for a, _ in at], [b for _, b in at])[place])
    return out


def to_pivots(groups: list[tuple[list[tuple[str, str]], list[tuple[str, str]]]], most: int) -> list[np.ndarray]:
    """For each group (names, pivots) the distances of the names to the pivots; where one is more than ``most``, possibly only a bound from below that is so as well.

    Words differ by as many slips at least as letters are missing in one of them, whatever their order. Slips are counted only where this bound leaves room, for all groups at once.
    """
    out = []
    for names, pivots in groups:
        low = np.zeros((len(names), len(pivots)), np.int64)
        for k in (0, 1):
            more = np.array([_bag(x[k]) for x in names])[:, None, :] - np.array([_bag(x[k]) for x in pivots])[None, :, :]
            low = np.maximum(low, np.maximum(np.maximum(more, 0).sum(axis=2), np.maximum(-more, 0).sum(axis=2)))
        out.append(low)
    places = [np.nonzero(low <= most) for low in out]
    exact = _once([g[0][i] for g, (r, _) in zip(groups, places) for i in r.tolist()], [g[1][j] for g, (_, c) in zip(groups, places) for j in c.tolist()])
    at = 0
    for low, (r, c) in zip(out, places):
        low[r, c] = exact[at : at + len(r)]
        at += len(r)
    return out


def pivots_of(names: list[tuple[str, str]], radius: int) -> list[tuple[str, str]]:
    """Names of which no two are within twice the radius of one another, as many as there are in this order, MOST_PIVOTS at most."""
    out: list[tuple[str, str]] = []
    bags = np.zeros((2, MOST_PIVOTS, 27), np.int16)
    for x in names:
        if len(out) == MOST_PIVOTS:
            break
        more = np.array([_bag(x[0]), _bag(x[1])])[:, None, :] - bags[:, : len(out)]
        low = np.maximum(np.maximum(more, 0).sum(axis=2), np.maximum(-more, 0).sum(axis=2)).max(axis=0)  # no pair has fewer slips
        near = (out[j] for j in np.flatnonzero(low <= 2 * radius).tolist())
        if not any(max(slips(x[0], p[0], 2 * radius), slips(x[1], p[1], 2 * radius)) <= 2 * radius for p in near):
            bags[0, len(out)], bags[1, len(out)] = _bag(x[0]), _bag(x[1])
            out.append(x)
    return out


def celled(objects: DataFrame, key: list[str], radius: int = SLIPS) -> DataFrame:
    """(*key, family, given, cell, core): each name in the cell of its nearest pivot (core), and copied to every lower cell that can hold a name within the radius.

    Blocks of one key are infinitely far from one another. The pivots of a block are names of a sample of about SAMPLE (drawn by hash) that lie apart. A cell holds the names that are within
    twice the radius of its pivot, as their nearest; names farther from all pivots share the last cell of their block. Two names within the radius have distances to any pivot that differ by
    the radius at most, so a name is copied to the lower cells whose pivot is within three times the radius, and, if it has a cell of a pivot itself, at most twice the radius farther than that:
    two near names share the lower of their cells, and no other as one's own.
    """
    distinct = objects.select(*key, "family", "given").distinct()
    sizes = distinct.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    drawn = distinct.join(sizes, key).where(F.pmod(F.xxhash64("family", "given"), F.col("n")) < SAMPLE)
    samples = drawn.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(F.xxhash64("given", "family").alias("h"), "family", "given"))).alias("sample"))
    schema = ", ".join(f"{k} string" for k in key)

    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [pivots_of([(r["family"], r["given"]) for r in names], radius) for names in b.column(len(key)).to_pylist()]
            held = pa.array([",".join(f"{f}|{g}" for f, g in p) for p in found], pa.string())  # one value per block, which is read once wherever it comes
            yield pa.RecordBatch.from_arrays([*b.columns[: len(key)], held], names=[*key, "pivots"])

    pivots = samples.mapInArrow(picked, schema + ", pivots string")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                names = list(zip(part.column(len(key)).to_pylist(), part.column(len(key) + 1).to_pylist()))
                of = part.column(len(key) + 2).fill_null("|").dictionary_encode()  # none drawn: one cell
                block = of.indices.to_numpy(zero_copy_only=False)
                groups = [(np.flatnonzero(block == k).tolist(), [tuple(p.split("|")) for p in text.split(",")]) for k, text in enumerate(of.dictionary.to_pylist())]
                rows = []
                found = to_pivots([([names[i] for i in which], ps) for which, ps in groups], 3 * radius)
                for (which, _), far in zip(groups, found):
                    for i, d in zip(which, far):
                        own, least = int(d.argmin()), int(d.min())
                        if least > 2 * radius:
                            own, least = len(d), radius  # the last cell
                        rows += [(i, int(c), False) for c in np.flatnonzero(d[:own] <= min(3 * radius, least + 2 * radius))]
                        rows.append((i, own, True))
                take = pa.array([r[0] for r in rows], pa.int32())
                yield pa.RecordBatch.from_arrays([*[c.take(take) for c in part.columns[: len(key) + 2]], pa.array([r[1] for r in rows], pa.int32()), pa.array([bool(r[2]) for r in rows], pa.bool_())], names=[*key, "family", "given", "cell", "core"])

    at = distinct.join(pivots, key, "left").select(*key, "family", "given", "pivots")
    together = _widely(at, *key, F.pmod(F.xxhash64("family", "given"), F.lit(8))).sortWithinPartitions(*key)  # a large block in eight parts
    return together.mapInArrow(placed, schema + ", family string, given string, cell int, core boolean")


def radius_pairs(objects: DataFrame, key: list[str], radius: int = SLIPS) -> DataFrame:
    """(*key, family_a, given_a, family_b, given_b): all pairs of names (family, given) of one block within ``radius`` slips in both parts, and each name with itself.

    Names meet in the cells of celled(), its own names with all that lie in it, in chunks of bounded size. Spark's Levenshtein distance is at most twice the slips and leaves out
    most pairs; slips decide on the rest. Nothing is left out, whatever the sizes.
    """
    placed = written(celled(objects, key, radius), "name-cells")
    chunks = placed.groupBy(*key, "cell").agg(F.ceil(F.count_if("core") / CHUNK).cast("int").alias("chunks"))
    placed = placed.join(chunks, [*key, "cell"]).where("chunks > 0")
    chunk = F.pmod(F.xxhash64("family", "given"), F.col("chunks")).cast("int")
    left = placed.where("core").select(*key, "cell", chunk.alias("chunk"), F.col("family").alias("family_a"), F.col("given").alias("given_a"))
    right = placed.select(*key, "cell", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("family").alias("family_b"), F.col("given").alias("given_b"), "core")
    close = lambda c: (F.abs(F.length(f"{c}_a") - F.length(f"{c}_b")) <= radius) & (F.levenshtein(f"{c}_a", f"{c}_b", 2 * radius) >= 0)
    once = (~F.col("core")) | (F.struct("family_a", "given_a") <= F.struct("family_b", "given_b"))
    met = left.join(right.hint("merge"), [*key, "cell", "chunk"]).where(once & close("family") & close("given"))
    cols = ["family_a", "given_a", "family_b", "given_b"]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fa, ga, fb, gb = (b.column(len(key) + k).to_pylist() for k in range(4))
            if fa:
                yield b.filter(pa.array(_distances(list(zip(fa, ga)), list(zip(fb, gb))) <= radius))

    schema = ", ".join(f"{k} string" for k in [*key, *cols])
    return _widely(met.select(*key, *cols)).mapInArrow(judged, schema)


def _judged(pa_: list[str], ka: str, pb: list[str], kb: str) -> str | None:
    """What two names of one state and relative are to each other: 'same' person with the same detail, 'less' or 'more' detail in the
    first, 'mixed' where each lacks something, or None for two persons. The best of all readings counts."""
    best = None
    order = {None: 0, "mixed": 1, "less": 2, "more": 2, "same": 3}
    for fa, ga in _readings(pa_, ka):
        for fb, gb in _readings(pb, kb):
            x, y = pa_[fa], pb[fb]
            if x != y and (len(x) < 4 or len(y) < 4 or slips(x, y, SLIPS) > SLIPS):
                continue
            got = _compared(pa_, ka, fa, ga, pb, kb, fb, gb)
            if order[got] > order[best]:
                best = got
    return best


def _compared(a: list[str], ka: str, fa: int, ga: list[int], b: list[str], kb: str, fb: int, gb: list[int]) -> str | None:
    less = more = False
    if ga and gb:
        x, y = a[ga[0]], b[gb[0]]
        if not same_given(x, y):
            return None
        less, more = len(x) == 1 < len(y), len(y) == 1 < len(x)
    elif ga or gb:
        less, more = not ga, not gb
    rest_a = [(a[k], ka[k]) for k in range(len(a)) if k != fa and k not in ga[:1]]
    rest_b = [(b[k], kb[k]) for k in range(len(b)) if k != fb and k not in gb[:1]]
    for x in list(rest_a):
        for y in list(rest_b):
            if same_given(x[0], y[0]) and not ({x[1], y[1]} == {"i", "c"}):
                rest_a.remove(x)
                rest_b.remove(y)
                less, more = less or len(x[0]) == 1 < len(y[0]), more or len(y[0]) == 1 < len(x[0])
                break
    kinds_a = {"c" if k == "c" else "g" for _, k in rest_a}
    kinds_b = {"c" if k == "c" else "g" for _, k in rest_b}
    if kinds_a & kinds_b:
        return None
    less, more = less or bool(rest_b), more or bool(rest_a)
    return "mixed" if less and more else "less" if less else "more" if more else "same"


def judged_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, verdict, same_group) of the candidate pairs that may be one person; a state that is missing is detail that lacks."""
    side = lambda s: nodes.select(*[F.col(c).alias(f"{c}_{s}") for c in ("node", "state", "grp", "parts", "kinds", "relative")])
    full = pairs.join(side("a"), F.col("a") == F.col("node_a")).join(side("b"), F.col("b") == F.col("node_b"))
    full = full.where((F.col("relative_a") == F.col("relative_b")) & F.coalesce(F.col("state_a") == F.col("state_b"), F.lit(True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            c = [t.column(k).to_pylist() for k in range(2, 9)]
            out = []
            for pa_, ka, pb, kb, sa, sb, alike in zip(*c):
                v = _judged(pa_, ka, pb, kb)
                if v == "same" and sa is None and sb is None and not alike:
                    v = "mixed"  # without a state nor a group in common they may be namesakes
                if v and (sa is None) != (sb is None):
                    lacks = "less" if sa is None else "more"
                    v = lacks if v in ("same", lacks) else "mixed"
                out.append(v)
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(out, pa.string()), t.column(8)], names=["a", "b", "verdict", "same_group"])

    picked = full.select("a", "b", "parts_a", "kinds_a", "parts_b", "kinds_b", "state_a", "state_b", F.coalesce(F.col("grp_a") == F.col("grp_b"), F.lit(False)).alias("same_group"))
    return _widely(picked).mapInArrow(run, "a bigint, b bigint, verdict string, same_group boolean").where("verdict IS NOT NULL")


def _kept(step: DataFrame) -> DataFrame:
    """A step of an iteration as a written table: unlike a checkpoint it doesn't hand on the constraints the planner found before, which
    would grow from round to round."""
    return written(step, "name-step")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each connected component; labels travel along edges and are shortened until none changes."""
    both = _kept(edges.selectExpr("a", "b").unionByName(edges.selectExpr("b AS a", "a AS b")).distinct())
    now = _kept(nodes.select("node", F.col("node").alias("label")))
    while True:
        near = both.join(now, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        step = now.join(near, F.col("node") == F.col("a"), "left").select("node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("mid"))
        up = now.select(F.col("node").alias("mid"), F.col("label").alias("up"))
        new = _kept(step.join(up, "mid").select("node", "old", F.col("up").alias("label")))
        if new.where("old <> label").isEmpty():
            return new.select("node", "label")
        now = new.select("node", "label")


def merged(nodes: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(node, label): the persons. Names of the same detail are joined first. Then, in rounds, a class that lacks detail joins the one
    class it fits; if it fits several, the one of its own group, if that is one; otherwise it stays by itself, as it may be any of them.
    Classes that each lack something are looked at in the last round, and at the end the classes of a component are one person if
    every two of them fit each other."""
    labels = components(nodes, verdicts.where("verdict = 'same'"))
    ways = verdicts.where("verdict <> 'same'")
    forward = ways.where("verdict IN ('less', 'mixed')").selectExpr("a AS x", "b AS y", "same_group", "verdict = 'mixed' AS mixed")
    backward = ways.where("verdict IN ('more', 'mixed')").selectExpr("b AS x", "a AS y", "same_group", "verdict = 'mixed' AS mixed")
    ways = _kept(forward.unionByName(backward))
    for k in range(ROUNDS):
        last = k == ROUNDS - 1
        lab = lambda c, to: labels.select(F.col("node").alias(c), F.col("label").alias(to))
        moves = ways.where(F.lit(last) | ~F.col("mixed")).join(lab("x", "from"), "x").join(lab("y", "to"), "y").where(F.col("from") != F.col("to"))
        fits = moves.groupBy("from", "to").agg(F.max("same_group").alias("mine"))
        count = fits.groupBy("from").agg(
            F.count(F.lit(1)).alias("all"), F.count_if("mine").alias("own"), F.min("to").alias("any_to"), F.min(F.when(F.col("mine"), F.col("to"))).alias("own_to")
        )
        chosen = count.select(F.col("from").alias("a"), F.when(F.col("all") == 1, F.col("any_to")).when(F.col("own") == 1, F.col("own_to")).alias("b")).where("b IS NOT NULL")
        chosen = _kept(chosen)
        moved = lab("x", "from").join(chosen.select(F.col("a").alias("from")), "from", "left_semi").select("x")
        ways = _kept(ways.join(moved, "x", "left_anti"))  # who has joined a class is not to join a second one
        joined = components(labels.select(F.col("label").alias("node")).distinct(), chosen)
        new = labels.join(joined.select(F.col("node").alias("label"), F.col("label").alias("to")), "label").select("node", F.col("to").alias("label"))
        labels = _kept(new)
    lab = lambda c, to: labels.select(F.col("node").alias(c), F.col("label").alias(to))
    left = ways.join(lab("x", "from"), "x").join(lab("y", "to"), "y").where("`from` <> `to`")
    left = _kept(left.select(F.least("from", "to").alias("a"), F.greatest("from", "to").alias("b")).distinct())
    groups = _kept(components(left.select(F.col("a").alias("node")).union(left.select("b")).distinct(), left))
    size = groups.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    links = left.join(groups.withColumnRenamed("node", "a"), "a").groupBy("label").agg(F.count(F.lit(1)).alias("m"))
    whole = size.join(links, "label").where(F.col("m") * 2 == F.col("n") * (F.col("n") - 1)).select("label")
    turned = groups.join(whole, "label").select(F.col("node").alias("label"), F.col("label").alias("to"))
    return labels.join(turned, "label", "left").select("node", F.coalesce("to", "label").alias("label"))


def _met(places: DataFrame) -> DataFrame:
    """(a, b): the pairs of nodes with places within the radius. A common family name is split by given names; who has an initial only meets all of that initial,
    but these don't meet one another there."""
    group = F.when(F.col("kind").isin("o", "i"), "i").otherwise(F.col("kind"))
    places = places.withColumn("block", group)
    key = ["state", "initial", "block"]
    close = written(radius_pairs(places, key), "close-names")
    side = lambda s, n: places.select(*key, F.col("family").alias(f"family_{s}"), F.col("given").alias(f"given_{s}"), F.col("node").alias(n), F.col("kind").alias(f"kind_{n}"))
    one, two = side("a", "m"), side("b", "n")
    found = []
    for left, right in (("o", "o"), ("o", "i"), ("i", "o"), ("f", "f"), ("n", "n")):  # never i with i
        of = close.where(F.col("block") == ("i" if "o" in (left, right) else left))
        found.append(of.join(one.where(F.col("kind_m") == left), [*key, "family_a", "given_a"]).join(two.where(F.col("kind_n") == right), [*key, "family_b", "given_b"]).select("m", "n"))
    both = found[0]
    for f in found[1:]:
        both = both.unionByName(f)
    return both.where("m <> n").select(F.least("m", "n").alias("a"), F.greatest("m", "n").alias("b")).distinct()


def persons(rows: DataFrame, id: str = "id", name: str = "nome", state: str = "estado", group: str = "partido") -> DataFrame:
    """(id, person): the records with the number of the person they name.

    Distinct normalised names of one state are nodes. They meet by family and given name, in blocks of one state and first initial, in radius_pairs(); the
    nodes behind are judged in pairs and merged. A null state fits every state; a null or letterless name is left out, names nobody.
    Second deliveries of a row count once; an id with two names belongs to both persons.
    """
    read = read_names(rows, id, name, state, group)
    node = F.xxhash64("state", F.when(F.col("state").isNull(), F.col("grp")), F.array_join("parts", " "), "relative")
    read = written(read.withColumn("node", node), "names")
    nodes = read.groupBy("node").agg(*[F.first(c).alias(c) for c in ("state", "parts", "relative")], F.min("grp").alias("grp"))
    nodes = written(with_kinds(nodes), "name-nodes")
    keys = written(placed_keys(nodes), "name-keys")
    states = keys.where("state IS NOT NULL").select("state", "initial").distinct()
    place = ["initial", "kind", "family", "given"]
    nowhere = keys.where("state IS NULL").drop("state")
    spread = nowhere.join(states, "initial").select("node", "state", *place).unionByName(nowhere.withColumn("state", F.lit("")).select("node", "state", *place))
    spread = written(spread.unionByName(keys.where("state IS NOT NULL").select("node", "state", *place)), "name-places")
    pairs = written(_met(spread), "name-pairs")
    verdicts = written(judged_pairs(pairs, nodes), "name-verdicts")
    return read.select("id", "node").join(merged(nodes, verdicts), "node").select("id", F.col("label").alias("person")).distinct()


def person_pairs(people: DataFrame) -> DataFrame:
    """(id_a, id_b): every two records of one person, id_a the smaller."""
    right = people.select(F.col("id").alias("id_b"), "person")
    return people.select(F.col("id").alias("id_a"), "person").join(right, "person").where("id_a < id_b").select("id_a", "id_b").distinct()
