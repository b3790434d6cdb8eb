"""Text functions as column expressions: they stay in the JVM and in generated code."""

from __future__ import annotations

import unicodedata
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fold_table() -> tuple[str, str]:
    """Letters with an ASCII base of one character, up to Latin Extended-B and the additional Latin block, and that base."""
    pairs = []
    for code in [0xA0, *range(0xAA, 0xBB), *range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x200B), 0x202F]:
        base = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode().lower()
        if len(base) == 1:
            pairs.append((chr(code).lower() if len(chr(code).lower()) == 1 else chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_FROM, _TO = _fold_table()


def fold(c: Column) -> Column:
    """Lower case without accents; characters without an ASCII base are dropped. Null gives the empty string."""
    return F.regexp_replace(F.translate(F.lower(F.coalesce(c, F.lit(""))), _FROM, _TO), r"[^\x00-\x7F]", "")


def normalized(c: Column) -> Column:
    """fold() with white space collapsed and trimmed."""
    return F.trim(F.regexp_replace(fold(c), r"\s+", " "))


#: The most frequent named entities, looked for first.
_USUAL = ("nbsp", "amp", "lt", "gt", "quot", "apos", "ccedil", "atilde", "otilde", "aacute", "eacute", "iacute", "oacute", "uacute", "acirc", "ecirc", "ocirc", "agrave")
_NAMED = {n: html5[n + ";"] for n in _USUAL} | {n[:-1]: v for n, v in sorted(html5.items()) if n.endswith(";") and n[:-1] not in _USUAL}


def unescaped(c: Column) -> Column:
    """Named entities of HTML (closed by a semicolon) and numbers of characters as characters, each once; &nbsp; and its number as a blank.

    Entities that don't exist, and numbers of no character, stay as they are. The text is cut at its ampersands, so nothing is resolved twice.
    """
    pieces = F.split(c, "&")
    table = F.create_map(*[F.lit(x) for kv in _NAMED.items() for x in kv])

    def resolved(p: Column) -> Column:
        name = F.regexp_extract(p, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});", 1)
        code = F.when(name.rlike("^#[0-9]"), F.substring(name, 2, 8).cast("bigint")).when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 8), 16, 10).cast("bigint"))
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(32)), 8, "0")), "UTF-32"))
        value = F.when(name == "", F.lit(None).cast("string")).when(name.startswith("#"), char).otherwise(F.try_element_at(table, name))
        value = F.replace(value, F.lit("\xa0"), F.lit(" "))
        return F.when(value.isNull(), F.concat(F.lit("&"), p)).otherwise(F.concat(value, F.substring(p, F.length(name) + F.lit(2), F.length(p))))

    rest = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), resolved)
    return F.when(c.contains("&"), F.concat(F.element_at(pieces, 1), F.array_join(rest, ""))).otherwise(c)


def escaped(c: Column) -> Column:
    """The four characters that HTML reserves, as entities."""
    out = c
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(char), F.lit(name))
    return out


def plain_text(c: Column, most: int = 600) -> Column:
    """Markup as plain text of at most ``most`` characters: no tags, no entities, single blanks. Null gives the empty string."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"<[^>]+>", " ")
    return F.substring(F.trim(F.regexp_replace(unescaped(t), r"\s+", " ")), 1, most)


def canonical_url(c: Column) -> Column:
    """What identifies an address: lower case, without scheme, www., query, fragment and closing slashes."""
    t = F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), r"^https?://", "")
    t = F.substring_index(F.substring_index(F.regexp_replace(t, r"^www\.", ""), "#", 1), "?", 1)
    return F.regexp_replace(t, r"/+$", "")


def item_id(source: Column, url: Column, most: int = 110) -> Column:
    """Identifier of an item by its canonical address, prefixed by its source."""
    slug = F.regexp_replace(F.regexp_replace(canonical_url(url), r"[^a-zA-Z0-9]+", "_"), r"^_+|_+$", "")
    return F.concat(source, F.lit("_"), F.substring(slug, 1, most))


def slug(c: Column, most: int = 70) -> Column:
    """Words of a-z and 0-9 joined by dashes; accents fall off, all else parts words."""
    t = F.translate(F.lower(F.coalesce(c, F.lit(""))), _FROM, _TO)
    t = F.regexp_replace(F.regexp_replace(t, r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    return F.regexp_replace(F.substring(t, 1, most), r"-+$", "")


def shortened(c: Column, n: int) -> Column:
    """At most ``n`` characters, the last an ellipsis where text was left out."""
    return F.when(F.length(c) <= n, c).otherwise(F.concat(F.regexp_replace(F.substring(c, 1, n - 1), r"[ ,;:.]+$", ""), F.lit("…")))


def text_hash(*parts: Column) -> Column:
    """Hash of the normalised parts: 'sha1:' and 16 hexadecimal digits; a null part counts as empty."""
    joined = F.concat_ws(" | ", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit("sha1:"), F.substring(F.sha1(normalized(joined)), 1, 16))


def key_hash(prefix: str, *parts: Column) -> Column:
    """A stable key of the given parts: the prefix and 16 digits of their SHA-1."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 1, 16))


def endpoint_label(url: Column, parts: int = 3) -> Column:
    """The path of an address with numbers as {id}, cut after ``parts`` segments."""
    path = F.substring_index(F.regexp_replace(F.regexp_replace(url, r"^https?://[^/]*", ""), r"^/+|/+$", ""), "?", 1)
    named = F.transform(F.split(path, "/"), lambda s: F.when(s.rlike(r"^\d+$"), F.lit("{id}")).otherwise(s))
    return F.array_join(F.slice(named, 1, parts), "/")


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?i)^[a-z]+://([^/:?#]+)", 1))


def official(url: Column, domains: list[str]) -> Column:
    """https, and the host is one of the domains or below one."""
    h = host(url)
    inside = F.lit(False)
    for d in domains:
        inside = inside | (h == d) | h.endswith("." + d)
    return F.coalesce(F.lower(url).startswith("https://"), F.lit(False)) & inside


def search_key(*parts: Column) -> Column:
    """Non-empty parts in one lower-case string."""
    return F.lower(F.concat_ws(" ", *[F.nullif(p.cast("string"), F.lit("")) for p in parts]))


def absolute_url(base: str, link: Column) -> Column:
    """A link as an absolute address: itself, or below the base's root or folder."""
    root = "/".join(base.split("/")[:3])
    return F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(F.lit(base.split(":")[0] + ":"), link)).when(
        link.startswith("/"), F.concat(F.lit(root), link)
    ).otherwise(F.concat(F.lit(base.rsplit("/", 1)[0] + "/" if base.count("/") > 2 else root + "/"), link))


def thousands(c: Column, places: int = 0) -> Column:
    """A number with points between thousands and a comma before decimals."""
    return F.translate(F.format_number(c, places), ",.", ".,")
