"""XML as text: charset, markup that carries no values, and the shape of what stands around documents.

A file may be read whole or in pieces. Either way its text goes through the same expressions: ``plain`` takes comments and
the like out, ``outline`` leaves the tags around documents, and ``shape`` sums these up. Shapes of neighbouring pieces are merged
by ``joined``, in any grouping, so a file is judged alike however it was cut.
"""

from __future__ import annotations

import codecs
from collections.abc import Callable
from encodings.aliases import aliases
from functools import cache, reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- charset ----------------------------------------------------------------------------------

#: Bytes of a file's beginning that tell its charset.
HEAD_BYTES = 1024
#: Charsets of one byte per character, all of which hold ASCII. Others are UTF-8 and UTF-16.
SINGLE_BYTE = ["ascii", *(f"iso8859_{i}" for i in range(1, 17) if i != 12), *(f"cp{n}" for n in (437, 850, 852, 858, 866, *range(1250, 1259))),
               "koi8_r", "koi8_u", "mac_roman"]
#: All charsets that are told apart.
CHARSETS = ["UTF-8", "UTF-16LE", "UTF-16BE", *SINGLE_BYTE]
UTF8, UTF16 = ("UTF8", "U8"), ("UTF16", "UTF16LE", "UTF16BE", "U16")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once per row however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _key(name: str) -> str:
    return "".join(c for c in name.upper() if c.isalnum())


@cache
def _names(codec: str) -> tuple[str, ...]:
    """Spellings of a charset, without punctuation."""
    module = "latin_1" if codec == "iso8859_1" else codec
    return tuple(sorted({_key(codec), _key(codecs.lookup(codec).name), *(_key(a) for a, c in aliases.items() if c == module)}))


def _read_as(latin: Column, codec: str) -> Column:
    """Text of a single-byte charset from the same bytes read as Latin-1; NULL if it holds a byte without meaning."""
    told = [(chr(b), bytes([b]).decode(codec, "replace")) for b in range(128, 256)]
    text = F.translate(latin, "".join(a for a, c in told if c not in (a, "�")), "".join(c for a, c in told if c not in (a, "�")))
    lost = "".join(a for a, c in told if c == "�")
    return F.when(F.translate(latin, lost, "") == latin, text) if lost else text


#: Bytes of a long text that become one string of the JVM, at least; a text has at most 64 such chunks.
CHUNK_BYTES = 1 << 20


def _chunk_size(octets: Column) -> Column:
    """An even number of bytes."""
    return F.greatest(F.lit(CHUNK_BYTES), F.ceil(F.octet_length(octets) / 128).cast("int") * 2)


def _chunk_numbers(octets: Column) -> Column:
    return F.sequence(F.lit(0), F.floor(F.greatest(F.octet_length(octets) - 1, F.lit(0)) / _chunk_size(octets)).cast("int"))


#: One code unit that is no surrogate, or a pair of those, as bytes read as Latin-1.
_UNITS = {"UTF-16LE": r".[^\xD8-\xDF]|.[\xD8-\xDB].[\xDC-\xDF]", "UTF-16BE": r"[^\xD8-\xDF].|[\xD8-\xDB].[\xDC-\xDF]."}


def _read_as_utf16(content: Column, charset: str) -> Column:
    """Text of UTF-16 bytes; NULL unless they are whole units in which surrogates stand in pairs."""
    n = F.octet_length(content)
    # Only bytes that may hold surrogates are looked at unit by unit; all others can be read chunk by chunk.
    may = reduce(or_, (F.contains(content, F.lit(bytes([b]))) for b in range(0xD8, 0xE0)))
    paired = F.decode(content, "ISO-8859-1").rlike(rf"(?s)\A(?:{_UNITS[charset]})*+\z")
    size = _chunk_size(content)
    chunks = F.transform(_chunk_numbers(content), lambda k: F.decode(F.substring(content, k * size + 1, size), charset))
    text = F.when(~may, F.array_join(chunks, "")).when(paired, F.decode(content, charset))
    return F.when((n % 2 == 0) & (n > 0), text)


def charset(head: Column) -> Column:
    """Charset of a file by its first bytes: byte order mark, else what the prolog names, else UTF-8. NULL where that is unknown or
    cannot be, as UTF-16 named in single bytes."""
    said = F.regexp_extract(F.replace(F.decode(head, "ISO-8859-1"), F.char(F.lit(0)), F.lit("")), r"<\?xml[^>]*?\sencoding\s*=\s*[\"']([A-Za-z][A-Za-z0-9._-]*)", 1)
    first = F.hex(F.substring(head, 1, 2))
    wide = F.when(first.isin("FFFE", "3C00"), "UTF-16LE").when(first.isin("FEFF", "003C"), "UTF-16BE")

    def named(key: Column) -> Column:
        one = F.when((key == "") | key.isin(*UTF8), "UTF-8")
        for codec in SINGLE_BYTE:
            one = one.when(key.isin(*_names(codec)), codec)
        return F.when(wide.isNull(), one).when((key == "") | key.isin(*UTF16), wide)

    return _let(F.regexp_replace(F.upper(said), "[^A-Z0-9]", ""), named)


def may_name_charset(octets: Column) -> Column:
    """False where ``charset`` finds neither a mark nor a name, so that a file's first bytes need not be kept."""
    return F.contains(octets, F.lit(b"<?xml")) | F.hex(F.substring(octets, 1, 2)).isin("FFFE", "3C00", "FEFF", "003C") | F.contains(octets, F.lit(b"\x00"))


def decoded_as(content: Column, name: Column) -> Column:
    """Bytes as text by the charset named; NULL where the bytes do not fit it. A byte order mark is left out."""
    latin = F.decode(content, "ISO-8859-1")
    text = F.when(name == "UTF-8", F.try_validate_utf8(content.cast("string")))
    for wide in ("UTF-16LE", "UTF-16BE"):
        text = text.when(name == wide, _read_as_utf16(content, wide))
    for codec in SINGLE_BYTE:
        text = text.when(name == codec, _read_as(F.regexp_replace(latin, "^ï»¿", ""), codec))
    return _let(text, lambda t: F.when(t.startswith("﻿"), F.substring(t, 2, 1 << 30)).otherwise(t))


def decoded(content: Column) -> Column:
    """A whole file as text."""
    return _let(content, lambda octets: _let(charset(F.substring(octets, 1, HEAD_BYTES)), lambda name: decoded_as(octets, name)))


# ---- text without comments, sections and declarations -------------------------------------------

#: Markup in which tags may stand that are none. A section's text stays.
_ASIDE = r"(?s)(<!\[CDATA\[.*?\]\]>)|<!--(?:(?!--).)*+-->|<\?(?!(?i:xml)[\s?])[^\s<>?]+(?:\s.*?)?\?>"
_DOCTYPE = r"(?s)^\s*<!DOCTYPE\s[^\[<>]*+(?:\[.*?\]\s*)?>"
_ENTITY = r"<!ENTITY\s+([\w.:-]+)\s+(?:\"([^\"]*)\"|'([^']*)')\s*>"
_PROLOG = r"^<\?xml\s[^<>]*\?>\z"


def stands_alone(text: Column) -> Column:
    """Whether a piece of a file, taken for itself, begins and ends no aside in its middle and declares nothing."""
    rest = F.regexp_replace(F.regexp_replace(text, r"^(?:\x{FEFF})?<\?xml\s[^<>]*\?>", ""), _ASIDE, "")
    marked = F.contains(text, F.lit("<!")) | F.contains(text, F.lit("<?"))
    # A branch, as both sides of an OR would be computed.
    return F.when(marked, ~(F.contains(rest, F.lit("<!")) | F.contains(rest, F.lit("<?")))).otherwise(True)


def _escaped_sections(text: Column) -> Column:
    """CDATA sections as escaped text."""
    def section(part: Column) -> Column:
        inside = F.substring_index(part, "]]>", 1)
        safe = F.replace(F.replace(F.replace(inside, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        return F.when(F.contains(part, F.lit("]]>")), F.concat(safe, F.substr(part, F.length(inside) + 4))).otherwise(F.concat(F.lit("<!"), part))

    parts = F.split(text, r"<!\[CDATA\[")
    escaped = F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), section), ""))
    return F.when(F.contains(text, F.lit("<![CDATA[")), escaped).otherwise(text)


def _expanded(text: Column) -> Column:
    """Text with the entities that its document type declares; one may name others, one level deep."""
    def told(declared: Column) -> Column:
        each = F.arrays_zip(*(F.regexp_extract_all(declared, F.lit(_ENTITY), F.lit(i)).alias(f"g{i}") for i in (1, 2, 3)))
        body = F.substr(text, F.length(declared) + 1)
        for _ in range(2):
            body = F.aggregate(each, body, lambda t, e: F.replace(t, F.concat(F.lit("&"), e["g1"], F.lit(";")), F.concat(e["g2"], e["g3"])))
        return body

    def known(declared: Column) -> Column:
        return _let(declared, lambda d: F.when(d == "", text).otherwise(told(d)))

    def found(head: Column) -> Column:
        # Looked for in all the text if it is longer than its beginning tells.
        return F.when(~F.contains(head, F.lit("<!DOCTYPE")), F.lit("")).otherwise(_let(F.regexp_extract(head, _DOCTYPE, 0), lambda d: F.when(
            (d != "") | (F.length(head) < CHUNK_BYTES), d).otherwise(F.regexp_extract(text, _DOCTYPE, 0))))

    return known(_let(F.substring(text, 1, CHUNK_BYTES), found))


def _without_asides(text: Column) -> Column:
    """Text without asides; only what lies between the first mark that may begin one and the last that may end one becomes a string of the JVM."""
    def cut(octets: Column, n: Column) -> Column:
        before = F.least(*(F.octet_length(F.substring_index(text, mark, 1)) for mark in ("<!", "<?")))
        after = F.least(*(F.octet_length(F.substring_index(text, mark, -1)) for mark in ("-->", "?>", "]]>")))

        def joined(at: Column) -> Column:
            inside = F.substring(octets, at["before"] + 1, n - at["before"] - at["after"]).cast("string")
            bare = F.concat(F.substring(octets, F.lit(1), at["before"]), F.regexp_replace(inside, _ASIDE, "$1").cast("binary"), F.substring(octets, n - at["after"] + 1, at["after"]))
            return F.when(at["before"] + at["after"] < n, bare.cast("string")).otherwise(text)

        return _let(F.struct(before.alias("before"), after.alias("after")), joined)

    return cut(text.cast("binary"), F.octet_length(text))


def plain(text: Column) -> Column:
    """Text of a file, or of a piece that stands alone, as tags and values only.

    Markup that is left open, or stands where it may not, stays and makes the shape unsound. The usual file has none, and is
    searched once.
    """
    def cleared(body: Column) -> Column:
        bare = _let(_without_asides(body), lambda t: _let(_expanded(t), _escaped_sections))
        return F.when(F.contains(body, F.lit("<!")) | F.contains(body, F.lit("<?")), bare).otherwise(body)

    def headed(body: Column) -> Column:
        prolog = F.concat(F.substring_index(body, "?>", 1), F.lit("?>"))
        return _let(prolog, lambda p: F.when(p.rlike(_PROLOG), F.substr(body, F.length(p) + 1)).otherwise(body))

    return _let(text, lambda t: _let(F.when(t.startswith("<?xml"), headed(t)).otherwise(t), cleared))


# ---- documents and the tags around them ---------------------------------------------------------

_QUOTED = r"(?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+"
_DOCUMENT = rf"(?s)<((?:[\w.-]+:)?)Documento(?:\s{_QUOTED})?(?<!/)>.*?</\1Documento\s*>"
#: What a piece holds if its document's opening tag ended the piece before.
_HEADLESS = r"(?s)^(.*?)</((?:[\w.-]+:)?)Documento\s*>"
_LEFT = "<Documento/>"


def fragments(text: Column) -> Column:
    """All documents of a plain text, at any depth, in order."""
    return F.regexp_extract_all(text, F.lit(_DOCUMENT), F.lit(0))


def outline(text: Column) -> Column:
    """A plain text with an empty element for each document."""
    return F.regexp_replace(text, _DOCUMENT, _LEFT)


def parted(text: Column) -> Column:
    """Struct of ``texts``, the documents, and ``rest``, the outline. The usual text, of one document, is cut by plain search."""
    first, last = F.instr(text, F.lit("<Documento")), F.instr(text, F.lit("</Documento>"))
    named = F.length(text) - F.length(F.replace(text, F.lit("Documento"), F.lit("")))
    one = (named == 18) & (first > 0) & (last > first)
    whole = F.struct(fragments(text).alias("texts"), outline(text).alias("rest"))
    cut = F.struct(F.array(F.substr(text, first, last - first + 12)).alias("texts"),
                   F.concat(F.substr(text, F.lit(1), first - 1), F.lit(_LEFT), F.substr(text, last + 12)).alias("rest"))
    # Without a second tag of the name there is none.
    none = F.struct(F.array().cast("array<string>").alias("texts"), text.alias("rest"))
    # An empty element, or another whose name begins alike, is left to the patterns.
    opened = F.substring_index(F.substr(text, first), ">", 1)
    return F.when(named < 18, none).when(F.when(one, opened.rlike(r"^<Documento(?:\s[^<]*)?$") & ~opened.endswith("/")).otherwise(False), cut).otherwise(whole)


_END = r"</((?:[\w.-]+:)?)Documento>"
#: A piece of a text: as far as a document's end, or what is left.
_PIECE = rf"(?s).*?{_END}|.+"


def stretches(text: Column) -> Column:
    """A plain text in up to 65 parts, in order; all but the last end at a document's end. Long texts are never one string of the JVM."""
    def cut(octets: Column) -> Column:
        n, chunk = F.octet_length(octets), _chunk_size(octets)
        # The first document's end tag. The search is for bytes, so a character that a chunk divides does no harm.
        end = F.concat(F.lit("</"), F.regexp_extract(F.substring(octets, 1, CHUNK_BYTES).cast("string"), _END, 1), F.lit("Documento>"))

        def last_end(tag: Column) -> Column:
            def of(k: Column) -> Column:
                return _let(F.substring(octets, k * chunk + 1, chunk).cast("string"), lambda c: F.when(
                    F.contains(c, tag), F.least(n, (k + 1) * chunk) - F.octet_length(F.call_function("substring_index", c, tag, F.lit(-1)))))

            return F.concat(F.array(F.lit(0)), F.filter(F.transform(_chunk_numbers(octets), of), lambda at: at.isNotNull()), F.array(n))

        def parts(ends: Column) -> Column:
            return F.transform(F.sequence(F.lit(0), F.size(ends) - 2), lambda i: F.substring(octets, F.get(ends, i) + 1, F.get(ends, i + 1) - F.get(ends, i)).cast("string"))

        return _let(_let(end, last_end), parts)

    return _let(text.cast("binary"), cut)


def pieces(text: Column) -> Column:
    """A plain text as pieces, each as far as a document's end, but for what is left after the last."""
    return F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0))


def headless(rest: Column) -> Column:
    """The document whose end an outline begins with, its opening tag restored; NULL if there is none."""
    body = F.regexp_extract(rest, _HEADLESS, 1)
    closes = rest.rlike(_HEADLESS) & ~F.contains(body, F.lit("Documento"))
    return F.when(closes, F.concat(F.lit("<Documento>"), body, F.lit("</Documento>")))


def without_headless(rest: Column) -> Column:
    return F.regexp_replace(rest, _HEADLESS, "</$2Documento>")


# ---- shape ------------------------------------------------------------------------------------

#: Elements closed that were opened before, elements left open, complete elements after the last of the closed ones, whether there
#: are tags, and text before the first and after the last; ``ok`` is false for whatever is no XML in itself.
SHAPE = "struct<close:array<string>,open:array<string>,full:int,tags:boolean,lead:boolean,tail:boolean,ok:boolean>"

_NAME = r"[^\s<>/=\"'!?&]+"
_ATTRIBUTES = r"(?:\s+[^\s<>/=\"'&]+\s*=\s*(?:\"[^\"<]*\"|'[^'<]*'))*+"
_TAG = rf"<(?:/({_NAME})|({_NAME}){_ATTRIBUTES})\s*(/?)>"
_TWICE = r"<[^<>]*\s([^\s=<>\"']+)\s*=\s*(?:\"[^\"]*\"|'[^']*')[^<>]*\s\1\s*="
_WRONG = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);)|\]\]>|[\x00-\x08\x0B\x0C\x0E-\x1F￾￿]|</[^<>]*/>"


def _names_of(*cells: Column) -> Column:
    return F.array(*cells).cast("array<string>")


def shape(rest: Column) -> Column:
    """Shape of an outline."""
    return _let(rest, _shape)


def _shape(rest: Column) -> Column:
    each = F.arrays_zip(*(F.regexp_extract_all(rest, F.lit(_TAG), F.lit(i)).alias(n) for i, n in ((1, "closing"), (2, "opening"), (3, "empty"))))
    start = F.struct(_names_of().alias("close"), _names_of().alias("open"), F.lit(0).alias("full"), F.lit(True).alias("ok"))

    def step(s: Column, t: Column) -> Column:
        depth, full = F.size(s["open"]), s["full"]
        opened = F.struct(s["close"].alias("close"), F.concat(s["open"], F.array(t["opening"])).alias("open"), full.alias("full"), s["ok"].alias("ok"))
        alone = F.struct(s["close"].alias("close"), s["open"].alias("open"), (full + (depth == 0).cast("int")).alias("full"), s["ok"].alias("ok"))
        shut = F.struct(s["close"].alias("close"), F.slice(s["open"], F.lit(1), F.greatest(depth - 1, F.lit(0))).alias("open"), (full + (depth == 1).cast("int")).alias("full"),
                        (s["ok"] & (F.element_at(s["open"], -1) == t["closing"])).alias("ok"))
        before = F.struct(F.concat(s["close"], F.array(t["closing"])).alias("close"), s["open"].alias("open"), F.lit(0).alias("full"), s["ok"].alias("ok"))
        return F.when(t["closing"] != "", F.when(depth > 0, shut).otherwise(before)).when(t["empty"] != "", alone).otherwise(opened)

    said = lambda part: F.trim(part, F.lit(" \t\r\n")) != ""
    folded = F.aggregate(each, start, step)
    def whole(between: Column) -> Column:
        clean = ~rest.rlike(_WRONG) & ~rest.rlike(_TWICE) & ~F.exists(between, lambda p: F.contains(p, F.lit("<")))
        return _let(folded, lambda s: F.struct(s["close"].alias("close"), s["open"].alias("open"), s["full"].alias("full"), (F.size(between) > 1).alias("tags"),
                                               said(F.get(between, F.lit(0))).alias("lead"), said(F.element_at(between, -1)).alias("tail"), (s["ok"] & clean).alias("ok"))).cast(SHAPE)

    return _let(F.split(F.regexp_replace(rest, _TAG, "\u0001"), "\u0001"), whole)


def empty_shape() -> Column:
    return F.struct(_names_of(), _names_of(), F.lit(0), F.lit(False), F.lit(False), F.lit(False), F.lit(True)).cast(SHAPE)


def shape_of(close: Column, open: Column) -> Column:
    """Shape of elements closed, then at least one left open, a document last."""
    return F.struct(close, open, F.lit(0), F.lit(True), F.lit(False), F.lit(False), F.lit(True)).cast(SHAPE)


def joined(a: Column, b: Column) -> Column:
    """Shape of two neighbours together; associative."""
    n, m = F.size(a["open"]), F.size(b["close"])
    k = F.least(n, m)
    match = F.slice(F.reverse(a["open"]), F.lit(1), k) == F.slice(b["close"], F.lit(1), k)
    full = (F.when(m > n, b["full"]).when((m == n) & (m > 0), a["full"] + 1 + b["full"]).when(n == 0, a["full"] + b["full"]).otherwise(a["full"]))
    return F.struct(
        F.concat(a["close"], F.slice(b["close"], k + 1, F.greatest(m - k, F.lit(0)))), F.concat(F.slice(a["open"], F.lit(1), n - k), b["open"]), full,
        a["tags"] | b["tags"], F.when(a["tags"], a["lead"]).otherwise(a["lead"] | b["lead"]), F.when(b["tags"], b["tail"]).otherwise(a["tail"] | b["tail"]),
        a["ok"] & b["ok"] & match).cast(SHAPE)


def all_joined(pieces: Column) -> Column:
    """Shape of an array of structs with a field ``shape``, in order."""
    return F.aggregate(pieces, empty_shape(), lambda s, p: joined(s, p["shape"]))


_ONE = r"(?:\s+[^\s<>/=\"'&]+\s*=\s*\"[^\"<&]*+\")?\s*"
#: One document in up to three elements of at most one attribute each.
_USUAL = (rf"^\s*(?:<Documento/>|<({_NAME}){_ONE}>\s*(?:<Documento/>|<({_NAME}){_ONE}>\s*(?:<Documento/>|<({_NAME}){_ONE}>\s*<Documento/>\s*</\3\s*>)"
          rf"\s*</\2\s*>)\s*</\1\s*>)\s*$")


def whole_is_sound(rest: Column) -> Column:
    """Whether a file of this outline is well-formed around its documents. The usual outline is told by one pattern, a cut one by counts."""
    return F.when(rest.rlike(_USUAL), True).when(_uneven(rest), False).otherwise(_let(shape(rest), sound))


def _uneven(rest: Column) -> Column:
    """True of outlines whose tags cannot be in pairs, by their numbers.

    Where an outline is sound every ``<`` begins a tag and every closing tag has its opening one; the others are empty, and no more
    than there are ``/>``.
    """
    def times(mark: str) -> Column:
        return ((F.length(rest) - F.length(F.replace(rest, F.lit(mark), F.lit("")))) / len(mark)).cast("int")

    alone = times("<") - 2 * times("</")
    return (alone < 0) | (alone > times("/>"))


def sound(s: Column) -> Column:
    """Whether a file of this shape is well-formed around its documents: one root, all tags closed, nothing beside it."""
    return s["ok"] & (F.size(s["close"]) == 0) & (F.size(s["open"]) == 0) & (s["full"] == 1) & ~s["lead"] & ~s["tail"]
