"""Documents of the usual form, told and taken apart by one pattern each.

The usual form: plain elements in the order of the schema, all of one prefix or none, no attribute but one of the document, no character
references, no white space but blanks in values, at most two codes a line. A pattern that matches proves such a text well-formed and gives its values; whatever it does
not match goes to the XML parser, so the patterns decide about time alone. Values are as written, and empty where there is no element: the projections,
which trim and take empty for absent, tell them no more apart than the parser's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Between values, and before each line. Neither may stand in XML.
_FIELD, _LINE_MARK = "\x01", "\x02"


def _one_of(chars: str) -> str:
    """A class of single characters below U+0100, which a pattern looks up in a table; ranges it would try one by one."""
    return "[" + "".join(c if c.isalnum() else "\\" + c if c.isascii() else c for c in chars) + "]"


_WORD = _one_of("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
_COLON_WORD = _WORD[:-1] + ":]"
_GAP = r"(?:[ \t\r\n]++|<!--(?:(?!--).)*+-->)*+"
#: Wider characters are left to the parser, as are those that it might trim.
_VALUE = _one_of("".join(chr(i) for i in (*range(0x20, 0x7F), *range(0xA1, 0x100)) if i != 0xAD and chr(i) not in "<>&")) + "*+"
_ATTRIBUTE = r"(?:[ ]+{}[ ]*=[ ]*\"" + _VALUE.replace(r"\"", "") + r"\")?+[ ]*"
#: Names of elements around documents, and the prefix of a document's elements.
_NAME = rf"(?!(?:{_WORD}{{1,60}}+:)?(?i:Documento))[A-Za-z_]{_COLON_WORD}{{0,60}}+"
_PREFIX, _SAME = rf"(?<px>(?:[A-Za-z_]{_WORD}{{0,60}}+:)?+)", r"\k<px>"

#: Fields of a document's header, by group.
HEAD_FIELDS = {
    "IdDoc": ["TipoDTE", "Folio", "FchEmis", "FechaEmision"], "Emisor": ["RUTEmisor", "RznSoc", "RznSocEmisor"],
    "Receptor": ["RUTRecep", "RznSocRecep", "RznSoc"], "Totales": ["MntNeto", "IVA", "MntTotal"],
}
_LINE_FIELDS = ["NmbItem", "DscItem", "QtyItem", "PrcItem", "MontoItem"]
_CODE_FIELDS = ["TpoCodigo", "VlrCodigo"]


def _leaves(tag: str, fields: list[str], barred: list[str]) -> str:
    """Any leaves in any order; the last of each of ``fields`` is kept, as the parser does. The parser does not tell letters' case apart."""
    known = "|".join(f"<{_SAME}{f}>(?<{tag}{f}>{_VALUE})</{_SAME}{f}>" for f in fields)
    other = rf"<{_SAME}(?!(?i:{'|'.join([*fields, *barred])})>)(?<{tag}other>(?!(?i:Documento))[A-Za-z]{_WORD}{{0,60}}+)>{_VALUE}</{_SAME}\k<{tag}other>>"
    return rf"(?:(?:{'|'.join(p for p in (known, other) if p)}){_GAP})*+"


def _code(tag: str) -> str:
    return rf"(?:<{_SAME}(?<{tag}>C)dgItem>{_GAP}{_leaves(tag, _CODE_FIELDS, [])}</{_SAME}CdgItem>{_GAP})?+"


_HEAD = rf"(?:<{_SAME}(?<enc>E)ncabezado>{_GAP}(?=<{_SAME}(?:{'|'.join(HEAD_FIELDS)})>)" + "".join(
    rf"(?:<{_SAME}{g}>{_GAP}{_leaves(g, fields, [])}</{_SAME}{g}>{_GAP})?+" for g, fields in HEAD_FIELDS.items()) + rf"</{_SAME}Encabezado>{_GAP})?+"
_DOCUMENT = (rf"<{_PREFIX}Documento{_ATTRIBUTE.replace('{}', '(?:ID|Id|id|_ID|xmlns(?::[A-Za-z_][A-Za-z0-9_.-]*+)?)')}>{_GAP}{_HEAD}(?<lines>(?:<{_SAME}Detalle>.*?</{_SAME}Detalle>{_GAP})*+)"
             rf"{_leaves('doc', [], ['Encabezado', 'Detalle'])}</{_SAME}Documento[ ]*>")
_LINE = (rf"(?s)<{_PREFIX}Detalle>{_GAP}(?:<{_SAME}NroLinDet>(?<nro>{_VALUE})</{_SAME}NroLinDet>{_GAP})?+{_code('one')}{_code('two')}"
         rf"{_leaves('l', _LINE_FIELDS, ['NroLinDet', 'CdgItem'])}</{_SAME}Detalle>{_GAP}")

_DEPTH = range(1, 4)
_OPENED = _ATTRIBUTE.replace('{}', rf"[A-Za-z_]{_COLON_WORD}{{0,60}}+")
#: A text that is one document.
DOCUMENT = rf"(?s)^{_DOCUMENT}\z"
#: A file of one document in at most three elements. An empty group beside each opened one tells which have to be closed.
FILE = (r"(?s)^(?:<\?xml\s[^<>]*\?>)?+" + "".join(rf"{_GAP}(?:<(?<o{i}>{_NAME}){_OPENED}>(?<was{i}>)" for i in _DEPTH) + ")?+" * 3
        + _GAP + _DOCUMENT + "".join(rf"{_GAP}(?:</\k<o{i}>[ ]*>|(?!\k<was{i}>))" for i in reversed(_DEPTH)) + rf"{_GAP}\z")
#: A piece of a file: at most three elements closed, one to three opened, a document.
PIECE = (rf"(?s)^{_GAP}" + "".join(rf"(?:</(?<c{i}>{_NAME})[ ]*>{_GAP})?+" for i in _DEPTH)
         + "".join(rf"(?:<(?<o{i}>{_NAME}){_OPENED}>{_GAP}){'' if i == 1 else '?+'}" for i in _DEPTH) + rf"{_DOCUMENT}\z")

_HEAD_PLACES = [(g, f) for g, fields in HEAD_FIELDS.items() for f in fields]
_TOLD = "".join(f"{_FIELD}${{{n}}}" for n in ("enc", *(g + f for g, f in _HEAD_PLACES), "lines"))
_AROUND = [f"{side}{i}" for side in "co" for i in _DEPTH]
_LINE_PLACES = ["nro", *(t + f for t in ("one", "two") for f in ("", *_CODE_FIELDS)), *("l" + f for f in _LINE_FIELDS)]
_LINE_TOLD = _LINE_MARK + "".join(f"${{{n}}}{_FIELD}" for n in _LINE_PLACES)
_LINES_AT = len(_HEAD_PLACES) + 2

#: Columns that ``told`` adds.
TOLD = ["_head", "_lines"]


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with a column that is computed once, however often it is read."""
    return rows.select(*[c for c in rows.columns if c != name], F.explode(F.array(value)).alias(name))


def told(rows: DataFrame, pattern: str, text: str = "text") -> DataFrame:
    """``rows`` with what the pattern tells of their text, the values of the header and the lines; both NULL if the form is not the usual one."""
    values = _TOLD + ("".join(f"{_FIELD}${{{n}}}" for n in _AROUND) if pattern == PIECE else "")
    # Begins with the mark where the pattern matched, and the text, which may not hold it, does not.
    found = once(rows, "_found", F.regexp_replace(text, pattern, values))
    found = once(found, "_head", F.when(F.col("_found").startswith(_FIELD) & ~F.col(text).startswith(_FIELD), F.split("_found", _FIELD))).drop("_found")
    lines = once(found, "_lines", F.regexp_replace(F.get("_head", F.lit(_LINES_AT)), _LINE, _LINE_TOLD))
    plain = ~F.contains("_lines", F.lit("<"))
    return lines.withColumns({"_head": F.when(plain, F.col("_head")), "_lines": F.when(plain, F.col("_lines"))})


def _value(values: Column, i: int) -> Column:
    return F.get(values, F.lit(i))


def header() -> Column:
    """The header of a usual document."""
    place = {p: i + 2 for i, p in enumerate(_HEAD_PLACES)}
    groups = [F.struct(*[_value(F.col("_head"), place[g, f]).alias(f) for f in fields]).alias(g) for g, fields in HEAD_FIELDS.items()]
    return F.when(F.get("_head", F.lit(1)) != "", F.struct(*groups))


def lines() -> Column:
    """The lines of a usual document; NULL if it has none."""
    at = {n: i for i, n in enumerate(_LINE_PLACES)}

    def line(v: Column) -> Column:
        def code(tag: str) -> Column:
            return F.struct(F.lit(None).cast("string").alias("_VALUE"), *[_value(v, at[tag + f]).alias(f) for f in _CODE_FIELDS])

        codes = F.when(F.get(v, F.lit(at["two"])) != "", F.array(code("one"), code("two"))).when(F.get(v, F.lit(at["one"])) != "", F.array(code("one")))
        names = [*_LINE_FIELDS[:2], "CdgItem", *_LINE_FIELDS[2:]]
        return F.struct(_value(v, at["nro"]).alias("NroLinDet"), *[codes.alias(n) if n == "CdgItem" else _value(v, at["l" + n]).alias(n) for n in names])

    # The first part is what stands before the first line: nothing.
    parts = F.split(F.substring("_lines", 2, 1 << 30), _LINE_MARK)
    return F.when(F.col("_lines") != "", F.transform(F.transform(parts, lambda p: F.split(p, _FIELD)), line))


def around(side: str) -> Column:
    """Names of the elements that a usual piece closes (``c``) or opens (``o``) before its document, in order."""
    first = _LINES_AT + 1 + _AROUND.index(f"{side}1")
    return F.array_remove(F.slice("_head", first + 1, len(_DEPTH)), "")
