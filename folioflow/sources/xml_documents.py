"""XML tax documents: discovery, parsing, well-formedness, XSD validation.

One scan for files of any size. Files up to ``WHOLE_FILE_BYTES`` are one row; larger ones are read as splittable text cut at the
closing document tag, so that many tasks share one file and none holds it whole. Either way the text goes through the expressions of
``xml_text``: each document is parsed by itself, and the tags around documents are summed up in a shape, which decides over the file
once the shapes of its pieces are joined. Charset and declarations are read from the file's beginning. A large file is
read whole only if a comment, section or declaration in it hides a place where it would be cut, or if it has none, as one in UTF-16.
The text of a file read whole that exceeds ``CUT_BYTES`` is cut at its documents by the task that holds it, so beside
that text a task has its pieces, not the trees, arrays and shapes of all its documents.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, Row, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.scalars import fill_price, fill_quantity, iso_day, number, present, whole
from folioflow.session import bounded
from folioflow.sources import xml_text, xml_usual
from folioflow.sources.xml_text import decoded

XML_NAMES = "*.[xX][mM][lL]"
WHOLE_FILE_BYTES = 32 * 1024 * 1024
#: Files up to this size that are read whole are judged as one text; larger ones are cut at their documents.
CUT_BYTES = 1024 * 1024
#: A large file that holds a longer piece is read whole, unless it is larger than the second figure.
PIECE_BYTES, READ_WHOLE_BYTES = WHOLE_FILE_BYTES, 1024 * 1024 * 1024
#: Longer files that are read whole are read by fewer tasks at a time.
LONG_BYTES = 64 * 1024 * 1024
#: Shapes of neighbouring pieces that are joined at a time.
SHAPES = 1024

HEADER_XML = (
    "struct<IdDoc:struct<TipoDTE:string,Folio:string,FchEmis:string,FechaEmision:string>,"
    "Emisor:struct<RUTEmisor:string,RznSoc:string,RznSocEmisor:string>,"
    "Receptor:struct<RUTRecep:string,RznSocRecep:string,RznSoc:string>,"
    "Totales:struct<MntNeto:string,IVA:string,MntTotal:string>>"
)
LINES_XML = (
    "array<struct<NroLinDet:string,NmbItem:string,DscItem:string,"
    "CdgItem:array<struct<_VALUE:string,TpoCodigo:string,VlrCodigo:string>>,"
    "QtyItem:string,PrcItem:string,MontoItem:string>>"
)
#: A document's lines as they are staged: the struct of ``line_projection``.
STAGED_LINES = ("array<struct<nro_linea:int,tipo_codigo:string,nombre_item:string,codigo:string,descripcion:string,cantidad:decimal(18,6),"
                "precio_unitario:decimal(18,6),monto_item:decimal(18,2)>>")
FRAGMENT_XML = f"Encabezado {HEADER_XML}, Detalle {LINES_XML}, _corrupt_record string"
PARSER = {"mode": "PERMISSIVE", "ignoreNamespace": "true", "columnNameOfCorruptRecord": "_corrupt_record"}

# An XSD is picked by the schema name near the start of the file.
XSD_KINDS = {"boleta": "EnvioBOLETA_v11.xsd", "dte": "EnvioDTE_v10.xsd"}
XSD_HEAD = 4096


# ---- discovery --------------------------------------------------------------------------------

Paths = str | list[str]


def _xml_reader(spark: SparkSession, modified_after: str | None, names: str = XML_NAMES) -> DataFrameReader:
    reader = spark.read.option("pathGlobFilter", names).option("recursiveFileLookup", "true")
    return reader.option("modifiedAfter", modified_after) if modified_after else reader


def xml_files(spark: SparkSession, path: Paths, *, max_bytes: int | None = WHOLE_FILE_BYTES,
              modified_after: str | None = None, names: str = XML_NAMES) -> DataFrame:
    """(file, content) of the XML files below ``path``; larger files are left unread."""
    files = _xml_reader(spark, modified_after, names).format("binaryFile").load(path)
    if max_bytes is not None:
        files = files.filter(F.col("length") <= max_bytes)
    return files.select(F.col("_metadata.file_path").alias("file"), "content")


def listed_files(spark: SparkSession, path: Paths, modified_after: str | None = None) -> DataFrame:
    """(file, path): the name as documents carry it, and the path to read it by. Contents are not read."""
    return _xml_reader(spark, modified_after).format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file"), "path")


def sized_files(spark: SparkSession, path: Paths, modified_after: str | None = None, names: str = XML_NAMES) -> DataFrame:
    """(file, path, length), from the listing alone."""
    return _xml_reader(spark, modified_after, names).format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), "path", "length")


def literal_path(path: str) -> str:
    """A path for a reader that would take brackets and stars for patterns."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def file_name(file: Column) -> Column:
    return F.element_at(F.split(file, "/"), -1)


def unseen(files: DataFrame, registry: DataFrame, *, retry_failed: bool = False) -> DataFrame:
    """Files whose path the registry (file_id, status) does not hold. Failed files come back on request only."""
    known = registry.filter(F.col("status") != "FAILED") if retry_failed else registry
    return files.join(known.select(F.col("file_id").alias("_seen")), F.col("file") == F.col("_seen"), "left_anti")


# ---- parsing ----------------------------------------------------------------------------------

#: Where large files are cut. The text before tells whether the tag is a document's.
CUT = "Documento>"
_CUT_TAG = r"^/?(?:[\w.-]+:)?$"


def _documents(texts: DataFrame) -> DataFrame:
    """(file, block, row, texts, malformed, shape, values told) -> (file, position, malformed, shape, doc): one row per document, one where there is none.

    ``malformed`` is true for what cannot be read at all. The shape stands on the first of a piece's rows. Where the values of a piece have been
    told, it is one usual document and ``texts`` is NULL. Other texts are held against the usual document by themselves, then parsed. The
    result leaves a generator, so later filters cannot make the parser run twice.
    """
    each = texts.select("file", "block", "row", "malformed", "shape", *[F.col(c).alias(f"{c}_before") for c in xml_usual.TOLD], F.posexplode_outer("texts").alias("at", "text"))
    each = xml_usual.told(each, xml_usual.DOCUMENT).withColumns({c: F.coalesce(f"{c}_before", c) for c in xml_usual.TOLD})
    # The header is built by itself, under code generation; lines and the parser's results are not.
    each, usual = xml_usual.once(each, "_header", xml_usual.header()), F.col("_head").isNotNull()
    parsed = F.from_xml("text", FRAGMENT_XML, PARSER)

    def outcome(xml: Column) -> Column:
        there = F.col("text").isNotNull()
        bad = there & xml.getField("_corrupt_record").isNotNull()
        doc = F.struct(xml.getField("Encabezado").alias("Encabezado"), xml.getField("Detalle").alias("Detalle"))
        return F.struct((F.col("malformed") | bad).alias("malformed"), F.when(there & ~bad, doc).alias("doc"))

    read = F.struct(F.col("malformed"), F.struct(F.col("_header").alias("Encabezado"), xml_usual.lines().alias("Detalle")).alias("doc"))
    first = F.coalesce(F.col("at"), F.lit(0)) == 0
    rows = each.select("file", F.struct("block", "row", F.coalesce("at", F.lit(0)).cast("bigint").alias("at")).alias("position"), F.when(first, F.col("shape")).alias("shape"),
                       F.explode(F.array(F.when(usual, read).otherwise(F.get(F.transform(F.array(parsed), outcome), F.lit(0))))).alias("r"))
    return rows.select("file", "position", F.col("r.malformed").alias("malformed"), "shape", F.col("r.doc").alias("doc"))


def whole_file_documents(files: DataFrame) -> DataFrame:
    """(file, text) -> (file, position, malformed, shape, doc); no document, still one row.

    ``shape`` is NULL, as are a position's block and row: the file has been judged.
    """
    each, usual = xml_usual.told(files.select("file", "text"), xml_usual.FILE), F.col("_head").isNotNull()
    parts = F.get(F.transform(F.array(xml_text.plain(F.col("text"))), xml_text.parted), F.lit(0))
    each = each.select("file", *xml_usual.TOLD, F.explode(F.array(F.when(~usual, parts))).alias("p"))
    sound = F.when(usual, True).otherwise(xml_text.whole_is_sound(F.col("p.rest")))
    each = each.select("file", *xml_usual.TOLD, F.explode(F.array(F.struct(F.col("p.texts").alias("texts"), sound.alias("sound")))).alias("r"))
    return _documents(each.select("file", *(F.lit(None).cast("bigint").alias(c) for c in ("block", "row")), F.col("r.texts").alias("texts"),
                                  (~F.coalesce("r.sound", F.lit(False))).alias("malformed"), F.lit(None).cast(xml_text.SHAPE).alias("shape"), *xml_usual.TOLD))


def _judged_pieces(each: DataFrame, clear: Callable[[Column], Column]) -> DataFrame:
    """(file, block, row, broken, text of a piece) -> (file, position, malformed, shape, doc). ``clear`` leaves tags and values of a text."""
    def read(text: Column) -> Column:
        def told(p: Column) -> Column:
            begun = xml_text.headless(p["rest"])
            texts = F.concat(F.when(begun.isNotNull(), F.array(begun)).otherwise(F.array().cast("array<string>")), p["texts"])
            return F.struct(texts.alias("texts"), xml_text.shape(F.when(begun.isNotNull(), xml_text.without_headless(p["rest"])).otherwise(p["rest"])).alias("shape"))

        return F.get(F.transform(F.array(xml_text.parted(text)), told), F.lit(0))

    each, usual = xml_usual.told(each, xml_usual.PIECE), F.col("_head").isNotNull()
    parts = F.get(F.transform(F.array(clear(F.col("text"))), read), F.lit(0))
    each = each.select("file", "block", "row", "broken", *xml_usual.TOLD, F.explode(F.array(F.when(~usual, parts))).alias("r"))
    shape = F.when(usual, xml_text.shape_of(xml_usual.around("c"), xml_usual.around("o"))).otherwise(F.coalesce("r.shape", xml_text.empty_shape()))
    # A piece that cannot be decoded has no shape.
    return _documents(each.select("file", "block", "row", F.col("r.texts").alias("texts"), (F.col("broken") | (~usual & F.col("r.texts").isNull())).alias("malformed"),
                                  shape.alias("shape"), *xml_usual.TOLD))


def _of_contents(spark: SparkSession, files: list[Row], made: Column, *dealt: str) -> DataFrame:
    """(path, ...) that a generator makes of the ``content`` of each of ``files`` (file, path, length), which are read whole.

    One expression leads from a file's bytes to what is made of them, and the reader's row has no further columns: a row that holds a long text, with room
    to spare, would be copied by every step. Files beyond ``LONG_BYTES`` are read by a quarter of the cores, so that hardly two of them are in the memory of an
    executor, and what is made of these is dealt out by the columns ``dealt``, so that all cores go on with it.
    """
    def read(some: list[Row]) -> DataFrame:
        return spark.read.format("binaryFile").load([literal_path(r.path) for r in some])

    short, long = [r for r in files if r.length <= LONG_BYTES], [r for r in files if r.length > LONG_BYTES]
    rows = [read(short).select("path", made)] if short else []
    if long:
        few = read(long).coalesce(max(1, spark.sparkContext.defaultParallelism // 4)).select("path", made)
        rows.append(few.repartition(*dealt) if dealt else few)
    return reduce(DataFrame.unionByName, rows)


def _named(rows: DataFrame, files: list[Row]) -> DataFrame:
    """Rows with the names of their files in place of the paths."""
    names = {r.path: r.file for r in files}
    named = rows.sparkSession.createDataFrame(list(names.items()), "path string, file string")
    return rows.join(bounded(named, len(names)), "path").drop("path")


def cut_file_documents(spark: SparkSession, files: list[Row]) -> DataFrame:
    """The same rows as of split files for ``files`` (file, path, length), each read whole by a task, and cut at its documents once asides and entities in all its text are settled."""
    parts = _of_contents(spark, files, F.posexplode_outer(xml_text.stretches(xml_text.plain(decoded(F.col("content"))))).alias("block", "part"), "path", "block")
    each = parts.select("path", "block", F.col("part").isNull().alias("lost"), F.posexplode_outer(xml_text.pieces(F.col("part"))).alias("row", "text"))
    # What is left of asides is none, and stands in no well-formed file; nor does one go without text.
    broken = F.col("lost") | F.coalesce(F.contains("text", F.lit("<!")) | F.contains("text", F.lit("<?")), F.lit(False))
    text = F.when(~F.col("lost"), F.coalesce("text", F.lit("")))
    place = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("block", "row")]
    return _judged_pieces(_named(each.select("path", *place, broken.alias("broken"), text.alias("text")), files), lambda t: t)


def _pieces(spark: SparkSession, path: Paths, min_bytes: int, modified_after: str | None, names: str, piece_bytes: int | None = PIECE_BYTES) -> DataFrame:
    """(file, block, row, octets, cut, size): bytes of large files up to each cut, which may be another tag's. Pieces beyond ``piece_bytes`` are passed over."""
    reader = _xml_reader(spark, modified_after, names).option("lineSep", CUT)
    if piece_bytes is not None:
        reader = reader.option("mapreduce.input.linerecordreader.line.maxlength", piece_bytes)
    raw = reader.text(path).filter(F.col("_metadata.file_size") > min_bytes)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"),
                      F.col("value").cast("binary").alias("octets"),
                      (F.contains("value", F.lit("<")) & F.substring_index("value", "<", -1).rlike(_CUT_TAG)).alias("cut"), F.col("_metadata.file_size").alias("size"))


def large_files(spark: SparkSession, path: Paths, *, min_bytes: int = WHOLE_FILE_BYTES, modified_after: str | None = None, names: str = XML_NAMES,
                piece_bytes: int | None = PIECE_BYTES) -> DataFrame:
    """(file, charset, whole, broken) of files larger than ``min_bytes``: whether one must be read whole, and whether its end is missing.

    One pass over them that keeps a row per file. A file of nothing but pieces beyond ``piece_bytes`` has none: it must be read whole too.
    """
    piece = _pieces(spark, path, min_bytes, modified_after, names, piece_bytes)
    text, known = F.col("octets").cast("string"), F.array(*map(F.lit, xml_text.CHARSETS))
    prolog = F.contains(text, F.lit("<?xml")) & text.rlike(r"^(?:\x{FEFF})?<\?xml\s")
    # The charset by its number: all that is kept of a piece has a fixed width, so pieces are hashed by file and split, and not sorted.
    named = F.when(xml_text.may_name_charset(F.col("octets")), F.array_position(known, xml_text.charset(F.substring("octets", 1, xml_text.HEAD_BYTES)))).otherwise(
        F.lit(1 + xml_text.CHARSETS.index("UTF-8")))
    told = piece.select("file", "block", "row", "size", "cut", (F.length("octets") + F.when(F.col("cut"), len(CUT)).otherwise(0)).alias("n"),
                        named.cast("int").alias("named"), prolog.alias("prolog"), xml_text.stands_alone(text).alias("alone"))
    each = told.groupBy("file", "block").agg(
        F.min_by("named", "row").alias("named"), F.max_by("cut", "row").alias("last_cut"), F.count_if(~F.col("cut")).alias("loose"), F.bool_and("alone").alias("alone"),
        F.sum("n").alias("n"), F.max("size").alias("size"), F.count_if("prolog").alias("prologs"), F.min_by("prolog", "row").alias("starts"))
    each = each.groupBy("file").agg(
        F.min_by("named", "block").alias("named"), F.max_by("last_cut", "block").alias("last_cut"), F.sum("loose").alias("loose"), F.bool_and("alone").alias("alone"),
        # The reader leaves out a byte order mark; more bytes than the file has mean that it ends within a tag that looks like a cut.
        F.sum("n").alias("n"), F.max("size").alias("size"), F.sum("prologs").alias("prologs"), F.min_by("starts", "block").alias("starts"))
    # All pieces but the last end at a document's tag, else the cut is inside something else.
    loose = F.col("loose") > F.when(F.col("last_cut"), 0).otherwise(1)
    # Fewer bytes than the file has, but for a mark: a piece was passed over.
    passed = F.col("n") + 3 < F.col("size")
    return each.select("file", F.get(known, F.col("named") - 1).alias("charset"), (loose | ~F.col("alone") | passed).alias("whole"),
                       ((F.col("n") > F.col("size")) | (F.col("prologs") > F.col("starts").cast("int"))).alias("broken"))


def split_file_documents(spark: SparkSession, path: Paths, large: DataFrame, *, min_bytes: int = WHOLE_FILE_BYTES, modified_after: str | None = None,
                         names: str = XML_NAMES, piece_bytes: int | None = PIECE_BYTES) -> DataFrame:
    """The same rows for the files of ``large`` that may be cut, many tasks per file, each piece with its shape."""
    cut = large.filter(~F.col("whole")).select("file", "charset", "broken")
    piece = _pieces(spark, path, min_bytes, modified_after, names, piece_bytes).join(bounded(cut, cut.count()), "file")
    octets = F.when(F.col("cut"), F.concat("octets", F.lit(CUT).cast("binary"))).otherwise(F.col("octets"))
    each = piece.select("file", "block", "row", "broken", F.explode(F.array(xml_text.decoded_as(octets, F.col("charset")))).alias("text"))
    return _judged_pieces(each, xml_text.plain)


def scan_documents(spark: SparkSession, path: Paths, *, whole_file_bytes: int = WHOLE_FILE_BYTES, modified_after: str | None = None,
                   names: str = XML_NAMES) -> DataFrame:
    """All documents below ``path`` in files of such ``names``, small files whole and large ones split.

    ``modified_after`` (``2025-01-31T00:00:00``) prunes the listing, so that old files are not read. Large files are
    looked through first; the driver, which lists all files anyway, keeps a short row of each file above ``CUT_BYTES``.
    """
    one = min(CUT_BYTES, whole_file_bytes)
    small = xml_files(spark, path, max_bytes=one, modified_after=modified_after, names=names)
    out = whole_file_documents(small.select("file", decoded(F.col("content")).alias("text")))
    sized = sized_files(spark, path, modified_after, names).filter(F.col("length") > one).collect()
    if whole := [r for r in sized if r.length <= whole_file_bytes]:
        out = out.unionByName(cut_file_documents(spark, whole))
    if len(whole) == len(sized):
        return out

    def split(paths: Paths, **how) -> tuple[DataFrame, set[str]]:
        """Documents of the files that may be cut, and these files."""
        how |= dict(min_bytes=whole_file_bytes, names=names)
        looked = large_files(spark, paths, **how)
        told = looked.collect()
        return split_file_documents(spark, paths, spark.createDataFrame(told, looked.schema), **how), {r.file for r in told if not r.whole}

    rows, done = split(path, modified_after=modified_after)
    out = out.unionByName(rows)
    left = [r for r in sized if r.length > whole_file_bytes and r.file not in done]
    if beyond := [literal_path(r.path) for r in left if r.length > READ_WHOLE_BYTES]:
        rows, done = split(beyond, piece_bytes=None)
        out, left = out.unionByName(rows), [r for r in left if r.file not in done]
    return out.unionByName(cut_file_documents(spark, left)) if left else out


def file_verdicts(pieces: DataFrame, held: Column | None = None) -> DataFrame:
    """(file, malformed): one bad byte fails the whole file, as do tags around its documents that do not fit together.

    Files read whole have been judged already. Of cut ones the shapes are joined by ``SHAPES`` neighbours, then per split, then per file, so
    beside the tags that are left open no task holds all shapes of a split. ``held`` adds a column of that name: whether it is true of any of the file's rows.
    """
    def either(*names: str) -> list[Column]:
        return [F.bool_or(n).alias(n) for n in names]

    told = ["malformed"] if held is None else ["malformed", "held"]
    pieces = pieces if held is None else pieces.withColumn("held", held)
    whole = pieces.filter("position.block IS NULL").groupBy("file").agg(*either(*told))

    def together(rows: DataFrame, by: list[str], place: str) -> DataFrame:
        # Rows without a shape, later documents of a piece, are not collected.
        shapes = F.array_sort(F.collect_list(F.when(F.col("shape").isNotNull(), F.struct(F.col(place).alias("place"), "shape"))))
        return rows.groupBy(*by).agg(*either(*told), xml_text.all_joined(shapes).alias("shape"))

    cut = pieces.filter("position.block IS NOT NULL").select(
        "file", F.col("position.block").alias("block"), F.expr(f"position.row DIV {SHAPES}").alias("part"), F.col("position.row").alias("row"), "shape", *told)
    cut = together(together(together(cut, ["file", "block", "part"], "row"), ["file", "block"], "part"), ["file"], "block")
    return whole.unionByName(cut.select("file", (F.col("malformed") | ~xml_text.sound(F.col("shape"))).alias("malformed"), *told[1:]))


def sound_documents(pieces: DataFrame) -> DataFrame:
    """Pieces of well-formed files, for split files, whose verdict needs all their pieces.

    Reads the pieces twice: stage them first. Bad files are few, so AQE broadcasts them.
    """
    bad = file_verdicts(pieces).filter("malformed").select("file")
    return pieces.join(bad, "file", "left_anti")


# ---- projection -------------------------------------------------------------------------------

def header_projection(doc: Column) -> list[Column]:
    """The ten header columns."""
    head = doc.getField("Encabezado")
    ids, issuer = head.getField("IdDoc"), head.getField("Emisor")
    receiver, totals = head.getField("Receptor"), head.getField("Totales")

    def money(name: str) -> Column:
        return whole(totals.getField(name)).try_cast("decimal(18,2)").alias(
            {"MntNeto": "mnt_neto", "IVA": "iva", "MntTotal": "mnt_total"}[name])

    return [
        whole(ids.getField("TipoDTE")).try_cast("int").alias("tipo_dte"),
        whole(ids.getField("Folio")).alias("folio"),
        iso_day(ids.getField("FchEmis")).alias("fecha_emision"),
        present(issuer.getField("RUTEmisor")).alias("rut_emisor"),
        F.coalesce(present(issuer.getField("RznSocEmisor")), present(issuer.getField("RznSoc"))).alias("razon_social_emisor"),
        present(receiver.getField("RUTRecep")).alias("rut_receptor"),
        F.coalesce(present(receiver.getField("RznSocRecep")), present(receiver.getField("RznSoc"))).alias("razon_social_receptor"),
        money("MntNeto"), money("IVA"), money("MntTotal"),
    ]


def line_projection(line: Column) -> Column:
    """One line element as a struct of the eight line columns, gaps in price and quantity filled."""
    code = F.get(line.getField("CdgItem"), F.lit(0))
    name = present(line.getField("NmbItem"))
    quantity, price = number(line.getField("QtyItem")), number(line.getField("PrcItem"))
    amount = whole(line.getField("MontoItem")).try_cast("decimal(18,2)")
    return F.struct(
        whole(line.getField("NroLinDet")).try_cast("int").alias("nro_linea"),
        present(code.getField("TpoCodigo")).alias("tipo_codigo"),
        name.alias("nombre_item"),
        present(code.getField("VlrCodigo")).alias("codigo"),
        F.coalesce(present(line.getField("DscItem")), name).alias("descripcion"),
        fill_quantity(quantity, price, amount).alias("cantidad"),
        fill_price(price, quantity, amount).alias("precio_unitario"),
        amount.alias("monto_item"),
    )


def header_key(tipo: Column, folio: Column, issuer: Column) -> Column:
    """The business key as text: exact at any size, and the same on every run."""
    return F.concat_ws(":", tipo.cast("string"), folio.cast("string"), issuer)


def parsed_documents(documents: DataFrame) -> DataFrame:
    """(file, position, malformed, doc) -> header columns and the line array, one row per document.

    Documents without a header block are skipped, as are rows that only stand for their file.
    """
    rows = documents.filter(F.col("doc.Encabezado").isNotNull()).select(
        "file", "position", *header_projection(F.col("doc")),
        F.transform(F.col("doc.Detalle"), line_projection).alias("lines"),
    )
    return rows.withColumn("header_id", header_key(F.col("tipo_dte"), F.col("folio"), F.col("rut_emisor")))


def line_rows(documents: DataFrame, *keep: Column) -> DataFrame:
    """One row per line: ``keep`` and the line columns, where no rule needs a document's lines together.

    Lines are exploded first, so their columns are plain ones under code generation, not lambdas over an array.
    """
    raw = documents.filter(F.col("doc.Encabezado").isNotNull()).select(*keep, F.explode("doc.Detalle").alias("_line"))
    kept = [c for c in raw.columns if c != "_line"]
    return raw.select(*kept, line_projection(F.col("_line")).alias("_l")).select(*kept, "_l.*")


def document_lines(parsed: DataFrame) -> DataFrame:
    """One row per line, keyed by document and place in it."""
    rows = parsed.select("header_id", F.posexplode("lines").alias("at", "line"))
    key = F.concat_ws("#", F.col("header_id"), (F.col("at") + 1).cast("string"))
    return rows.select(key.alias("line_id"), "header_id", "line.*")


# ---- tolerant reading -------------------------------------------------------------------------

def _amount(text: Column) -> Column:
    plain = F.replace(present(text), F.lit(","), F.lit("."))
    return F.coalesce(plain.try_cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))


def tolerant_documents(documents: DataFrame, as_of) -> DataFrame:
    """Documents read with defaults for whatever is missing: empty text, zero, the day ``as_of``."""
    head = F.col("doc.Encabezado")
    ids, issuer, receiver, totals = (head.getField(n) for n in ("IdDoc", "Emisor", "Receptor", "Totales"))

    def text(c: Column) -> Column:
        return F.coalesce(present(c), F.lit(""))

    def line(d: Column) -> Column:
        code = F.get(d.getField("CdgItem"), F.lit(0))
        value = present(code.getField("VlrCodigo"))
        joined = F.concat(text(code.getField("_VALUE")), F.when(value.isNotNull(), F.concat(F.lit(":"), value)).otherwise(""))
        return F.struct(
            F.coalesce(whole(d.getField("NroLinDet")), F.lit(0)).alias("n_linea"),
            F.nullif(joined, F.lit("")).alias("codigo"),
            text(d.getField("NmbItem")).alias("descripcion"),
            _amount(d.getField("QtyItem")).alias("cantidad"),
            _amount(d.getField("PrcItem")).alias("precio_unit"),
            _amount(d.getField("MontoItem")).alias("monto_item"),
        )

    day = F.coalesce(present(ids.getField("FchEmis")), present(ids.getField("FechaEmision")))
    return documents.filter(F.col("doc").isNotNull()).select(
        "file", "position",
        text(ids.getField("TipoDTE")).alias("tipo_dte"),
        text(ids.getField("Folio")).alias("folio"),
        F.coalesce(iso_day(day), F.lit(as_of).cast("date")).alias("fecha_emision"),
        text(issuer.getField("RUTEmisor")).alias("rut_emisor"),
        text(issuer.getField("RznSoc")).alias("rznsoc_emisor"),
        text(receiver.getField("RUTRecep")).alias("rut_receptor"),
        text(receiver.getField("RznSocRecep")).alias("rznsoc_receptor"),
        _amount(totals.getField("MntNeto")).alias("mnt_neto"),
        _amount(totals.getField("IVA")).alias("iva"),
        _amount(totals.getField("MntTotal")).alias("mnt_total"),
        F.transform(F.col("doc.Detalle"), line).alias("lines"),
    )


# ---- XSD --------------------------------------------------------------------------------------

def xsd_kind(text: Column, most: int = XSD_HEAD) -> Column:
    """Which schema a file declares, from its first characters; NULL for neither."""
    head = F.substring(text, 1, most)
    return (
        F.when(F.contains(head, F.lit(XSD_KINDS["boleta"])), "boleta")
        .when(F.contains(head, F.lit(XSD_KINDS["dte"])), "dte")
    )


def _broken_kind(text: Column, xsd_paths: dict[str, str]) -> Column:
    """The schema that a text declares and breaks; NULL for others. Only a text of a known kind is validated, and no more than the outcome is kept of it."""
    if not xsd_paths:
        raise ValueError("name at least one schema")

    def of(t: Column) -> Column:
        kind, out = xsd_kind(t), F.lit(None).cast("string")
        for name, xsd in xsd_paths.items():
            parsed = F.from_xml(t, "_corrupt_record string", {**PARSER, "rowValidationXSDPath": xsd})
            out = F.when((kind == name) & parsed.getField("_corrupt_record").isNotNull(), name).otherwise(out)
        return out

    return F.get(F.transform(F.array(text), of), F.lit(0))


def xsd_invalid(files: DataFrame, xsd_paths: dict[str, str]) -> DataFrame:
    """(file, text) -> (file, kind) of files that break the schema they declare.

    ``xsd_paths`` maps kind to a path that every executor can read.
    """
    return files.select("file", F.explode(F.array(_broken_kind(F.col("text"), xsd_paths))).alias("kind")).filter(F.col("kind").isNotNull())


def xsd_invalid_files(spark: SparkSession, files: list[Row], xsd_paths: dict[str, str]) -> DataFrame:
    """The same for ``files`` (file, path, length). Those whose first bytes name no schema are not decoded."""
    # A character has four bytes at most, and names are ASCII, in UTF-16 with empty bytes between.
    head = F.replace(F.decode(F.substring("content", 1, 4 * XSD_HEAD), "ISO-8859-1"), F.char(F.lit(0)), F.lit(""))
    broken = F.when(xsd_kind(head, 4 * XSD_HEAD).isNotNull(), _broken_kind(decoded(F.col("content")), xsd_paths))
    if not files:
        return spark.createDataFrame([], "kind string, file string")
    return _named(_of_contents(spark, files, F.explode(F.array(broken)).alias("kind")).filter(F.col("kind").isNotNull()), files)
