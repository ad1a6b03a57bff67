"""Accounting reports in XML -> aligned wide rows (CMP-3, CMP-4, RSH-2, RSH-3, PRJ-8, PRJ-9).

One ``from_xml`` parse serves both report kinds (the reference parses every
file twice).  The schema is generated from the layout below; every attribute
is read as text (leading zeros matter) and every element as an array, so a
repeated element is visible and its first occurrence is taken.

The wide row is a pure projection of the parsed struct: each dictionary line
is a fixed path, so there is no shuffle, and a missing or gapped element
leaves its own columns empty instead of shifting the row (decisions D-10,
D-11).  Several ``Документ`` in one file give one row each (D-12).

The dictionary (code -> element) is metadata of a few hundred lines; it is
read on the driver once (``dictionary_lines``) to build the schema and the select
list, like a schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import route_by_prefix
from .columns import dedupe_names

FULL, SIMPLE = "full", "simplified"
CORRUPT = "_corrupt_record"

# Attribute names of a balance line and of a results line.
BAL_ATTRS = ["СумОтч", "СумПрдщ", "СумПрдшв"]
RES_ATTRS = ["СумОтч", "СумПред"]

# File id prefix and form code (КНД) of each report kind, and the label it gets.
KIND_PREFIX = {"NO_BUHOT": FULL, "NO_BOUPR": SIMPLE}
KIND_FORM = {FULL: ("0710099", "Полная"), SIMPLE: ("0710096", "Упрощённая")}

# Code remapping so that totals sort before their parts.
CODE_REMAP = {1600: 1099, 1700: 1299, 13001: 1301, 13002: 1302}

# Dictionary codes left out of each report kind.
EXCLUDED = {
    FULL: [1151, 1171, 1231, 1301, 1302, 1411, 1451, 1511, 1551, 2121, 2416],
    SIMPLE: [1110, 1120, 1130, 1140, 1150, 1160, 1170, 1180, 1190, 1100, 1220, 1230, 1240, 1260,
             1200, 1310, 1320, 1340, 1350, 1360, 1370, 1300, 1410, 1420, 1430, 1450, 1400, 1510,
             1530, 1540, 1550, 1500, 2120, 2130, 2210, 2220, 2230, 2310, 2320, 2360, 2410, 2411,
             2412, 2460, 2510, 2520, 2530, 2540, 2900, 2910],
}

# Where report lines sit.  Section totals are found by code;
# elements inside a section by name, in this order.  A name that occurs in two
# sections belongs to a section only when that section's code for it is in
# the dictionary (SECTION_CODE).
SECTION_TOTALS = {
    FULL: [(1099, ("Баланс", "Актив")), (1100, ("Баланс", "Актив", "ВнеОбА")),
           (1200, ("Баланс", "Актив", "ОбА")), (1299, ("Баланс", "Пассив")),
           (1300, ("Баланс", "Пассив", "КапРез")), (1400, ("Баланс", "Пассив", "ДолгосрОбяз")),
           (1500, ("Баланс", "Пассив", "КраткосрОбяз"))],
    SIMPLE: [(1099, ("Баланс", "Актив")), (1299, ("Баланс", "Пассив"))],
}
SECTION_ITEMS = {
    FULL: [
        (("Баланс", "Актив", "ВнеОбА"), ["НематАкт", "РезИсслед", "НеМатПоискАкт", "МатПоискАкт", "ОснСр",
                                         "ВлМатЦен", "ФинВлож", "ОтлНалАкт", "ПрочВнеОбАкт"]),
        (("Баланс", "Актив", "ОбА"), ["Запасы", "НДСПриобрЦен", "ДебЗад", "ФинВлож", "ДенежнСр", "ПрочОба"]),
        (("Баланс", "Пассив", "КапРез"), ["УставКапитал", "СобствАкции", "ПереоцВнеОбА", "ДобКапитал",
                                          "РезКапитал", "НераспПриб"]),
        (("Баланс", "Пассив", "ДолгосрОбяз"), ["ЗаемСредств", "ОтложНалОбяз", "ОценОбяз", "ПрочОбяз"]),
        (("Баланс", "Пассив", "КраткосрОбяз"), ["ЗаемСредств", "КредитЗадолж", "ДоходБудущ", "ОценОбяз",
                                                "ПрочОбяз"]),
        (("ФинРез",), ["Выруч", "СебестПрод", "ВаловаяПрибыль", "КомРасход", "УпрРасход", "ПрибПрод",
                       "ДоходОтУчаст", "ПроцПолуч", "ПроцУпл", "ПрочДоход", "ПрочРасход", "ПрибУбДоНал",
                       "НалПриб", "ТекНалПриб", "ОтложНалПриб", "ПостНалОбяз", "ИзмНалОбяз", "ИзмНалАктив",
                       "Прочее", "ЧистПрибУб", "РезПрцВОАНеЧист", "РезПрОпНеЧис", "НалПрибОпНеЧист",
                       "СовФинРез", "БезПрибылАкц", "РазводПрибылАкц"]),
    ],
    SIMPLE: [
        (("Баланс", "Актив"), ["МатВнеАкт", "НеМатФинАкт", "Запасы", "ФинВлож", "ДенежнСр"]),
        (("Баланс", "Пассив"), ["КапРез", "ЦелевСредства", "ФондИмущИнЦФ", "ДлгЗаемСредств", "ДрДолгосрОбяз",
                                "КртЗаемСредств", "КредитЗадолж", "ДрКраткосрОбяз"]),
        (("ФинРез",), ["Выруч", "РасхОбДеят", "ПроцУпл", "ПрочДоход", "ПрочРасход", "НалПрибДох", "ЧистПрибУб"]),
    ],
}
SECTION_CODE = {
    FULL: {(("Баланс", "Актив", "ВнеОбА"), "ФинВлож"): 1170, (("Баланс", "Актив", "ОбА"), "ФинВлож"): 1240,
           (("Баланс", "Пассив", "ДолгосрОбяз"), "ЗаемСредств"): 1410,
           (("Баланс", "Пассив", "ДолгосрОбяз"), "ОценОбяз"): 1430,
           (("Баланс", "Пассив", "ДолгосрОбяз"), "ПрочОбяз"): 1450,
           (("Баланс", "Пассив", "КраткосрОбяз"), "ЗаемСредств"): 1510,
           (("Баланс", "Пассив", "КраткосрОбяз"), "ОценОбяз"): 1540,
           (("Баланс", "Пассив", "КраткосрОбяз"), "ПрочОбяз"): 1550},
    SIMPLE: {},
}
# The identifying columns (two-level header) of every report row.
ID_HEADER = [("ИдФайл", "xml"), ("КНД", "Тип"), ("КНД", "ОтчетГод"), ("ДатаДок", "ГГГГММДД"),
             ("СвНП", "ОКВЭД2"), ("НПЮЛ", "ИННЮЛ"), ("НПЮЛ", "НаимОрг")]


# ------------------------------------------------------------------ dictionary
def prepare_dictionary(dictionary: DataFrame, kind: str) -> DataFrame:
    """SRC-4 / MTH-9 / FLT-15 / SRT-2: remap codes, drop the kind's excluded codes, order by code."""
    code = F.col("code").cast("int")
    remapped = code
    for old, new in CODE_REMAP.items():
        remapped = F.when(code == old, F.lit(new)).otherwise(remapped)
    d = dictionary.select(remapped.alias("code"), F.col("element"))
    return d.where(~F.col("code").isin(EXCLUDED[kind])).orderBy("code")


def dictionary_lines(dictionary) -> list[tuple[int, str]]:
    """The dictionary's (code, element) lines on the driver; a list is taken as it is."""
    if isinstance(dictionary, DataFrame):
        return [(r["code"], r["element"]) for r in dictionary.select(F.col("code").cast("int").alias("code"), "element").collect()]
    return list(dictionary)


def attrs_of(code: int) -> list[str]:
    return BAL_ATTRS if code < 2000 else RES_ATTRS


def line_paths(lines: list[tuple[int, str]], kind: str) -> dict[tuple[int, str], tuple[str, ...]]:
    """XML path of each dictionary line (code, element) for one kind; lines without a place are absent."""
    codes = {c for c, _ in lines}
    out = {}
    by_code = dict(SECTION_TOTALS[kind])
    for code, element in lines:
        if code in by_code:
            out[(code, element)] = by_code[code]
    for parent, names in SECTION_ITEMS[kind]:
        for name in names:
            want = SECTION_CODE[kind].get((parent, name))
            if want is not None and want not in codes:
                continue
            for code, element in lines:
                if element == name and (want is None or code == want) and (code, element) not in out:
                    if code in by_code:
                        continue
                    out[(code, element)] = (*parent, name)
                    break
    return out


def report_header(dictionary: DataFrame, kind: str) -> DataFrame:
    """PRJ-9 + PRJ-8: one row per output column: position, header name (repeats numbered
    ``_1``, ``_2`` .. like the reference's header line 1), attribute, code, element, column name.

    Built on the dictionary (hundreds of rows), so a window over all of it is cheap.
    """
    spark = dictionary.sparkSession
    ids = spark.createDataFrame([(i, n, a, None, None) for i, (n, a) in enumerate(ID_HEADER)],
                                "pos int, element string, attr string, code int, attr_pos int")
    d = prepare_dictionary(dictionary, kind)
    attrs = F.when(F.col("code") < 2000, F.array(*[F.lit(a) for a in BAL_ATTRS])) \
             .otherwise(F.array(*[F.lit(a) for a in RES_ATTRS]))
    lines = d.select("code", "element", F.posexplode(attrs).alias("attr_pos", "attr"))
    lines = lines.withColumn("pos", (F.row_number().over(Window.orderBy("code", "element", "attr_pos"))
                                     + len(ID_HEADER) - 1).cast("int"))
    h = ids.unionByName(lines.select("pos", "element", "attr", "code", "attr_pos"))
    rep = F.row_number().over(Window.partitionBy("element").orderBy("pos")) - 1
    name = F.when(rep == 0, F.col("element")).otherwise(F.concat("element", F.lit("_"), rep.cast("string")))
    return (h.withColumn("name", name)
             .withColumn("column", F.concat("name", F.lit("__"), "attr"))
             .select("pos", "name", "attr", "code", "element", "column"))


# ------------------------------------------------------------------ schema
def _attr_struct(names: list[str]) -> list[T.StructField]:
    return [T.StructField("_" + a, T.StringType()) for a in names]


def layout_paths(kinds=(FULL, SIMPLE)) -> list[tuple[str, ...]]:
    """Every element path of the kinds' layouts."""
    out = []
    for kind in kinds:
        out += [path for _, path in SECTION_TOTALS[kind]]
        out += [(*parent, n) for parent, names in SECTION_ITEMS[kind] for n in names]
    return out


def kind_lines(dictionary, kind: str) -> list[tuple[int, str]]:
    """The lines of one kind in header order: codes remapped, excluded ones left out."""
    lines = [(CODE_REMAP.get(c, c), e) for c, e in dictionary_lines(dictionary)]
    return sorted((c, e) for c, e in lines if c not in EXCLUDED[kind])


def header_columns(dictionary, kind: str) -> list[tuple[str, str, int, str]]:
    """(column, attribute, code, element) of a kind's value columns, as ``report_header`` names them."""
    lines = kind_lines(dictionary, kind)
    names = dedupe_names([n for n, _ in ID_HEADER] + [e for c, e in lines for _ in attrs_of(c)])[len(ID_HEADER):]
    cells = [(a, c, e) for c, e in lines for a in attrs_of(c)]
    return [(f"{n}__{a}", a, c, e) for n, (a, c, e) in zip(names, cells)]


def header_lines(dictionary, kind: str) -> list[list[str]]:
    """The two header lines of a kind's file: element (repeats as they are) over attribute."""
    cells = [*ID_HEADER, *[(e, a) for _, a, _, e in header_columns(dictionary, kind)]]
    return [[e for e, _ in cells], [a for _, a in cells]]


def needed_paths(dictionary, kinds=(FULL, SIMPLE)) -> list[tuple[str, ...]]:
    """Element paths the dictionary's lines occupy: all the parse has to read."""
    return [path for kind in kinds for path in line_paths(kind_lines(dictionary, kind), kind).values()]


def report_schema(paths: list[tuple[str, ...]] | None = None) -> T.StructType:
    """Schema of one report file for ``from_xml``, all text.

    Only the given element paths are described (column pruning for XML: the
    parser skips everything else, which is most of its cost); default: the
    whole layout of both kinds.
    """
    tree: dict = {}
    for path in (paths if paths is not None else layout_paths()):
        t = tree
        for p in path:
            t = t.setdefault(p, {})

    def build(name, sub, depth):
        is_res = name == "ФинРез" or depth == "res"
        own = [] if name in ("Баланс", "ФинРез") else _attr_struct(RES_ATTRS if depth == "res" else BAL_ATTRS)
        kids = [build(k, v, "res" if is_res else "bal") for k, v in sorted(sub.items())]
        return T.StructField(name, T.ArrayType(T.StructType(own + kids)))

    npul = T.StructField("НПЮЛ", T.ArrayType(T.StructType(_attr_struct(["ИННЮЛ", "НаимОрг"]))))
    svnp = T.StructField("СвНП", T.ArrayType(T.StructType(_attr_struct(["ОКВЭД2"]) + [npul])))
    doc = T.StructType(_attr_struct(["КНД", "ОтчетГод", "ДатаДок"]) + [svnp]
                       + [build(k, v, None) for k, v in sorted(tree.items())])
    return T.StructType(_attr_struct(["ИдФайл"]) + [T.StructField("Документ", T.ArrayType(doc)),
                                                     T.StructField(CORRUPT, T.StringType())])


# ------------------------------------------------------------------ parse and flatten
def _first(c: Column) -> Column:
    return F.get(c, 0)


# whatever may stand before the root: declaration, comments, doctype; then the root's start tag
_BEFORE_ROOT = r"^\uFEFF?\s*(?:<\?[\s\S]*?\?>\s*|<!--[\s\S]*?-->\s*|<!DOCTYPE[^>\[]*(?:\[[\s\S]*?\]\s*)?>\s*)*"
_ATTRIBUTE = r"""\s+[^\s=>/]+\s*=\s*(?:"[^"]*"|'[^']*')"""
_ROOT_ID = _BEFORE_ROOT + r"<[^\s>/!?]+(?:" + _ATTRIBUTE + r""")*?\s+ИдФайл\s*=\s*["']([^"']*)["']"""


def raw_file_id(content: Column) -> Column:
    """The root's ``ИдФайл`` read from the text before any parsing; empty if the root has none.

    The pattern is anchored: it steps over the prolog, however long, to the first start tag.
    """
    return F.regexp_extract(content, _ROOT_ID, 1)


def parse_reports(files: DataFrame, content: str = "content", dictionary=None,
                  kinds=(FULL, SIMPLE)) -> DataFrame:
    """Parse each wanted file once; one row per (file, document).

    The kind comes from the file id prefix read off the raw text (FLT-12), so
    files of other kinds are dropped before the parser runs and no later filter
    has to look inside the parsed struct (a pushed-down filter on a parsed field
    would make Spark parse twice).  With a ``dictionary`` only the elements its
    lines need are read.  Files that are not well-formed XML yield no rows
    (``report_status`` counts them).
    """
    schema = report_schema(needed_paths(dictionary, kinds) if dictionary is not None else None)
    # the kind comes out of an explode: a filter on a plain column would be pushed down, and the text made once more for it
    kind = route_by_prefix(raw_file_id(F.col(content)), KIND_PREFIX)
    f = files.select("*", F.explode_outer(F.array(kind)).alias("kind"))
    if kinds:
        f = f.where(F.col("kind").isin(*kinds))
    parsed = f.withColumn("report", F.from_xml(F.col(content), schema,
                                               {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    return parsed.select("*", F.posexplode("report.Документ").alias("doc_no", "doc")).drop(content)


def document_schema(dictionary=None, kinds=(FULL, SIMPLE)) -> T.StructType:
    """Schema of one ``Документ`` for the row-tag source."""
    whole = report_schema(needed_paths(dictionary, kinds) if dictionary is not None else None)
    return whole["Документ"].dataType.elementType


def route_documents(documents: DataFrame, heads: DataFrame, kinds=(FULL, SIMPLE)) -> DataFrame:
    """Documents that the row-tag source cut out of their files, in the form of ``parse_reports``.

    ``heads`` (``file_path``, ``head``: the text before a file's first document) gives each file's id and
    kind; the files of other kinds drop out with their documents.
    """
    ids = heads.select("file_path", raw_file_id(F.col("head")).alias("__id"))
    ids = ids.withColumn("kind", route_by_prefix(F.col("__id"), KIND_PREFIX)).where(F.col("kind").isin(*kinds))
    return documents.join(ids, "file_path").select(
        F.element_at(F.split("file_path", "/"), -1).alias("file_name"), "kind", F.struct(F.col("__id").alias("_ИдФайл")).alias("report"),
        "doc_no", "doc")


def report_status(files: DataFrame, content: str = "content") -> DataFrame:
    """Per file: kind, whether it is broken XML, and its number of documents (AGG-9 for reports).

    A file whose id names no known kind has the kind ``unroutable``: it is counted, not lost.
    """
    tiny = T.StructType([T.StructField("Документ", T.ArrayType(T.StructType([T.StructField("_КНД", T.StringType())]))),
                         T.StructField(CORRUPT, T.StringType())])
    r = F.from_xml(F.col(content), tiny, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    kind = F.coalesce(route_by_prefix(raw_file_id(F.col(content)), KIND_PREFIX), F.lit("unroutable"))
    st = files.select("file_name", kind.alias("kind"),
                      F.when(r[CORRUPT].isNotNull(), F.lit(-1)).otherwise(F.coalesce(F.size(r["Документ"]), F.lit(0)))
                      .alias("__n"))
    return st.select("file_name", "kind", (F.col("__n") < 0).alias("broken"),
                     F.greatest(F.col("__n"), F.lit(0)).alias("documents"))


def _value(doc: Column, path: tuple[str, ...], attr: str) -> Column:
    c = doc
    for p in path:
        c = _first(c[p])
    return c["_" + attr]


def id_items(doc: Column, report: Column, kind: str) -> list[tuple[str, Column]]:
    """The seven identifying columns of a report row, as (column name, expression)."""
    code, label = KIND_FORM[kind]
    nul = _first(_first(doc["СвНП"])["НПЮЛ"])
    return [("ИдФайл__xml", report["_ИдФайл"]),
            ("КНД__Тип", F.replace(doc["_КНД"], F.lit(code), F.lit(label))),
            ("КНД_1__ОтчетГод", doc["_ОтчетГод"]),
            ("ДатаДок__ГГГГММДД", F.replace(doc["_ДатаДок"], F.lit("."), F.lit(""))),
            ("СвНП__ОКВЭД2", F.replace(_first(doc["СвНП"])["_ОКВЭД2"], F.lit("."), F.lit(""))),
            ("НПЮЛ__ИННЮЛ", nul["_ИННЮЛ"]),
            ("НПЮЛ_1__НаимОрг", F.replace(nul["_НаимОрг"], F.lit(";"), F.lit(",")))]


def id_columns(doc: Column, report: Column, kind: str) -> list[Column]:
    return [e.alias(n) for n, e in id_items(doc, report, kind)]


def flatten_reports(parsed: DataFrame, dictionary, kind: str) -> DataFrame:
    """CMP-3: one aligned wide row per document of the given kind, values as text."""
    doc, rep = F.col("doc"), F.col("report")
    cols = [v.alias(n) for n, v in _value_items(doc, dictionary, kind)]
    return parsed.where(F.col("kind") == kind).select(*id_columns(doc, rep, kind), *cols)


def fuse_reports(full: DataFrame, simple: DataFrame) -> DataFrame:
    """CMP-4 / SET-5: full and simplified rows in one table; columns matched by two-level name."""
    return full.unionByName(simple, allowMissingColumns=True)


def _value_items(doc: Column, dictionary, kind: str) -> list[tuple[str, Column]]:
    paths = line_paths(kind_lines(dictionary, kind), kind)
    return [(column, _value(doc, paths[code, element], attr) if (code, element) in paths else F.lit(None).cast("string"))
            for column, attr, code, element in header_columns(dictionary, kind)]


def flatten_fused(parsed: DataFrame, dictionary, kinds=(FULL, SIMPLE)) -> DataFrame:
    """CMP-3 + CMP-4 in one projection over one parse: the columns of every kind, each
    filled from the row's own kind (same rows and columns as ``fuse_reports`` of the
    per-kind tables, without reading the parsed reports once per kind)."""
    doc, rep = F.col("doc"), F.col("report")
    order, exprs = [], {}
    for kind in kinds:
        is_kind = F.col("kind") == kind
        for name, e in id_items(doc, rep, kind) + _value_items(doc, dictionary, kind):
            if name not in exprs:
                order.append(name)
                exprs[name] = F.when(is_kind, e)
            else:
                exprs[name] = exprs[name].when(is_kind, e)
    return parsed.where(F.col("kind").isin(*kinds)).select(*[exprs[n].alias(n) for n in order])


def _occurrences(doc: Column, path: tuple[str, ...]) -> Column:
    """All occurrences of the element at ``path`` (first occurrence of every parent)."""
    c = doc
    for p in path[:-1]:
        c = _first(c[p])
    return c[path[-1]]


def _line_values(code, element):
    def one(x, i):
        return F.array(*[F.struct(F.lit(code).alias("code"), F.lit(element).alias("element"), i.alias("rep"),
                                  F.lit(a).alias("attr"), x["_" + a].alias("value")) for a in attrs_of(code)])
    return one


def xml_to_long(parsed: DataFrame, dictionary, kind: str) -> DataFrame:
    """RSH-2: (file id, document, code, element, rep, attr, value) for every value present.

    Every occurrence of a repeated element is kept (``rep`` = 0, 1, ..), as the
    reference writes all of them; the wide form takes ``rep`` 0.  One pass per line gives
    the values of all its attributes, nulls are dropped inside the array, and one
    ``inline`` makes the rows.
    """
    doc = F.col("doc")
    parts = [F.flatten(F.transform(F.coalesce(_occurrences(doc, path), F.array()), _line_values(code, element)))
             for (code, element), path in sorted(line_paths(kind_lines(dictionary, kind), kind).items())]
    values = F.filter(F.flatten(F.array(*parts)), lambda v: v["value"].isNotNull())
    # the outer form: for the plain one Spark would put a test of the array's size below the parse and parse twice
    long = parsed.where(F.col("kind") == kind).select(
        F.col("report._ИдФайл").alias("file_id"), "doc_no", F.inline_outer(values))
    return long.where(F.col("value").isNotNull())


def long_to_wide(long: DataFrame, ids: list[str], key: str, value: str, columns: list[str]) -> DataFrame:
    """RSH-3: long rows to one row per id with a column per key; of repeated keys the largest value.

    One aggregate of a column each: an id's rows meet before the shuffle, while ``pivot`` first
    groups by id and key and so sorts and shuffles every long row."""
    return long.groupBy(*ids).agg(*[F.max(F.when(F.col(key) == c, F.col(value))).alias(c) for c in columns])
