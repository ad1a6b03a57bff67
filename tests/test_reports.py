from __future__ import annotations

import os
import tempfile

import pytest

from ledgerline.operators import reports as R
from ledgerline.sources.files import read_code_dictionary, read_xml_reports
from tests.conftest import rows

DICT = [(1600, "Актив"), (1100, "ВнеОбА"), (1110, "НематАкт"), (1120, "РезИсслед"), (1150, "ОснСр"),
        (1170, "ФинВлож"), (1200, "ОбА"), (1210, "Запасы"), (1240, "ФинВлож"), (1700, "Пассив"),
        (2110, "Выруч"), (2120, "СебестПрод"), (1151, "Искл"), (13001, "МатВнеАкт"), (1250, "ДенежнСр")]


def doc(inner, knd="0710099", year="2020", date="31.03.2021", name="A; B"):
    return (f'<Документ КНД="{knd}" ОтчетГод="{year}" ДатаДок="{date}"><СвНП ОКВЭД2="62.01">'
            f'<НПЮЛ ИННЮЛ="0700000001" НаимОрг="{name}"/></СвНП>{inner}</Документ>')


FILES = {
    # gap: positions 1 and 3 of ВнеОбА present, 2 missing; results present
    "gap.xml": '<Файл ИдФайл="NO_BUHOT_1">' + doc(
        '<Баланс><Актив СумОтч="10" СумПрдщ="9" СумПрдшв="8"><ВнеОбА СумОтч="4">'
        '<НематАкт СумОтч="1" СумПрдщ="2"/><ОснСр СумОтч="3" СумПрдщ="2" СумПрдшв="1"/></ВнеОбА>'
        '<ОбА СумОтч="6"><ФинВлож СумОтч="5"/></ОбА></Актив></Баланс>'
        '<ФинРез><Выруч СумОтч="7" СумПред="5"/></ФинРез>') + '</Файл>',
    # absent balance section, repeated element (first one wins in the wide row)
    "nobal.xml": '<Файл ИдФайл="NO_BUHOT_2">' + doc(
        '<ФинРез><Выруч СумОтч="1" СумПред="2"/><Выруч СумОтч="100" СумПред="200"/></ФинРез>') + '</Файл>',
    # two documents, no results section
    "twodocs.xml": '<Файл ИдФайл="NO_BUHOT_3">' + doc('<Баланс><Актив СумОтч="1"/></Баланс>', year="2019")
                   + doc('<Баланс><Актив СумОтч="2"/></Баланс>', year="2020") + '</Файл>',
    "simple.xml": '<Файл ИдФайл="NO_BOUPR_4">' + doc(
        '<Баланс><Актив СумОтч="50"><МатВнеАкт СумОтч="5"/><Запасы СумОтч="6"/></Актив></Баланс>'
        '<ФинРез><Выруч СумОтч="9" СумПред="8"/></ФинРез>', knd="0710096") + '</Файл>',
    "other.xml": '<Файл ИдФайл="NO_OTHER_5">' + doc('<ФинРез><Выруч СумОтч="1"/></ФинРез>') + '</Файл>',
    "broken.xml": '<Файл ИдФайл="NO_BUHOT_6"><Документ КНД="0710099"><Баланс>',
}


_FOLDER = []


@pytest.fixture(scope="module")
def folder():
    d = tempfile.mkdtemp(prefix="ledgerline-xml-")
    _FOLDER.append(d)
    for name, text in FILES.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write('<?xml version="1.0" encoding="utf-8"?>\n' + text)
    cp = '<Файл ИдФайл="NO_BUHOT_7">' + doc('<ФинРез><Выруч СумОтч="3" СумПред="4"/></ФинРез>', name="ООО Ромашка") + '</Файл>'
    with open(os.path.join(d, "cp1251.xml"), "wb") as f:
        f.write(('<?xml version="1.0" encoding="windows-1251"?>\n' + cp).encode("cp1251"))
    with open(os.path.join(d, "dictionary.txt"), "w", encoding="utf-8") as f:
        f.write("\n".join(f"{c};{e}" for c, e in DICT))
    return d


@pytest.fixture(scope="module")
def parsed(spark, folder):
    files = read_xml_reports(spark, os.path.join(folder, "*.xml"))
    return R.parse_reports(files).cache()


@pytest.fixture(scope="module")
def dictionary(spark, folder):
    return read_code_dictionary(spark, os.path.join(folder, "dictionary.txt"))


def test_header_and_dedupe(dictionary):
    h = [r.asDict() for r in R.report_header(dictionary, R.FULL).orderBy("pos").collect()]
    cols = [r["column"] for r in h]
    assert cols[:7] == ["ИдФайл__xml", "КНД__Тип", "КНД_1__ОтчетГод", "ДатаДок__ГГГГММДД", "СвНП__ОКВЭД2",
                        "НПЮЛ__ИННЮЛ", "НПЮЛ_1__НаимОрг"]
    assert cols[7:10] == ["Актив__СумОтч", "Актив_1__СумПрдщ", "Актив_2__СумПрдшв"]   # 1600 -> 1099, first
    assert "ФинВлож_3__СумОтч" in cols                      # second ФинВлож line (1240) numbered on
    assert not any(c.startswith("Искл") for c in cols)      # 1151 excluded from full reports
    assert cols[-4:] == ["Выруч__СумОтч", "Выруч_1__СумПред", "СебестПрод__СумОтч", "СебестПрод_1__СумПред"]
    simple = [r["column"] for r in R.report_header(dictionary, R.SIMPLE).collect()]
    assert "МатВнеАкт__СумОтч" in simple and "НематАкт__СумОтч" not in simple


def test_flatten_full_aligned(parsed, dictionary):
    w = {r["ИдФайл__xml"] + "/" + r["КНД_1__ОтчетГод"]: r.asDict()
         for r in R.flatten_reports(parsed, dictionary, R.FULL).collect()}
    assert set(w) == {"NO_BUHOT_1/2020", "NO_BUHOT_2/2020", "NO_BUHOT_3/2019", "NO_BUHOT_3/2020", "NO_BUHOT_7/2020"}
    g = w["NO_BUHOT_1/2020"]
    assert g["КНД__Тип"] == "Полная" and g["ДатаДок__ГГГГММДД"] == "31032021" and g["СвНП__ОКВЭД2"] == "6201"
    assert g["НПЮЛ__ИННЮЛ"] == "0700000001" and g["НПЮЛ_1__НаимОрг"] == "A, B"
    assert (g["НематАкт__СумОтч"], g["НематАкт_1__СумПрдщ"], g["НематАкт_2__СумПрдшв"]) == ("1", "2", None)
    assert g["РезИсслед__СумОтч"] is None                   # gap stays in its own column (D-10)
    assert (g["ОснСр__СумОтч"], g["ОснСр_2__СумПрдшв"]) == ("3", "1")
    assert g["ФинВлож__СумОтч"] is None and g["ФинВлож_3__СумОтч"] == "5"  # 1240 sits in ОбА
    assert (g["Выруч__СумОтч"], g["Выруч_1__СумПред"]) == ("7", "5")
    n = w["NO_BUHOT_2/2020"]
    assert n["Актив__СумОтч"] is None and n["Выруч__СумОтч"] == "1"   # absent section null; first repeat
    assert w["NO_BUHOT_3/2019"]["Актив__СумОтч"] == "1" and w["NO_BUHOT_3/2020"]["Актив__СумОтч"] == "2"  # D-12
    assert w["NO_BUHOT_7/2020"]["НПЮЛ_1__НаимОрг"] == "ООО Ромашка"       # cp1251 decoded


def test_kinds_broken_and_fuse(parsed, dictionary):
    kinds = rows(parsed.groupBy("kind").count())
    assert kinds == [("full", 5), ("simplified", 1)]                      # other prefix never parsed
    st = {r["file_name"]: (r["kind"], r["broken"], r["documents"])
          for r in R.report_status(read_xml_reports(parsed.sparkSession, os.path.join(_FOLDER[0], "*.xml"))).collect()}
    assert st["broken.xml"] == ("full", True, 0) and st["other.xml"] == ("unroutable", False, 1)
    assert st["twodocs.xml"] == ("full", False, 2)
    s = R.flatten_reports(parsed, dictionary, R.SIMPLE).first()
    assert s["КНД__Тип"] == "Упрощённая" and s["МатВнеАкт__СумОтч"] == "5" and s["Запасы__СумОтч"] == "6"
    fused = R.fuse_reports(R.flatten_reports(parsed, dictionary, R.FULL), R.flatten_reports(parsed, dictionary, R.SIMPLE))
    assert fused.count() == 6 and "МатВнеАкт__СумОтч" in fused.columns and "НематАкт__СумОтч" in fused.columns


def test_long_form_keeps_repeats_and_round_trips(parsed, dictionary):
    long = R.xml_to_long(parsed, dictionary, R.FULL)
    rep = rows(long.where("file_id = 'NO_BUHOT_2'"), "element", "rep", "attr", "value")
    assert rep == [("Выруч", 0, "СумОтч", "1"), ("Выруч", 0, "СумПред", "2"),
                   ("Выруч", 1, "СумОтч", "100"), ("Выруч", 1, "СумПред", "200")]
    # property: long -> wide (first repeat) gives the flattened values
    from pyspark.sql import functions as F
    names = {(code, element, attr): column for column, attr, code, element in R.header_columns(dictionary, R.FULL)}
    keyed = long.where("rep = 0").withColumn("column", F.create_map(
        *[x for k, v in names.items() for x in (F.lit("|".join(map(str, k))), F.lit(v))])[
        F.concat_ws("|", F.col("code").cast("string"), "element", "attr")])
    wide = R.long_to_wide(keyed, ["file_id", "doc_no"], "column", "value", list(names.values()))
    flat = R.flatten_reports(parsed, dictionary, R.FULL)
    for r in wide.where("file_id = 'NO_BUHOT_1'").collect():
        f = flat.where("`ИдФайл__xml` = 'NO_BUHOT_1'").first()
        assert all(r[c] == f[c] for c in names.values())


def test_header_in_memory_equals_the_header_table(dictionary):
    for kind in (R.FULL, R.SIMPLE):
        table = [(r["column"], r["attr"], r["code"], r["element"]) for r in
                 R.report_header(dictionary, kind).where("code is not null").orderBy("pos").collect()]
        assert R.header_columns(dictionary, kind) == table


def test_id_of_the_root_tag_wherever_it_stands(spark):
    from pyspark.sql import functions as F
    texts = {"plain": '<Файл ИдФайл="NO_BUHOT_1">', "later": "<Файл a='x>y' b=\"1\"\n ИдФайл = 'NO_BUHOT_2' c=''/>",
             "long": "<!-- " + "ИдФайл=\"no\" " * 2000 + '-->\n<Файл ИдФайл="NO_BOUPR_3">',
             "prolog": '\ufeff<?xml version="1.0"?>\n<!DOCTYPE Файл [<!ENTITY a "b">]>\n<!--x--><Файл ИдФайл="NO_BUHOT_4">',
             "inner": '<Файл><Документ ИдФайл="NO_BUHOT_5"/></Файл>', "none": "", "text": 'ИдФайл="NO_BUHOT_6"'}
    df = spark.createDataFrame(list(texts.items()), "k string, t string")
    got = dict(rows(df.select("k", R.raw_file_id(F.col("t")).alias("i")), "k", "i"))
    assert got == {"plain": "NO_BUHOT_1", "later": "NO_BUHOT_2", "long": "NO_BOUPR_3", "prolog": "NO_BUHOT_4", "inner": "",
                   "none": "", "text": ""}


def test_long_comment_before_the_root(spark, dictionary):
    text = "<!--" + "note " * 2000 + '--><Файл ИдФайл="NO_BUHOT_9">' + doc('<ФинРез><Выруч СумОтч="3"/></ФинРез>') + "</Файл>"
    files = spark.createDataFrame([("a.xml", text)], "file_name string, content string")
    assert R.flatten_reports(R.parse_reports(files), dictionary, R.FULL).first()["Выруч__СумОтч"] == "3"
    assert tuple(R.report_status(files).first()) == ("a.xml", "full", False, 1)


def test_unknown_charset_stops(spark):
    d = tempfile.mkdtemp(prefix="ledgerline-xml-")
    with open(os.path.join(d, "a.xml"), "wb") as f:
        f.write('<?xml version="1.0" encoding="koi8-r"?><Файл ИдФайл="NO_BUHOT_1"/>'.encode("koi8-r"))
    with pytest.raises(Exception, match="unknown charset"):
        read_xml_reports(spark, os.path.join(d, "*.xml")).collect()


def test_flatten_fused_equals_union_of_kinds(parsed, dictionary):
    a = R.flatten_fused(parsed, dictionary)
    b = R.fuse_reports(R.flatten_reports(parsed, dictionary, R.FULL), R.flatten_reports(parsed, dictionary, R.SIMPLE))
    assert a.columns == b.columns and a.count() == b.count() == 6
    assert a.exceptAll(b).count() == 0


def test_pruned_schema_reads_same_values(spark, folder, dictionary):
    files = read_xml_reports(spark, os.path.join(folder, "*.xml"))
    full = R.flatten_reports(R.parse_reports(files), dictionary, R.FULL)
    pruned = R.flatten_reports(R.parse_reports(files, dictionary=dictionary), dictionary, R.FULL)
    assert full.exceptAll(pruned).count() == 0 and pruned.count() == 5


def test_long_to_wide_shuffles_a_row_per_id(spark):
    long = spark.createDataFrame([("a", 0, "x", "1"), ("a", 0, "y", "2"), ("b", 0, "z", "3"), ("a", 0, "x", "1"), (None, 1, "y", "4")],
                                 "file_id string, doc_no int, key string, value string")
    wide = R.long_to_wide(long, ["file_id", "doc_no"], "key", "value", ["x", "y"])
    got = {(r["file_id"], r["doc_no"]): (r["x"], r["y"]) for r in wide.collect()}
    assert got == {("a", 0): ("1", "2"), ("b", 0): (None, None), (None, 1): (None, "4")}
    plan = wide._jdf.queryExecution().sparkPlan().toString()
    assert "pivotfirst" not in plan and plan.count("Aggregate") == 2  # before and after one shuffle


def test_files_keep_every_line_in_order(spark, tmp_path):
    """Lines in any order, twice, with a null amount or a line number of no section; an order that comes twice; null keys."""
    from ledgerline.plans import inputs as I
    spark.sql("""select * from values (5L, 1L, 'O', 2.5D, date'2020-03-01'), (5L, 1L, 'O', 2.5D, date'2020-03-01'), (7L, 2L, 'P', 1D, date'2020-03-01'),
        (null, 3L, 'O', 1D, date'2020-03-01') t(o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate)""").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("""select * from values (5L, 3, 9D, 1D, 0D), (5L, 1, 2D, 1D, 0D), (5L, 1, 2D, 1D, 0D), (5L, 1, 1D, 4D, 0D), (5L, 2, null, 1D, 0D), (5L, 40, 1D, 1D, 0D),
        (5L, null, 1D, 1D, 0D), (7L, 7, 1D, 2D, 3D), (7L, 4, 1D, 2D, 3D), (null, 1, 1D, 1D, 1D)
        t(l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_tax)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = rows(I.report_files(spark, str(tmp_path)).where("content is not null"), "file_name", "content")
    assert [n for n, _ in got] == ["report_5.xml", "report_5.xml", "report_7.xml"]
    line = '<{} СумОтч="{}" СумПрдщ="{}" СумПрдшв="{}"/>'.format
    short_term = "".join([line("ОценОбяз", "1.00", "4.00", "0.00"), *[line("ОценОбяз", "2.00", "1.00", "0.00")] * 2, line("ДоходБудущ", "9.00", "1.00", "0.00")])
    full, short = got[0][1], got[2][1]
    assert full == got[1][1] and full.split("</Документ>")[0].split("</СвНП>")[1] == (
        '<Баланс><Актив СумОтч="2.50"><ВнеОбА></ВнеОбА><ОбА></ОбА></Актив><Пассив СумОтч="2.50"><КапРез></КапРез><ДолгосрОбяз></ДолгосрОбяз>'
        f'<КраткосрОбяз>{short_term}</КраткосрОбяз></Пассив></Баланс><ФинРез><Выруч СумОтч="2.50" СумПред="1"/></ФинРез>')
    assert short.split("</Документ>")[0].split("</СвНП>")[1] == (
        f'<Баланс><Актив СумОтч="1.00">{line("ДенежнСр", "1.00", "2.00", "3.00")}</Актив><Пассив СумОтч="1.00"></Пассив></Баланс>'
        '<ФинРез><Выруч СумОтч="1.00" СумПред="2"/><ЧистПрибУб СумОтч="1.00" СумПред="2.00"/></ФинРез>')
