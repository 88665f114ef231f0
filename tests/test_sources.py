import gzip
import hashlib
import io
import zipfile

import pytest

from lexmill.functions.okuri import INFLECTIONS
from lexmill.operators import export, merge
from lexmill.sources import catalog, files, planned

DICTIONARY = """;; okuri-ari entries.
あk /開/欠;note/
かか /x/
#k /1/
;; okuri-nasi entries.
さかみち /坂道;memo/坂路/
か#い /#1回/
あk /x/
ゆうひ /(concat "a/b")/夕日/[夕/夕べ/]/
べ/x/
ね /#0/猫/
"""


def write(path, data: bytes):
    path.write_bytes(data)
    return str(path)


@pytest.mark.parametrize("encoding", ["utf-8", "euc_jp", "euc_jis_2004"])
def test_keyed(spark, tmp_path, encoding):
    rows = files.read_keyed(spark, write(tmp_path / "d", DICTIONARY.encode(encoding)), encoding).orderBy("rank").collect()
    assert [(r["kind"], r["reading"], r["surface"], r["scope"]) for r in rows if r["counter"] is None] == [
        ("ari", "あk", "開", "skk"), ("ari", "あk", "欠", "skk"), ("nasi", "さかみち", "坂道", "all"), ("nasi", "さかみち", "坂路", "all"), ("nasi", "ゆうひ", "夕日", "skk"), ("nasi", "ね", "猫", "all"),
    ]
    counted = {}
    for r in rows:
        if r["counter"]:
            counted[r["counter"]] = counted.get(r["counter"], 0) + 1
    assert counted == {"skk_okuri_entry": 1, "skk_malformed_entry": 2, "skk_template_entry": 3, "skk_expression_entry": 1, "skk_expression_candidate": 5, "skk_special_candidate": 1}


def test_keyed_without_headers_is_nasi(spark, tmp_path):
    assert [r["kind"] for r in files.read_keyed(spark, write(tmp_path / "d", "あ /亜/\n".encode())).collect()] == ["nasi"]


XML = """<?xml version="1.0"?><!DOCTYPE JMdict [<!ENTITY v5k "Godan verb with 'ku' ending"><!ENTITY sK "search-only kanji form"><!ENTITY exp "expressions">]>
<JMdict><entry><k_ele><keb>開く</keb><ke_pri>news1</ke_pri><ke_pri>nf01</ke_pri></k_ele><k_ele><keb>あく</keb><ke_inf>&sK;</ke_inf></k_ele>
<r_ele><reb>あく</reb><re_pri>news1</re_pri></r_ele><r_ele><reb>ショ</reb><re_nokanji/></r_ele><r_ele><reb>アク</reb><re_restr>開く</re_restr><re_pri>gai1</re_pri></r_ele><sense><pos>&v5k;</pos></sense></entry>
<entry><r_ele><reb>あ</reb></r_ele><sense><pos>&exp;</pos></sense></entry></JMdict>"""


def test_xml(spark, tmp_path):
    path = write(tmp_path / "d.gz", gzip.compress(XML.encode()))
    rows, counted = catalog.read(spark, {"id": "jmdict", "format": "jmdict", "path": path})
    got = {(r["reading"], r["surface"], r["kind"], r["scope"], "|".join(r["pri"] or []), "|".join(r["inf"] or [])) for r in rows.collect()}
    assert got == {
        ("あく", "開く", "nasi", "all", "news1", ""), ("あく", "あく", "nasi", "migemo", "", "sK"), ("ショ", "ショ", "nasi", "all", "", ""), ("アク", "開く", "nasi", "all", "gai1|news1|nf01", ""), ("あ", "あ", "nasi", "all", "", ""),
        ("あk", "開", "ari", "skk", "news1", ""), ("あi", "開", "ari", "skk", "news1", ""),
    }
    assert {(r["metric"], r["n"]) for r in counted.collect()} == {("jmdict_search_only_pair", 1), ("okuri_generated", 2)}
    assert {r["pos"] for r in rows.where("kind = 'ari'").collect()} == {"okuri-rule|v5k|あく|開く"}
    assert "v5k" in INFLECTIONS


def archive(members: dict[str, bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def line(surface, reading, cost=100, left=1, part="動詞", conj="五段-カ行", form="終止形-一般", normal=None, lemma="1"):
    return f'"{surface}",{left},{left},{cost},"{surface}",{part},一般,*,*,{conj},{form},{reading},{normal or surface},{lemma},*,*,*,*'


def test_analyser(spark, tmp_path):
    text = "\n".join([line("開く", "アク"), line("開い", "アイ", form="連用形-イ音便", normal="開く"), line(r"\u{20BB7}", "ヨシ", 0, part="名詞", conj="*", form="*", lemma="*"), line("散る", "アカル", 0, left=-1, lemma="9")])
    rows, _ = catalog.read(spark, {"id": "sudachi-small", "format": "sudachi", "path": write(tmp_path / "z", archive({"small_lex.csv": text.encode()}))})
    assert {(r["reading"], r["surface"], r["kind"], r["scope"], r["cost"]) for r in rows.collect()} == {
        ("アク", "開く", "nasi", "all", 100), ("アイ", "開い", "nasi", "migemo", 100), ("ヨシ", "𠮷", "nasi", "all", 0), ("アカル", "散る", "nasi", "all", 0), ("あk", "開", "ari", "skk", 100), ("あi", "開", "ari", "skk", 100),
    }
    for bad in ({"a_lex.csv": b"", "b_lex.csv": b""}, {"a_lex.csv": b"1,2\n"}):
        with pytest.raises(Exception, match="needed"):
            files.read_analyser(spark, write(tmp_path / "bad", archive(bad))).collect()


def test_tab_separated(spark, tmp_path):
    path = write(tmp_path / "c", "けん\t1\t2\t300\t剣\nけん\t1\t2\t200\t剣\nあ\t1\t1\t5\t亜\tSPELLING\n".encode())
    rows, counted = catalog.read(spark, {"id": "mozc", "format": "mozc", "path": path})
    assert [r["cost"] for r in merge.least_costs(rows).collect()] == [200] and counted.collect()[0]["n"] == 1
    with pytest.raises(Exception, match="word cost"):
        files.read_word_costs(spark, write(tmp_path / "e", b"a\t1\t2\tx\tb\n")).collect()
    path = write(tmp_path / "k.gz", gzip.compress("a\t月_(天体)\tlink\t7\nother-x\t月_(天体)\texternal\t5\n".encode()))
    rows, _ = catalog.read(spark, {"id": "clicks", "format": "clickstream", "path": path})
    assert [(r["surface"], r["clicks"]) for r in merge.total_clicks(rows).collect()] == [("月 (天体)", 12)]
    with pytest.raises(Exception, match="click line"):
        files.read_clicks(spark, write(tmp_path / "f", b"a\tb\tbad\t7\n")).collect()
    rows, _ = catalog.read(spark, {"id": "t", "format": "reading-tsv", "path": write(tmp_path / "t", "あ\t亜\nい\t胃\n".encode())})
    assert {(r["reading"], r["surface"], r["pos"]) for r in rows.collect()} == {("あ", "亜", "materialized vocabulary"), ("い", "胃", "materialized vocabulary")}
    with pytest.raises(Exception, match="pair line"):
        files.read_pairs(spark, write(tmp_path / "u", b"a\tb\tc\n")).collect()


def workbook(rows) -> bytes:
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cell = lambda c, k, v: f'<c r="{c}{k}" t="s"><v>{v}</v></c>' if isinstance(v, int) else f'<c r="{c}{k}" t="inlineStr"><is><t>{v}</t></is></c>'
    body = "".join(f"<row>{''.join(cell(c, k, v) for c, v in row.items())}</row>" for k, row in enumerate(rows, 1))
    shared = f"<sst {ns}><si><t>出現形</t></si><si><r><t>腫</t></r><r><t>瘍</t></r></si></sst>"
    return archive({"xl/sharedStrings.xml": shared.encode(), "xl/worksheets/sheet1.xml": f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>".encode()})


def test_workbooks(spark, tmp_path):
    book = workbook([{"A": 0, "C": "出現形よみ"}, {"A": 1, "C": "しゅよう"}, {"A": "熱", "C": "-1"}, {"C": "ねつ"}])
    rows, counted = catalog.read(spark, {"id": "jmed", "format": "jmed", "path": write(tmp_path / "z", archive({"d/x_mini.xlsx": book}))})
    assert {(r["reading"], r["surface"], r["pos"]) for r in rows.collect()} == {("しゅよう", "腫瘍", "x_mini"), ("ねつ", "", "x_mini")} and counted.collect()[0]["n"] == 1
    with pytest.raises(Exception, match="no workbook"):
        files.read_workbooks(spark, write(tmp_path / "b", archive({"a.txt": b""}))).collect()


def test_two_copies_are_kept_and_exported_once(spark, tmp_path):
    data = "さかみち /坂道/坂道/\nゆうひ /夕日/\n".encode()
    path = write(tmp_path / "d", data)
    pinned = {"format": "skk", "path": path, "sha256": hashlib.sha256(data).hexdigest()}
    rows, _ = catalog.read_all(spark, [{"id": "one", **pinned}, {"id": "two", **pinned}])
    merged = merge.entries(rows)
    assert merged.count() == 4 and [tuple(r) for r in export.reading_pairs(merged, ["one", "two"]).collect()] == [("さかみち", "坂道"), ("ゆうひ", "夕日")]
    with pytest.raises(ValueError, match="checksum"):
        catalog.read(spark, {"id": "one", **pinned, "sha256": "0"})
    with pytest.raises(ValueError, match="unknown format"):
        catalog.read(spark, {"id": "one", "format": "x", "path": path})
    with pytest.raises(ValueError, match="unknown sources: a, b"):
        catalog.select([{"id": "one"}], ["b", "a"])


def test_tab_pairs(spark, tmp_path):
    rows = files.read_tab_pairs(spark, write(tmp_path / "d", 'あ\t"亜\tx"\nい\t\n'.encode())).orderBy("rank").collect()
    assert [(r["reading"], r["surface"]) for r in rows] == [("あ", '"亜\tx"'), ("い", "")]
    with pytest.raises(Exception, match="a pair line has a tab"):
        files.read_tab_pairs(spark, write(tmp_path / "e", "あ 亜\n".encode())).collect()


def test_entities_of_a_document_type():
    head = b"""<?xml version="1.0"?><!DOCTYPE d [<!ELEMENT d ANY><!ENTITY % p "no"><!ENTITY a 'it&#39;s "a"'><!ENTITY b "b &amp; c"><!ENTITY c "b &amp; c">]><d>&a;</d>"""
    assert planned.xml_head(io.BytesIO(head).read)[2] == {"it's \"a\"": "a", "b &amp; c": "b"} and planned.xml_head(io.BytesIO(b"<d/>").read) == (b"<d/>", "d", {}, b"")


def test_brackets_in_candidate_lists(spark):
    rows = ["a/(b (c/d)/e/f)/g", "[x/y/]/z", "a(b/c)/(d/[e/)/f", "(a)/(/)/]/b"]
    df = spark.createDataFrame([(k, r.split("/")) for k, r in enumerate(rows)], "k int, f array<string>")
    got = {r["k"]: r["b"] for r in df.select("k", files.bracketed(df["f"]).alias("b")).collect()}
    assert got == {0: [False, True, True, True, True, False], 1: [True, True, True, False], 2: [False, False, True, True, True, False], 3: [True, True, True, False, False]}


def test_generated_rows_have_ranks_of_their_own(spark, tmp_path):
    xml = """<?xml version="1.0"?><!DOCTYPE d [<!ENTITY v1 "one"><!ENTITY v5r "five">]><d><entry><k_ele><keb>着る</keb></k_ele><r_ele><reb>きる</reb></r_ele><sense><pos>&v1;</pos><pos>&v5r;</pos></sense></entry></d>"""
    rows, _ = catalog.read(spark, {"id": "jmdict", "format": "jmdict", "path": write(tmp_path / "d", xml.encode())})
    made = rows.where("kind = 'ari'").orderBy("rank").collect()
    assert len({r["rank"] for r in made}) == len(made) > 4 and min(r["rank"] for r in made) > 1 << 59
    classes = [r["pos"].split("|")[1] for r in made]
    assert classes == sorted(classes) and set(classes) == {"v1", "v5r"}


def test_newest_month(spark):
    listing = spark.createDataFrame([("2026-05", "x-2026-05.gz"), ("2026-06", "x-2026-06.gz"), ("2026-07", "y"), ("2026-08", "y")], "month string, file string")
    assert catalog.newest_month(listing, "x-{month}.gz") == "2026-06"
    with pytest.raises(ValueError, match="newest 2 months"):
        catalog.newest_month(listing, "x-{month}.gz", tries=2)
