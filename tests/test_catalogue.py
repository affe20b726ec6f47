from __future__ import annotations

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import charset, marc
from broadsheet.operators import catalogue as cat
from broadsheet.schemas import MARC_SCHEMA
from broadsheet.sources import marc as marc_source
from broadsheet.sources.marc import assemble_marc


def field(tag, *subs, ind1=" ", ind2=" ", data=None):
    return (tag, ind1, ind2, data, [tuple(s.split("=", 1)) for s in subs])


def record(spark, *fields, leader="00000nam a2200000 a 4500"):
    return spark.createDataFrame([("r", leader, [field("001", data="r1"), *fields])], MARC_SCHEMA)


def value(df, text):
    return df.select((F.expr(text) if isinstance(text, str) else text).alias("v")).first().v


def test_choice_notation():
    (a, b, c) = marc.choices("700[gk-m]:300aa:008[35-37]")
    assert (a.tag, a.codes, a.joined) == ("700", ("g", "k", "l", "m"), True)
    assert (b.codes, b.joined) == (("a",), True)
    assert (c.codes, c.span) == ((), (35, 37))
    assert marc.choices("050a[0]")[0] == marc.Choice("050", ("a",), False, (0, 0))


def test_values_single_joined_and_missing(spark):
    df = record(spark, field("650", "a=Tea", "x=Trade", "a=Milk"), field("650", "z=Kent"))
    assert value(df, marc.values("650a")) == ["Tea", "Milk"]
    assert value(df, marc.values("650ax")) == ["Tea Trade Milk"]
    assert value(df, marc.values("651a")) == [] and value(df, marc.first(marc.values("651a"))) is None


def test_titles_and_alternate_script(spark):
    df = record(
        spark,
        field("245", "a=The  post :", "b=daily /", ind2="4"),
        field("880", "6=245-01/$1", "a=Почта"),
        field("880", "6=100-02", "a=Имя"),
    )
    row = cat.index_fields(df).first()
    assert row.title_t == ["The  post :", "Почта"] and row.title_display == ["The  post"]
    assert row.title_vern_display == ["Почта"] and row.title_sort == " post" and row.id == "r1"
    assert row.text.startswith("The  post : daily / 245-01")


def test_isbn_call_numbers_and_dates(spark):
    df = record(
        spark,
        field("020", "a=0-19 853453 1 (pbk.)", "a=none"),
        field("050", "a=PN4899", "b=.T5 1894"),
        field("260", "c=[1894?]"),
        field("008", data="800101s1799    enk"),
    )
    row = cat.index_fields(df).first()
    assert row.isbn_t == ["0-19 853453 1"] and row.pub_date == "1894"
    assert (row.lc_callnum_display, row.lc_alpha_facet, row.lc_b4cutter_facet) == ("PN4899 .T5 1894", "PN", "PN4899")
    assert value(record(spark, field("260", "c=n.d."), field("008", data="800101s1799")), marc.publication_year()) == "1799"
    assert value(record(spark), marc.publication_year()) is None


def test_links(spark):
    df = record(
        spark,
        field("856", "u=a", ind1="4", ind2="0"),
        field("856", "u=b", "z=Sample text here", ind1="4", ind2="1"),
        field("856", "u=c", ind1="4", ind2="1"),
        field("856", "u=d", ind1="4", ind2="2"),
        field("856", "u=e", ind1="1", ind2="0"),
        field("856", "3=Table of Contents", "u=f", ind1="4", ind2="0"),
    )
    assert value(df, marc.link_urls(True)) == ["a", "c", "f"] and value(df, marc.link_urls(False)) == ["b", "d"]


@pytest.mark.parametrize(
    "leader, f007, simple, detailed",
    [
        ("am", ["cr"], "Book", "eBook"),
        ("am", [], "Book", "Book"),
        ("am", ["zz", "vf", "ad"], "Book", "VideoCassette"),
        ("am", ["ad"], "Book", "Atlas"),
        ("am", ["ta"], "Book", "Book"),
        ("as", [], "Serial", "Serial"),
        ("cm", [], "Musical Score", "MusicalScore"),
        ("xx", [], "Unknown", "Unknown"),
        ("mm", ["c0"], "Computer File", "CDROM"),
        ("mm", ["cz"], "Computer File", "Software"),
    ],
)
def test_formats(spark, leader, f007, simple, detailed):
    df = record(spark, *[field("007", data=v) for v in f007], leader=f"00000n{leader} a22")
    assert (value(df, cat.simple_format()), value(df, cat.detailed_format())) == (simple, detailed)


def test_serial_kinds_and_electronic(spark):
    def serial(code):
        return value(record(spark, field("008", data=" " * 21 + code), leader="00000nas"), cat.detailed_format())

    assert [serial(c) for c in "npx"] == ["Newspaper", "Journal", "Serial"]
    df = record(spark, field("245", "h=electronic resource"), field("007", data="ad"))
    assert value(df, cat.detailed_format()) == "Electronic"
    assert value(df, cat.format_label(F.lit("VideoDisc"))) == "DVD"


def test_dewey_instruments_eras(spark):
    df = record(spark, field("082", "a=332/.09/41", "a=x12", "a=12"), field("048", "a=ka01", "a=zz"), field("045", "a=w5w9", "a=x"))
    assert value(df, marc.dewey_text()) == ["332.09 41"] and value(df, marc.dewey_classes()) == ["300", "330"]
    assert value(df, cat.instruments()) == ["Piano"] and value(df, cat.composition_eras()) == ["1850's", "20th Century"]
    assert len(cat.ERAS) == 56 and cat.ERAS["g"] == "3rd Century" and cat.ERAS["y"] == "21th Century"


def test_dictionaries_drop_or_pass(spark):
    df = record(spark, field("008", data=" " * 35 + "eng"), field("041", "a=fre", "a=???", "d=eng"))
    langs = spark.createDataFrame([("eng", "English"), ("fre", "French"), ("???", None)], "key string, label string")
    assert cat.language_facet(df, langs).first().language_facet == ["English", "French"]
    numbers = spark.createDataFrame([("DJK45",), ("DJ1",), ("D5",), ("Q1",)], "n string")
    classes = spark.createDataFrame([("DJK", "x"), ("DJ", "y"), ("D", "z")], "key string, label string")
    got = {r.n: r.class_label for r in cat.class_label(numbers, "n", classes).collect()}
    assert got == {"DJK45": "x", "DJ1": "y", "D5": "z", "Q1": "Q1"}


def test_assembly_leaves_out_malformed_records(spark):
    cols = "record_id string, leader string, field_no int, tag string, ind1 string, ind2 string, data string, sub_no int, code string, value string"
    rows = [
        ("a", "L", 1, "001", None, None, "a", 0, None, None),
        ("a", "L", 2, "245", "1", "0", None, 2, "b", "two"),
        ("a", "L", 2, "245", "1", "0", None, 1, "a", "one"),
        ("b", "L", 1, "245", "1", "0", None, 1, "a", "no key"),
        ("c", "L", 1, "001", None, None, "c", 0, None, None),
        ("c", "L", 2, "24", "1", "0", None, 1, "a", "bad tag"),
        (None, "L", 1, "001", None, None, "x", 0, None, None),
    ]
    (r,) = assemble_marc(spark.createDataFrame(rows, cols)).collect()
    assert r.record_id == "a" and [f.tag for f in r.fields] == ["001", "245"]
    assert [(s.code, s.value) for s in r.fields[1].subfields] == [("a", "one"), ("b", "two")]


def test_long_dictionary_keys_and_records_without_codes(spark):
    classes = spark.createDataFrame([("M", "music"), ("MLCME", "minor level")], "key string, label string")
    numbers = spark.createDataFrame([("MLCME 12",), ("MLC",)], "n string")
    got = {r.n: r.class_label for r in cat.class_label(numbers, "n", classes).collect()}
    assert got == {"MLCME 12": "minor level", "MLC": "music"}
    langs = spark.createDataFrame([("eng", "English")], "key string, label string")
    assert cat.language_facet(record(spark, field("041", "a=xxx")), langs).first().language_facet == []


def test_medium_contains_the_words(spark):
    for medium, want in (("[electronic resource] :", "Electronic"), ("text", "Book")):
        df = record(spark, field("245", f"h={medium}"))
        assert df.select(cat.detailed_format().alias("f")).first().f == want


def encoded(text):
    """A text in the older set: marks before their letter, as characters below 256."""
    marks = {chr(m): chr(b) for b, m in charset.MARKS.items()}
    letters = {v: chr(k) for k, v in charset.LETTERS.items()}
    out, wait = [], []
    for c in reversed(unicodedata.normalize("NFD", text)):
        if c in marks:
            wait.append(marks[c])
        else:
            out.append("".join(reversed(wait)) + letters.get(c, c))
            wait = []
    return "".join(reversed(out))


def test_escape_coded_texts_become_composed(spark):
    texts = ["plain", "", "Größe", "São Paulo, naïve café", "Łódź", "Đặng Việt Nam", "ấ ậ", "ǖ ǻ", "x̌ ẋ̣", "Æsir £5 ©", "ſ".replace("ſ", "s"), "a" * 3000 + "é"]
    rows = [(i, encoded(t)) for i, t in enumerate(texts)]
    assert rows[2][1] == "Gr\xe8o\xc7e" and rows[6][1].startswith("\xe3\xe2a")
    df = spark.createDataFrame(rows + [(99, None)], "id int, t string")
    got = {r.id: r.d for r in df.select("id", charset.decode_escaped(F.col("t")).alias("d")).collect()}
    assert got.pop(99) is None
    for i, text in enumerate(texts):
        assert got[i].mapped and got[i].text == unicodedata.normalize("NFC", text), text


def test_marks_are_composed_as_by_the_standard(spark):
    draw = random.Random(1)
    marks = sorted(charset.MARKS)
    rows = []
    for i in range(400):
        own = draw.sample(marks, draw.randint(0, 3))
        rows.append((i, "".join(map(chr, own)) + draw.choice("aeiouAOUncsyz1")))
    df = spark.createDataFrame(rows, "id int, t string")
    for r in df.select("t", charset.decode_escaped(F.col("t")).alias("d")).collect():
        want = unicodedata.normalize("NFC", r.t[-1] + "".join(chr(charset.MARKS[ord(c)]) for c in r.t[:-1]))
        assert r.d.text == want and r.d.mapped, (r.t, r.d.text, want)


def test_escapes_and_what_cannot_be_mapped(spark):
    cases = {
        "x\x1bp2\x1bs y": ("x² y", True), "H\x1bb2\x1b(BO": ("H₂O", True), "\x1bga\x1bs ray": ("α ray", True), "a\x1b)!Eb": ("ab", True),
        "\x1b(NABC\x1b(B": (None, False), "\x1b$1!3*": (None, False), "a\xff": (None, False), "a\xe2": (None, False), "\x1bpx": (None, False), "a\x1b": (None, False),
        "\xe4\xbd \xf2\xac": ("ữ Ợ", True),
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    for r in df.select("t", charset.decode_escaped(F.col("t")).alias("d")).collect():
        text, mapped = cases[r.t]
        assert r.d.mapped == mapped and (not mapped or r.d.text == text), r


def test_records_are_rejected_in_whole(spark):
    rows = [
        ("1", "00000nam  2200000", None, "caf\xe2e"), ("1", "00000nam  2200000", "x", None), ("2", "00000nam  2200000", None, "fine"),
        ("2", "00000nam  2200000", "bad\xff", None), ("3", "00000nam a2200000", None, "café \xff"), ("4", None, None, "\xc7"),
    ]
    good, bad = marc_source.split_by_charset(spark.createDataFrame(rows, "record_id string, leader string, data string, value string"))
    assert {(r.record_id, r.data, r.value) for r in good.collect()} == {("1", None, "café"), ("1", "x", None), ("3", None, "café \xff"), ("4", None, "ß")}
    assert [tuple(r) for r in bad.collect()] == [("2", "BAD_CHARSET")]
