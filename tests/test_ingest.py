from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from broadsheet.functions import naming
from broadsheet.functions.text import clean_label, collapse_ws, natural_key
from broadsheet.operators import counters, extract
from broadsheet.plans.jobs import index_articles, load_shards
from broadsheet.schemas import ARTICLE_COLUMNS
from broadsheet.sources import issues, lookup, manifest, records, sinks

HEADER = '"entityid","entityuid","parentid","simpletitle","contentstreamid","originalname","sizebytes","recordcreated_dt","domid"'


def row(domid="77", title="The Daily Post", name="DYPO-1894-03-05.xml", stamp="2010-08-27 11:09:25.7"):
    return f'"12","uid-1","NULL","{title}","10","{name}","1000","{stamp}","{domid}"'


def lines_of(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def parse(spark, *values):
    return manifest.parse_manifest(lines_of(spark, *values)).collect()


def test_manifest_row_is_typed(spark):
    (r,) = parse(spark, row())
    assert (r.status, r.domid, r.simpletitle, r.npid, r.year) == ("OK", "77", "The Daily Post", "DYPO", "1894")
    assert r.pub_date == dt.datetime(1894, 3, 5)
    assert r.digi_date == dt.datetime(2010, 8, 27, 11, 9, 25, 700000)


def test_header_is_skipped_wherever_it_is(spark):
    rows = parse(spark, row("1"), HEADER, row("2"))
    assert [r.status for r in rows] == ["OK", "HEADER", "OK"]


@pytest.mark.parametrize(
    "line, status",
    [
        (row()[:-1], "BAD_LINE"),
        ('"1","2","3"', "BAD_LINE"),
        ("", "BAD_LINE"),
        (row(name="DYPO-1894.xml"), "BAD_FILENAME"),
        (row(name="DYPO-1894-13-45.xml"), "BAD_FILENAME"),
        (row() + ',"one more"', "OK"),
    ],
)
def test_rejects(spark, line, status):
    (r,) = parse(spark, line)
    assert r.status == status


def test_quotes_inside_fields(spark):
    escaped, doubled = parse(spark, row(title='A \\"B\\", C'), row(title='A ""B"", C'))
    assert escaped.simpletitle == doubled.simpletitle == 'A "B", C'
    assert parse(spark, row(title='A,""B"" ""'))[0].simpletitle == 'A,"B" "'
    empty = row().replace('"NULL"', '""')
    assert parse(spark, empty)[0].simpletitle == "The Daily Post"


def test_manifest_files_and_ctrl_a(spark, tmp_path):
    (tmp_path / "list.csv").write_text(HEADER + "\n" + row("5") + "\n")
    assert [r.domid for r in manifest.accepted(manifest.read_manifest(spark, str(tmp_path / "list.csv"))).collect()] == ["5"]
    (tmp_path / "rows").write_text("\x01".join(row("6").replace('"', "").split(",")) + "\n")
    (r,) = manifest.read_manifest_ctrl_a(spark, str(tmp_path / "rows")).collect()
    assert (r.status, r.domid, r.npid) == ("OK", "6", "DYPO")


ISSUE = """<issue><id> I1 </id><dw>Monday</dw><newspaperID>N9</newspaperID>
<page><article><id>a1</id><ti> First
title </ti><ct>News</ct><ocr relevant="yes"> 0.87 </ocr>
<text>One\t<wd>two</wd>\n  three &amp; &lt;four&gt; &#60;</text><text>five</text></article>
<article><id>a2</id><ti>Empty text</ti><text></text></article></page>
<page/>
<page><article><ti>No id, no text</ti></article></page></issue>"""


def issue_frame(spark, **xml):
    return spark.createDataFrame([(k[1:], v) for k, v in xml.items()], "domid string, xml string")


def test_extraction_rules(spark):
    good = manifest.accepted(manifest.parse_manifest(lines_of(spark, row("1"))))
    rows = extract.extract_articles(good, issue_frame(spark, d1=ISSUE), "pre-").orderBy("page_i", "article_i").collect()
    assert rows[0].__fields__ == ARTICLE_COLUMNS
    first, empty, nameless = rows
    assert first.id == "pre-a1" and first.article_id_s == "a1"
    assert first.article_title_s == "First title" and first.article_type_s == "News"
    assert first.article_ocr_quality_td == 0.87 and first.article_ocr_relevant_s == "yes"
    assert first.content == "One two three & <four> <five"
    assert first.article_text_length_ti == len(first.content)
    assert (first.issue_id_s, first.issue_day_of_week_s, first.newspaper_id_s) == ("I1", "Monday", "N9")
    assert first.issue_domid_l == 1 and first.issue_year_s == "1894" and first.newspaper_internal_id_s == "DYPO"
    assert [(r.page_i, r.article_i) for r in rows] == [(1, 1), (1, 2), (3, 1)]
    assert empty.content == "" and empty.article_text_length_ti == 0
    assert nameless.id is None and nameless.content == "" and nameless.article_ocr_quality_td is None


def test_last_repeated_label_wins_and_labels_in_text_are_text(spark):
    xml = "<i><page><article><id>x</id><id>y</id><text>a <ti>not a title</ti></text></article></page></i>"
    good = manifest.accepted(manifest.parse_manifest(lines_of(spark, row("1"))))
    (r,) = extract.extract_articles(good, issue_frame(spark, d1=xml)).collect()
    assert (r.id, r.article_title_s, r.content) == ("y", None, "a not a title")


def test_job_statuses_rejects_and_upsert_order(spark):
    lines = lines_of(spark, HEADER, row("1"), row("2"), row("3"), row("4"), row("5")[:-1])
    twice = ISSUE.replace("five", "six")
    xml = issue_frame(spark, d1=ISSUE, d2="<issue><page>", d3="<issue><id>I3</id></issue>")
    done = index_articles(lines, xml.unionByName(issue_frame(spark, d6=twice)), "p-")
    assert sorted(r.id for r in done.articles.collect()) == ["p-a1", "p-a2"]
    reasons = sorted(r.reason for r in done.rejects.collect())
    assert reasons == ["BAD_LINE", "BAD_XML", "EMPTY", "NO_DOCUMENT", "NO_ID"]
    assert {r.status: r.n for r in done.status.collect()} == {"GOOD": 3, "FAILED": 0}


def test_same_id_in_two_issues_keeps_the_last(spark):
    lines = lines_of(spark, row("1", stamp="2010-01-01 00:00:00.1"), row("2", stamp="2011-01-01 00:00:00.1"))
    xml = issue_frame(spark, d1=ISSUE, d2=ISSUE.replace("five", "six"))
    done = index_articles(lines, xml)
    assert {r.id: r.content for r in done.articles.collect()}["a1"].endswith("six")


def test_issue_files_are_found_by_address(spark, tmp_path):
    (tmp_path / "41.xml").write_text(ISSUE)
    (tmp_path / "42.xml").write_text("<broken")
    (tmp_path / "other.txt").write_text("x")
    found = {r.domid: r.xml for r in issues.read_issue_xml(spark, str(tmp_path), ".xml").collect()}
    assert found == {"41": ISSUE, "42": "<broken"}
    df = spark.createDataFrame([("41",)], "domid string")
    address = df.select(naming.issue_address(F.col("domid"), "http://store/did/", ".xml").alias("a")).first().a
    assert address == "http://store/did/41.xml"


def test_white_space_rules(spark):
    df = spark.createDataFrame([("\r a \n\t b \rc \r",)], "t string")
    r = df.select(collapse_ws(F.col("t")).alias("c"), clean_label(F.col("t")).alias("l")).first()
    assert r.c == "a b \rc" and r.l == "a  \t b \rc"


def test_natural_order(spark):
    names = ["shard10", "shard2", "shard1", "a12b", "a2", "shard2x", "007", "7"]
    df = spark.createDataFrame([(n,) for n in names], "n string").orderBy(natural_key(F.col("n")), "n")
    assert [r.n for r in df.collect()] == ["007", "7", "a2", "a12b", "shard1", "shard2", "shard2x", "shard10"]


def test_every_id_has_one_shard_in_range(spark):
    df = spark.range(2000).withColumn("s", naming.shard_of(F.col("id"), 4))
    counts = {r.s: r.n for r in df.groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert set(counts) == {0, 1, 2, 3} and min(counts.values()) > 400
    with pytest.raises(ValueError):
        naming.shard_of(F.col("id"), 0)


def test_shards_on_disk_and_counters(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("string").alias("id"))
    got = {r.key: r.n for r in load_shards(df, str(tmp_path / "out"), 4).collect()}
    assert sum(got[str(s)] for s in range(4)) == sum(got[f"TOTAL {s}"] for s in range(4)) == 100
    assert all(got[f"FAILURES {s}"] == 0 for s in range(4))
    assert sorted(p.name for p in (tmp_path / "out").glob("shard=*")) == [f"shard={s}" for s in range(4)]
    assert sinks.read_shards(spark, str(tmp_path / "out")).count() == 100
    sinks.write_status(spark.createDataFrame([("GOOD", 3)], "key string, n bigint"), str(tmp_path / "status"))
    (part,) = (tmp_path / "status").glob("part-*")
    assert part.read_text() == "GOOD\t3\n"


def test_shard_counts_with_failures(spark):
    df = spark.createDataFrame([(0, True), (0, False), (1, None)], "shard int, bad boolean")
    got = {r.key: r.n for r in counters.shard_counts(df, "bad").collect()}
    assert got == {"0": 1, "TOTAL 0": 2, "FAILURES 0": 1, "1": 1, "TOTAL 1": 1, "FAILURES 1": 0}


DOC = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("pages_i", T.IntegerType()),
        T.StructField("tags_ss", T.ArrayType(T.StringType())),
    ]
)


def test_xml_and_json_documents(spark, tmp_path):
    (tmp_path / "add.xml").write_text(
        '<add><doc><field name="id">1</field><field name="pages_i">x</field><field name="tags_ss">a</field>'
        '<field name="tags_ss">b</field></doc><doc><field name="id">2</field><field name="pages_i">7</field></doc></add>'
    )
    rows = {r.id: (r.pages_i, r.tags_ss) for r in records.read_xml_docs(spark, str(tmp_path / "add.xml"), DOC).collect()}
    assert rows == {"1": (None, ["a", "b"]), "2": (7, None)}
    (tmp_path / "d.json").write_text('{"id":"3","pages_i":1,"tags_ss":["z"]}\n')
    (r,) = records.read_json_docs(spark, str(tmp_path / "d.json"), DOC).collect()
    assert (r.id, r.tags_ss) == ("3", ["z"])
    (tmp_path / "d.csv").write_text("id,pages_i\n4,9\n")
    (r,) = records.read_csv_docs(spark, str(tmp_path / "d.csv"), T.StructType(DOC.fields[:2])).collect()
    assert (r.id, r.pages_i) == ("4", 9)


def test_export_long_drops_score_and_nulls(spark):
    df = spark.createDataFrame([("1", ["a", None, "b"], None, 2.5)], "id string, t array<string>, x int, score double")
    got = sorted((r.field, r.value) for r in records.export_long(df, "id").collect())
    assert got == [("id", "1"), ("t", "a"), ("t", "b")]


def test_lookup_and_word_lists(spark, tmp_path):
    (tmp_path / "m").write_text("# note\n\nA = One = 1\n??? = null\nB=Two\n")
    assert {r.key: r.label for r in lookup.read_lookup(spark, str(tmp_path / "m")).collect()} == {
        "A": "One = 1",
        "???": None,
        "B": "Two",
    }
    (tmp_path / "w").write_text("# note\n | all comment\nolla olen  | two words\nja\n")
    words = lookup.read_word_list(spark, str(tmp_path / "w"))
    assert lookup.inline_words(words) == ("ja", "olen", "olla")
    with pytest.raises(ValueError):
        lookup.inline_words(words, limit=2)


def test_literal_sections_and_numeric_references_keep_their_text(spark):
    xml = (
        "<issue><id>I&lt;1</id><dw>M&#x3c;</dw><newspaperID>N</newspaperID><page><article><id>a&lt;1</id><ti>T</ti>"
        '<ocr relevant="&#062;no">1</ocr><text><![CDATA[a < b & c > d]]> &#060;e&#0062; <![CDATA[f]]></text></article></page></issue>'
    )
    good = manifest.accepted(manifest.parse_manifest(lines_of(spark, row("1"))))
    (r,) = extract.extract_articles(good, issue_frame(spark, d1=xml)).collect()
    assert r.content == "a < b & c > d <e> f"
    assert (r.article_id_s, r.article_ocr_relevant_s, r.issue_id_s, r.issue_day_of_week_s) == ("a<1", ">no", "I<1", "M<")
    unclosed = xml.replace("]]></text>", "</text>")
    assert extract.parse_issues(issue_frame(spark, d1=unclosed)).first().status == extract.BAD_XML


def test_issue_files_in_other_encodings(spark, tmp_path):
    from broadsheet.sources.issues import read_issue_xml

    body = "<issue><id>é</id><page><article><id>a</id><text>à</text></article></page></issue>"
    (tmp_path / "1.xml").write_bytes(body.encode())
    (tmp_path / "2.xml").write_bytes(('<?xml version="1.0" encoding="ISO-8859-1"?>' + body).encode("latin-1"))
    (tmp_path / "3.xml").write_bytes(body.encode("latin-1"))
    parsed = {r.domid: (r.status, r.issue_id) for r in extract.parse_issues(read_issue_xml(spark, str(tmp_path), ".xml")).collect()}
    assert parsed == {"1": (extract.PARSED, "é"), "2": (extract.PARSED, "é"), "3": (extract.BAD_XML, None)}


def test_long_digit_runs_keep_their_order(spark):
    one, two = "a" + "1" * 25, "a" + "1" * 24 + "2"
    df = spark.createDataFrame([(two,), ("a" + "9" * 24,), (one,)], "n string")
    assert [r.n for r in df.orderBy(natural_key(F.col("n"))).collect()] == ["a" + "9" * 24, one, two]


def test_only_listed_issue_files_are_read(spark, tmp_path, monkeypatch):
    from broadsheet.sources import issues

    for name in ("1", "2", "3", "10"):
        (tmp_path / f"{name}.xml").write_text(f"<issue><id>{name}</id></issue>")
    (tmp_path / "4.xml.bak").write_text("no issue")
    wanted = lambda *ids: spark.createDataFrame([(i,) for i in ids], "domid string")
    got = issues.read_issue_files(spark, wanted("1", "10", "1", "77", None), str(tmp_path), ".xml")
    assert {r.domid for r in got.collect()} == {"1", "10"}
    assert {f.rsplit("/", 1)[1] for f in got.inputFiles()} == {"1.xml", "10.xml"}
    assert issues.read_issue_files(spark, wanted("77"), str(tmp_path), ".xml").count() == 0
    assert issues.read_issue_files(spark, wanted(), str(tmp_path), ".xml").count() == 0
    # Ids that are no plain names, or too many, cut the whole prefix instead.
    odd = issues.read_issue_files(spark, wanted("2", "*"), str(tmp_path), ".xml")
    assert {r.domid for r in odd.collect()} == {"2"}
    monkeypatch.setattr(issues, "MOST_LISTED", 1)
    assert {r.domid for r in issues.read_issue_files(spark, wanted("2", "3"), str(tmp_path), ".xml").collect()} == {"2", "3"}
