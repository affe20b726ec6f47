"""The given tables seen as manifests, issues, articles, catalogue records and activity.

Everything here is derived by Spark from the tables, row by row and without shuffles (the
manifest's header lines apart), so its volume grows with them. Some papers' exports are
damaged on purpose, to give the reject paths work in proportion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.schemas import MANIFEST_COLUMNS

UNTERMINATED = "src13"
SHORT_NAME = "src17"
NOT_DELIVERED = "src5"
BROKEN_XML = "src6"
LINES_PER_PAGE = 5


def _quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(value.cast("string"), F.lit('"'), F.lit('\\"')), F.lit('"'))


def _issue_date() -> Column:
    return F.date_add(F.lit("1800-01-01").cast("date"), F.pmod("doc_id", F.lit(30000)).cast("int"))


def manifest_values() -> list[Column]:
    day = F.date_format(_issue_date(), "yyyy-MM-dd")
    name = F.when(F.col("source") == SHORT_NAME, "SRC17-1899.xml").otherwise(
        F.concat(F.upper("source"), F.lit("-"), day, F.lit(".xml"))
    )
    second = F.lpad(F.pmod("doc_id", F.lit(60)).cast("string"), 2, "0")
    return [
        F.col("doc_id").cast("string"),
        F.concat(F.lit("u"), F.col("doc_id").cast("string")),
        F.lit("NULL"),
        F.concat(F.lit('The "'), F.col("source"), F.lit('" Times, daily')),
        F.lit("10"),
        name,
        F.col("n_chars").cast("string"),
        F.concat(F.lit("2010-08-27 11:09:"), second, F.lit(".7")),
        F.col("doc_id").cast("string"),
    ]


def manifest_lines(documents: DataFrame) -> DataFrame:
    """One quoted line per document, and a header line per paper."""
    line = F.concat_ws(",", *[_quoted(v) for v in manifest_values()])
    damaged = F.when(F.col("source") == UNTERMINATED, F.expr("substring(line, 1, length(line) - 1)")).otherwise(F.col("line"))
    rows = documents.select("source", line.alias("line")).select(damaged.alias("value"))
    header = ",".join(f'"{c}"' for c in MANIFEST_COLUMNS)
    headers = documents.select("source").distinct().select(F.lit(header).alias("value"))
    return rows.unionByName(headers)


def manifest_lines_ctrl_a(documents: DataFrame) -> DataFrame:
    return documents.select(F.concat_ws("\x01", *manifest_values()).alias("value"))


def _escape(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def issue_xml(documents: DataFrame) -> DataFrame:
    """(domid, xml): a document as an issue, its lines as articles, five to a page.

    White space is inflated, words are wrapped in tags and each article has two texts.
    """
    doc = F.col("doc_id").cast("string")

    def article(item: Column) -> Column:
        body = F.replace(_escape(item["line"]), F.lit(" "), F.lit(" \n\t"))
        n = item["n"].cast("string")
        return F.concat(
            F.lit("<article><id>"), doc, F.lit("-"), n, F.lit("</id>"),
            F.lit("<ti>\n Item "), n, F.lit("\nof &quot;"), doc, F.lit("&quot; </ti>"),
            F.lit("<ct>"), F.col("lang"), F.lit("</ct>"),
            F.lit('<ocr relevant="'), F.when(F.col("n_chars") > 1000, "yes").otherwise("no"), F.lit('"> 0.'),
            F.lpad(F.pmod("doc_id", F.lit(100)).cast("string"), 2, "0"), F.lit(" </ocr>"),
            F.lit('<text>\n <wd pos="1">'), body, F.lit("</wd> </text><text> &lt;end&gt;\t</text></article>"),
        )

    items = F.transform(F.split("text", "\n"), lambda line, i: F.struct(line.alias("line"), (i + 1).alias("n")))
    pages = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("items") - 1) / LINES_PER_PAGE).cast("int")),
        lambda p: F.concat(
            F.lit("<page>"),
            F.array_join(F.transform(F.slice("items", p * LINES_PER_PAGE + 1, F.lit(LINES_PER_PAGE)), article), ""),
            F.lit("</page>"),
        ),
    )
    xml = F.concat(
        F.lit("<issue><id>I"), doc, F.lit("</id><dw> "), F.date_format(_issue_date(), "EEEE"), F.lit(" </dw>"),
        F.lit("<newspaperID>"), F.col("source"), F.lit("</newspaperID>"),
        F.array_join("pages", ""),
        F.when(F.col("source") == BROKEN_XML, "<page>").otherwise("</issue>"),
    )
    return (
        documents.where(F.col("source") != NOT_DELIVERED)
        .withColumn("items", items)
        .withColumn("pages", pages)
        .select(doc.alias("domid"), xml.alias("xml"))
    )


def articles(documents: DataFrame) -> DataFrame:
    """Documents as an article table: the first line is the title."""
    return documents.select(
        F.col("doc_id").alias("id"),
        F.substring_index("text", "\n", 1).alias("article_title_s"),
        F.col("text").alias("content"),
        F.col("lang").alias("article_type_s"),
        F.col("source").alias("newspaper_title_s"),
        F.year(_issue_date()).cast("string").alias("issue_year_s"),
        _issue_date().cast("timestamp").alias("issue_pub_date_tdt"),
        F.col("n_chars").cast("int").alias("article_text_length_ti"),
    )


ARTICLES_SQL = """(SELECT doc_id AS id, string_split(text, chr(10))[1] AS article_title_s,
 text AS content, lang AS article_type_s, source AS newspaper_title_s,
 CAST(year(DATE '1800-01-01' + CAST(doc_id % 30000 AS INTEGER)) AS VARCHAR) AS issue_year_s,
 DATE '1800-01-01' + CAST(doc_id % 30000 AS INTEGER) AS issue_pub_date,
 CAST(n_chars AS INTEGER) AS article_text_length_ti FROM documents)"""


def bookmarks(events: DataFrame) -> DataFrame:
    """Clicks and purchases as bookmarks; the document id is the event's ``k``."""
    return events.where(F.col("event_type").isin("click", "purchase")).select(
        F.col("user_id").cast("int").alias("user_id"),
        F.lit("User").alias("user_type"),
        F.get_json_object("props", "$.k").alias("document_id"),
        F.col("event_type").alias("title"),
        F.lit("Article").alias("document_type"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
    )


def searches(events: DataFrame) -> DataFrame:
    """Views as searches; the props are the query's parameters."""
    return events.where(F.col("event_type") == "view").select(
        F.col("event_id").alias("search_id"),
        F.col("props").alias("query_params"),
        F.col("user_id").cast("int").alias("user_id"),
        F.lit("User").alias("user_type"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
    )


def users(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").cast("int").alias("user_id"),
        F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email"),
        F.pmod("c_nationkey", F.lit(9)).cast("int").alias("sign_in_count"),
        (F.col("c_mktsegment") == "HOUSEHOLD").alias("guest"),
    )


def _field(tag: str, ind1: str = " ", ind2: str = " ", data: Column | None = None, subs: list[tuple[str, Column]] = ()) -> Column:
    subfields = (
        F.array(*[F.struct(F.lit(c).alias("code"), v.cast("string").alias("value")) for c, v in subs])
        if subs
        else F.array().cast("array<struct<code:string,value:string>>")
    )
    return F.struct(
        F.lit(tag).alias("tag"),
        F.lit(ind1).alias("ind1"),
        F.lit(ind2).alias("ind2"),
        (F.lit(None).cast("string") if data is None else data.cast("string")).alias("data"),
        subfields.alias("subfields"),
    )


def _letter(n: Column, alphabet: str) -> Column:
    return F.substring(F.lit(alphabet), F.pmod(n, F.lit(len(alphabet))).cast("int") + 1, F.lit(1))


def marc_records(part: DataFrame) -> DataFrame:
    """Parts as catalogue records, with the fields the mapping rules read."""
    key, size = F.col("p_partkey"), F.col("p_size")
    text = key.cast("string")
    brand = F.substring_index("p_brand", "#", -1)
    colour, thing = F.substring_index("p_name", " ", 1), F.substring_index("p_name", " ", -1)
    record_type = (
        F.when(F.col("p_type") == "STANDARD", "am")
        .when(F.col("p_type") == "ECONOMY", "as")
        .when(F.col("p_type") == "MEDIUM", "ja")
        .when(F.col("p_type") == "PROMO", "xx")
        .when(F.col("p_type") == "LARGE", "ea")
        .otherwise("ca")
    )
    year = (F.lit(1800) + size).cast("string")
    serial = F.when(size < 20, "n").when(size < 40, "p").otherwise(" ")
    fixed = F.concat(
        F.lit("800101s"), year, F.lit("    xx    "), serial, F.lit("             "),
        F.concat(F.lit("l"), F.lpad(brand, 2, "0")), F.lit("  "),
    )
    physical = F.when(size % 5 == 0, F.concat(_letter(size, "sdkvgm"), _letter(size, "cdfxs"))).when(size % 5 == 1, "cr").otherwise("zz")
    dewey = F.concat(F.lpad((size * 17).cast("string"), 3, "0"), F.lit("/."), brand)
    fields = F.array(
        _field("001", data=F.concat(F.lit("p"), text)),
        _field("007", data=physical),
        _field("008", data=fixed),
        _field("020", subs=[("a", F.concat(F.lit("0-"), F.lpad(text, 8, "0"), F.lit(" (pbk.)")))]),
        _field("041", subs=[("a", F.concat(F.lit("l"), F.lpad(size.cast("string"), 2, "0")))]),
        _field("045", subs=[("a", F.concat(_letter(size, "aevwx"), F.pmod(key, F.lit(10)).cast("string")))]),
        _field("048", subs=[("a", F.concat(_letter(size, "bkswz"), _letter(key, "abcu"), F.lit("01")))]),
        _field("050", " ", "4", subs=[("a", F.concat(_letter(size, "ABCPQ"), _letter(key, "ANRX"), text)), ("b", F.concat(F.lit(".X"), brand))]),
        _field("082", subs=[("a", dewey)]),
        _field("100", "1", subs=[("a", F.concat(F.initcap(thing), F.lit(", ."), brand, F.lit(","))), ("d", F.concat(year, F.lit("-")))]),
        _field(
            "245", "1", "4",
            subs=[
                ("a", F.concat(F.lit("The "), F.initcap("p_name"), F.lit(" /"))),
                ("b", F.concat(F.lit("a study of "), thing, F.lit(" :"))),
                ("h", F.when(F.col("p_type") == "SMALL", "[electronic resource] :").otherwise("text")),
            ],
        ),
        _field("260", subs=[("a", F.concat(F.lit("Town "), brand, F.lit(" :"))), ("c", F.when(size < 25, F.concat(F.lit("c"), year, F.lit("."))).otherwise("n.d."))]),
        _field("300", subs=[("a", F.concat(size.cast("string"), F.lit(" p. ;"))), ("a", F.lit("1 map :"))]),
        _field("650", " ", "0", subs=[("a", F.concat(thing, F.lit("."))), ("x", F.lit("History")), ("y", F.concat(year, F.lit(","))), ("z", F.concat(F.lit("Land "), brand, F.lit(";")))]),
        _field("650", " ", "0", subs=[("a", F.concat(colour, F.lit(" /")))]),
        _field("856", "4", "0", subs=[("u", F.concat(F.lit("http://full/"), text))]),
        _field("856", "4", "1", subs=[("3", F.when(size < 30, "Table of contents").otherwise("Volume")), ("u", F.concat(F.lit("http://other/"), text))]),
        _field("856", "4", "2", subs=[("u", F.concat(F.lit("http://about/"), text))]),
        _field("880", "1", "0", subs=[("6", F.lit("245-01")), ("a", F.reverse("p_name"))]),
    )
    leader = F.concat(F.lit("00000n"), record_type, F.lit(" a2200000 a 4500"))
    return part.select(text.alias("record_id"), leader.alias("leader"), fields.alias("fields"))
