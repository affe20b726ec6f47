"""Issue XML to one row per article."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.functions.naming import prefixed_id
from broadsheet.functions.shape import computed
from broadsheet.functions.text import clean_label, collapse_ws, text_length
from broadsheet.schemas import ARTICLE_COLUMNS, ISSUE_DDL

PARSED = "PARSED"
EMPTY = "EMPTY"
BAD_XML = "BAD_XML"
NO_DOCUMENT = "NO_DOCUMENT"

# Private-use characters stand in for escaped angle brackets while real tags are removed.
_LT, _GT = "\ue000", "\ue001"


def _without_cdata(xml: Column) -> Column:
    """Literal sections as escaped text; an unclosed one stays, and the parse rejects it."""

    def one(part: Column, i: Column) -> Column:
        end = F.instr(part, "]]>")
        inside = F.replace(F.substring(part, F.lit(1), end - 1), F.lit("&"), F.lit("&amp;"))
        return (
            F.when(i == 0, part)
            .when(end == 0, F.concat(F.lit("<![CDATA["), part))
            .otherwise(F.concat(F.translate(inside, "<>", _LT + _GT), F.substring(part, end + 3, F.length(part))))
        )

    parts = F.split(xml, r"<!\[CDATA\[")
    return F.when(F.contains(xml, F.lit("<![CDATA[")), F.array_join(F.transform(parts, one), "")).otherwise(xml)


def _parse(xml: Column) -> Column:
    guarded = F.regexp_replace(_without_cdata(xml), "&(?:lt|#0*60|#[xX]0*3[cC]);", _LT)
    guarded = F.regexp_replace(guarded, "&(?:gt|#0*62|#[xX]0*3[eE]);", _GT)
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_corrupt_record",
        "ignoreSurroundingSpaces": "false",
    }
    return F.from_xml(guarded, ISSUE_DDL, options)


def _plain(text: Column) -> Column:
    """Markup-free text: nested tags removed, escaped brackets restored."""
    return _restored(F.regexp_replace(text, "<[^>]+>", ""))


def _restored(text: Column) -> Column:
    return F.translate(text, _LT + _GT, "<>")


def parse_issues(issues: DataFrame) -> DataFrame:
    """Parse (domid, xml) once per issue; adds ``status`` and a flat ``articles`` array.

    Pages count through the issue and articles count within their page, both from 1. A page
    without articles still counts.
    """
    parsed = computed(issues, ["domid"], [_parse(F.col("xml")).alias("r")])
    per_page = F.transform(
        "r.page",
        lambda page, p: F.transform(
            page["article"],
            lambda article, a: F.struct(
                (p + 1).alias("page_i"), (a + 1).alias("article_i"), article.alias("a")
            ),
        ),
    )
    # Flatten yields NULL if any page holds NULL, so pages without articles are filtered first.
    articles = F.flatten(F.filter(per_page, lambda page: page.isNotNull()))
    status = (
        F.when(F.col("r").isNull() | F.col("r._corrupt_record").isNotNull(), BAD_XML)
        .when(F.coalesce(F.size("articles"), F.lit(0)) <= 0, EMPTY)
        .otherwise(PARSED)
    )
    return computed(parsed, ["domid", "r"], [articles.alias("articles")]).select(
        "domid",
        status.alias("status"),
        F.col("r.id").alias("issue_id"),
        F.col("r.dw").alias("issue_dw"),
        F.col("r.newspaperID").alias("issue_newspaper"),
        "articles",
    )


def explode_articles(parsed: DataFrame, id_prefix: str) -> DataFrame:
    """One row per article of the issues that parsed, without the manifest's attributes."""
    # An issue that failed or is empty has no articles array to expand, so only the generated
    # rows need a test.
    rows = parsed.select(
        "domid", "issue_id", "issue_dw", "issue_newspaper", F.inline_outer("articles")
    ).where(F.col("page_i").isNotNull())
    local_id = clean_label(_restored(F.col("a.id")))
    content = collapse_ws(_plain(F.array_join(F.coalesce("a.text", F.array().cast("array<string>")), "")))
    return rows.select(
        "domid",
        prefixed_id(local_id, id_prefix).alias("id"),
        local_id.alias("article_id_s"),
        clean_label(_plain(F.col("a.ti"))).alias("article_title_s"),
        clean_label(_plain(F.col("a.ct"))).alias("article_type_s"),
        clean_label(F.col("a.ocr._VALUE")).try_cast("double").alias("article_ocr_quality_td"),
        _restored(F.col("a.ocr._relevant")).alias("article_ocr_relevant_s"),
        content.alias("content"),
        "page_i",
        "article_i",
        clean_label(_restored(F.col("issue_dw"))).alias("issue_day_of_week_s"),
        clean_label(_restored(F.col("issue_id"))).alias("issue_id_s"),
        clean_label(_restored(F.col("issue_newspaper"))).alias("newspaper_id_s"),
    ).withColumn("article_text_length_ti", text_length(F.col("content")))


def enrich(articles: DataFrame, manifest: DataFrame) -> DataFrame:
    """Put the issue attributes of the manifest onto every article (inner join on domid)."""
    issue = manifest.select(
        "domid",
        F.col("simpletitle").alias("newspaper_title_s"),
        F.col("npid").alias("newspaper_internal_id_s"),
        F.col("originalname").alias("issue_original_filename_s"),
        F.col("domid").try_cast("bigint").alias("issue_domid_l"),
        F.col("pub_date").alias("issue_pub_date_tdt"),
        F.col("digi_date").alias("issue_digi_date_tdt"),
        F.col("year").alias("issue_year_s"),
    )
    return articles.join(issue, "domid").select(*ARTICLE_COLUMNS)


def extract_articles(manifest: DataFrame, issues: DataFrame, id_prefix: str = "") -> DataFrame:
    """Article table of the accepted manifest rows.

    The XML is parsed where it is read and only the extracted text is joined, so the markup,
    most of an issue's bytes, never crosses the network.
    """
    return enrich(explode_articles(parse_issues(issues), id_prefix), manifest)


def issue_status(manifest: DataFrame, parsed: DataFrame) -> DataFrame:
    """(domid, status, n_articles) per accepted manifest row, also for issues not found."""
    outcome = parsed.select(
        "domid",
        "status",
        F.when(F.col("status") == PARSED, F.size("articles")).otherwise(0).alias("n_articles"),
    )
    return (
        manifest.select("domid")
        .join(outcome, "domid", "left")
        .select(
            "domid",
            F.coalesce("status", F.lit(NO_DOCUMENT)).alias("status"),
            F.coalesce("n_articles", F.lit(0)).cast("bigint").alias("n_articles"),
        )
    )


def missing_issues(manifest: DataFrame, issues: DataFrame) -> DataFrame:
    """Manifest rows for which no document exists."""
    return manifest.join(issues.select("domid"), "domid", "left_anti")
