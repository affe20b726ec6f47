"""Record shapes: manifest rows, issue documents, articles, catalogue and activity tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: manifest column names, in file order -----------------------------
MANIFEST_COLUMNS = [
    "entityid",
    "entityuid",
    "parentid",
    "simpletitle",
    "contentstreamid",
    "originalname",
    "sizebytes",
    "recordcreated_dt",
    "domid",
]

MANIFEST_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in MANIFEST_COLUMNS])

# Only the elements the article record needs are named, so the parser skips the rest.
ISSUE_DDL = (
    "id STRING, dw STRING, newspaperID STRING, "
    "page ARRAY<STRUCT<article: ARRAY<STRUCT<"
    "id: STRING, ti: STRING, ct: STRING, "
    "ocr: STRUCT<_VALUE: STRING, _relevant: STRING>, "
    "text: ARRAY<STRING>>>>>, "
    "_corrupt_record STRING"
)

ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("article_id_s", T.StringType()),
        T.StructField("article_title_s", T.StringType()),
        T.StructField("article_type_s", T.StringType()),
        T.StructField("article_ocr_quality_td", T.DoubleType()),
        T.StructField("article_ocr_relevant_s", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("article_text_length_ti", T.IntegerType()),
        T.StructField("page_i", T.IntegerType()),
        T.StructField("article_i", T.IntegerType()),
        T.StructField("issue_day_of_week_s", T.StringType()),
        T.StructField("issue_id_s", T.StringType()),
        T.StructField("newspaper_id_s", T.StringType()),
        T.StructField("newspaper_title_s", T.StringType()),
        T.StructField("newspaper_internal_id_s", T.StringType()),
        T.StructField("issue_original_filename_s", T.StringType()),
        T.StructField("issue_domid_l", T.LongType()),
        T.StructField("issue_pub_date_tdt", T.TimestampType()),
        T.StructField("issue_digi_date_tdt", T.TimestampType()),
        T.StructField("issue_year_s", T.StringType()),
    ]
)
ARTICLE_COLUMNS = ARTICLE_SCHEMA.fieldNames()

MARC_SCHEMA = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("leader", T.StringType()),
        T.StructField(
            "fields",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("tag", T.StringType()),
                        T.StructField("ind1", T.StringType()),
                        T.StructField("ind2", T.StringType()),
                        T.StructField("data", T.StringType()),
                        T.StructField(
                            "subfields",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("code", T.StringType()),
                                        T.StructField("value", T.StringType()),
                                    ]
                                )
                            ),
                        ),
                    ]
                )
            ),
        ),
    ]
)

BOOKMARK_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.IntegerType(), False),
        T.StructField("user_type", T.StringType()),
        T.StructField("document_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("document_type", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

SEARCH_SCHEMA = T.StructType(
    [
        T.StructField("query_params", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("user_type", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

USER_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.IntegerType(), False),
        T.StructField("email", T.StringType()),
        T.StructField("sign_in_count", T.IntegerType()),
        T.StructField("current_sign_in_at", T.TimestampType()),
        T.StructField("last_sign_in_at", T.TimestampType()),
        T.StructField("guest", T.BooleanType()),
    ]
)

# ---- fixed values: the suffix of a field name gives its type ------------------------
SUFFIX_TYPES = {
    "_i": "int",
    "_ti": "int",
    "_pi": "int",
    "_l": "bigint",
    "_tl": "bigint",
    "_f": "float",
    "_tf": "float",
    "_d": "double",
    "_td": "double",
    "_coordinate": "double",
    "_dt": "timestamp",
    "_tdt": "timestamp",
    "_s": "string",
    "_t": "string",
    "_b": "boolean",
    "_is": "array<int>",
    "_ls": "array<bigint>",
    "_fs": "array<float>",
    "_ds": "array<double>",
    "_dts": "array<timestamp>",
    "_ss": "array<string>",
    "_txt": "array<string>",
    "_en": "array<string>",
    "_bs": "array<boolean>",
    "_p": "latlon",
    "_c": "currency",
}
