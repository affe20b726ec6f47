"""Catalogue record mapping, code dictionaries and currency conversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.functions import marc
from broadsheet.operators import catalogue as cat, currency as cur
from broadsheet.plans import bindings as bind
from broadsheet.plans.registered.registry import Tables, query

# The record fields of bindings.marc_records, said again in SQL over the part table.
_P = """p AS (SELECT *, CAST(p_partkey AS VARCHAR) AS k, string_split(p_brand, '#')[2] AS brand,
  string_split(p_name, ' ')[1] AS colour, string_split(p_name, ' ')[2] AS thing, CAST(1800 + p_size AS VARCHAR) AS yr FROM part)"""


def _pick(n: str, letters: str) -> str:
    return f"substr('{letters}', CAST({n} % {len(letters)} AS INTEGER) + 1, 1)"


_ID = "'p' || k AS id"
_CALL = f"{_pick('p_size', 'ABCPQ')} || {_pick('p_partkey', 'ANRX')} || k"
_F007 = f"CASE p_size % 5 WHEN 0 THEN {_pick('p_size', 'sdkvgm')} || {_pick('p_size', 'cdfxs')} WHEN 1 THEN 'cr' ELSE 'zz' END"
_TITLE = "concat_ws(' ', upper(colour[1]) || colour[2:], upper(thing[1]) || thing[2:])"


def _one_row(t: Tables, *columns):
    return bind.marc_records(t.part).select(cat.first_value("001").alias("id"), *columns)


def _joined(column, name: str):
    return F.array_join(column, "|").alias(name)


@query(
    "catalogue_titles",
    f"""WITH {_P} SELECT {_ID}, 'The ' || {_TITLE} || ' /|' || reverse(p_name) AS title_t, 'The ' || {_TITLE} AS title_display,
     reverse(p_name) AS title_vern_display, 'a study of ' || thing || ' :' AS subtitle_t, 'a study of ' || thing AS subtitle_display,
     'The ' || {_TITLE} || ' / a study of ' || thing || ' :|' || reverse(p_name) AS title_addl_t, lower({_TITLE}) AS title_sort FROM p""",
)
def catalogue_titles(t: Tables):
    fields = cat.index_fields(bind.marc_records(t.part))
    arrays = ["title_t", "title_display", "title_vern_display", "subtitle_t", "subtitle_display", "title_addl_t"]
    return fields.select("id", *[_joined(F.col(c), c) for c in arrays], "title_sort")


@query(
    "catalogue_authors",
    f"""WITH {_P} SELECT {_ID}, upper(thing[1]) || thing[2:] || ', .' || brand || ', ' || yr || '-' AS author_display,
     lower(thing || ', .' || brand || ', ' || yr || '-') AS author_sort,
     upper(thing[1]) || thing[2:] || ', .' || brand || ',' AS author_t, '' AS author_vern_display, '' AS author_addl_t FROM p""",
)
def catalogue_authors(t: Tables):
    fields = cat.index_fields(bind.marc_records(t.part))
    arrays = ["author_display", "author_t", "author_vern_display", "author_addl_t"]
    return fields.select("id", "author_sort", *[_joined(F.col(c), c) for c in arrays])


@query(
    "catalogue_subjects",
    f"""WITH {_P} SELECT {_ID}, thing || '.|' || colour || ' /' AS subject_t, 'History ' || yr || ', Land ' || brand || ';' AS subject_addl_t,
     thing || '.|' || colour AS subject_topic_facet, yr AS subject_era_facet, 'Land ' || brand AS subject_geo_facet FROM p""",
)
def catalogue_subjects(t: Tables):
    fields = cat.index_fields(bind.marc_records(t.part))
    arrays = ["subject_t", "subject_addl_t", "subject_topic_facet", "subject_era_facet", "subject_geo_facet"]
    return fields.select("id", *[_joined(F.col(c), c) for c in arrays])


@query(
    "catalogue_publication",
    f"""WITH {_P} SELECT {_ID}, 'Town ' || brand AS published_display, '' AS published_vern_display, yr AS pub_date,
     p_size || ' p. ; 1 map' AS material_type_display, '0-' || lpad(k, 8, '0') AS isbn_t,
     {_CALL} || ' .X' || brand AS lc_callnum_display, {_CALL} AS lc_b4cutter_facet,
     {_pick('p_size', 'ABCPQ')} || {_pick('p_partkey', 'ANRX')} AS lc_alpha_facet FROM p""",
)
def catalogue_publication(t: Tables):
    fields = cat.index_fields(bind.marc_records(t.part))
    arrays = ["published_display", "published_vern_display", "material_type_display", "isbn_t"]
    return fields.select("id", *[_joined(F.col(c), c) for c in arrays], "pub_date", "lc_callnum_display", "lc_b4cutter_facet", "lc_alpha_facet")


@query(
    "catalogue_links",
    f"""WITH {_P} SELECT {_ID}, 'http://full/' || k || CASE WHEN p_size < 30 THEN '' ELSE '|http://other/' || k END AS url_fulltext_display,
     CASE WHEN p_size < 30 THEN 'http://other/' || k || '|' ELSE '' END || 'http://about/' || k AS url_suppl_display FROM p""",
)
def catalogue_links(t: Tables):
    fields = cat.index_fields(bind.marc_records(t.part))
    return fields.select("id", _joined(F.col("url_fulltext_display"), "url_fulltext_display"), _joined(F.col("url_suppl_display"), "url_suppl_display"))


@query(
    "catalogue_text",
    f"""WITH {_P} SELECT {_ID}, concat_ws(' ', upper(thing[1]) || thing[2:] || ', .' || brand || ',', yr || '-', 'The ' || {_TITLE} || ' /',
     'a study of ' || thing || ' :', CASE WHEN p_type = 'SMALL' THEN '[electronic resource] :' ELSE 'text' END, 'Town ' || brand || ' :',
     CASE WHEN p_size < 25 THEN 'c' || yr || '.' ELSE 'n.d.' END, p_size || ' p. ;', '1 map :', thing || '.', 'History', yr || ',', 'Land ' || brand || ';',
     colour || ' /', 'http://full/' || k, CASE WHEN p_size < 30 THEN 'Table of contents' ELSE 'Volume' END, 'http://other/' || k, 'http://about/' || k,
     '245-01', reverse(p_name)) AS text FROM p""",
)
def catalogue_text(t: Tables):
    return _one_row(t, F.expr(marc.all_text(100, 900)).alias("text"))


_FORMATS = f"""WITH {_P}, c AS (SELECT *, {_F007} AS f7 FROM p)
    SELECT {_ID}, CASE p_type WHEN 'STANDARD' THEN 'Book' WHEN 'ECONOMY' THEN 'Serial' WHEN 'MEDIUM' THEN 'Musical Recording'
      WHEN 'LARGE' THEN 'Map or Globe' WHEN 'SMALL' THEN 'Musical Score' ELSE 'Unknown' END AS format,
     CASE WHEN p_type = 'SMALL' THEN 'Electronic'
      WHEN f7[1] = 's' THEN CASE f7[2] WHEN 'd' THEN 'SoundDisc' WHEN 's' THEN 'SoundCassette' ELSE 'SoundRecording' END
      WHEN f7[1] = 'd' THEN 'Globe'
      WHEN f7[1] = 'k' THEN CASE f7[2] WHEN 'c' THEN 'Collage' WHEN 'd' THEN 'Drawing' WHEN 'f' THEN 'Print' ELSE 'Photo' END
      WHEN f7[1] = 'v' THEN CASE f7[2] WHEN 'c' THEN 'VideoCartridge' WHEN 'd' THEN 'VideoDisc' WHEN 'f' THEN 'VideoCassette' ELSE 'Video' END
      WHEN f7[1] = 'g' THEN CASE WHEN f7[2] IN ('c', 'd') THEN 'Filmstrip' ELSE 'Slide' END
      WHEN f7[1] = 'm' THEN CASE f7[2] WHEN 'f' THEN 'VideoCassette' ELSE 'MotionPicture' END
      WHEN p_type = 'STANDARD' THEN CASE WHEN f7 = 'cr' THEN 'eBook' ELSE 'Book' END
      WHEN p_type = 'ECONOMY' THEN CASE WHEN p_size < 20 THEN 'Newspaper' WHEN p_size < 40 THEN 'Journal' ELSE 'Serial' END
      WHEN p_type = 'MEDIUM' THEN 'MusicRecording' WHEN p_type = 'LARGE' THEN 'Map' ELSE 'Unknown' END AS detailed_format FROM c"""


@query("catalogue_formats", _FORMATS)
def catalogue_formats(t: Tables):
    return _one_row(t, cat.simple_format().alias("format"), cat.detailed_format().alias("detailed_format"))


_LABELS = ", ".join(f"('{a}', '{b}')" for a, b in cat.FORMAT_LABELS.items())


@query(
    "catalogue_format_labels",
    f"""SELECT id, coalesce(label, detailed_format) AS label FROM ({_FORMATS}) LEFT JOIN (VALUES {_LABELS}) AS l(name, label)
    ON name = detailed_format""",
)
def catalogue_format_labels(t: Tables):
    return _one_row(t, cat.format_label(cat.detailed_format()).alias("label"))


def _languages(t: Tables):
    """Nations as a language dictionary; those of region 3 are to be dropped."""
    label = F.when(F.col("n_regionkey") != 3, F.col("n_name"))
    return t.nation.select(F.concat(F.lit("l"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("key"), label.alias("label"))


_LANGUAGES = f"""WITH {_P}, codes AS (SELECT k, 'l' || lpad(brand, 2, '0') AS code FROM p UNION SELECT k, 'l' || lpad(CAST(p_size AS VARCHAR), 2, '0') FROM p)
    SELECT 'p' || k AS id, coalesce(string_agg(DISTINCT n_name, '|' ORDER BY n_name), '') AS language_facet FROM codes
    LEFT JOIN nation ON code = 'l' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AND n_regionkey <> 3 GROUP BY k"""


@query("catalogue_languages", _LANGUAGES)
def catalogue_languages(t: Tables):
    rows = cat.language_facet(bind.marc_records(t.part), _languages(t))
    return rows.select("id", _joined(F.col("language_facet"), "language_facet"))


_CLASSES = "(VALUES ('A', 'A - General'), ('AN', 'AN - News'), ('B', 'B - Thought'), ('PR', 'PR - Letters'), ('P', 'P - Language')) AS c(key, label)"


def _classes(t: Tables):
    """A small call number class dictionary."""
    rows = [("A", "A - General"), ("AN", "AN - News"), ("B", "B - Thought"), ("PR", "PR - Letters"), ("P", "P - Language")]
    return t.spark.createDataFrame(rows, "key string, label string")


@query(
    "catalogue_letter_facet",
    f"""WITH {_P} SELECT {_ID}, coalesce(label, {_pick('p_size', 'ABCPQ')}) AS lc_1letter_facet
    FROM p LEFT JOIN {_CLASSES} ON key = {_pick('p_size', 'ABCPQ')}""",
)
def catalogue_letter_facet(t: Tables):
    return cat.letter_facet(bind.marc_records(t.part), _classes(t))


@query(
    "call_number_classes",
    f"""WITH {_P}, n AS (SELECT {_ID}, {_CALL} AS number FROM p)
    SELECT id, number, coalesce((SELECT label FROM {_CLASSES} WHERE starts_with(number, key) ORDER BY length(key) DESC LIMIT 1), number) AS class_label FROM n""",
)
def call_number_classes(t: Tables):
    numbers = _one_row(t, cat.first_value("050a").alias("number"))
    return cat.class_label(numbers, "number", _classes(t))


@query(
    "catalogue_dewey",
    f"""WITH {_P}, d AS (SELECT k, brand, lpad(CAST(p_size * 17 AS VARCHAR), 3, '0') AS n FROM p),
    c AS (SELECT k, substr(n, 1, 1) || '00' AS code FROM d UNION SELECT k, substr(n, 1, 2) || '0' FROM d),
    l AS (SELECT k, string_agg(coalesce(n_name, code), '|' ORDER BY coalesce(n_name, code)) AS dewey_facet FROM c
      LEFT JOIN nation ON CAST(n_nationkey * 100 AS VARCHAR) = code GROUP BY k)
    SELECT 'p' || d.k AS id, dewey_facet, n || '.' || brand AS dewey_text FROM d JOIN l ON d.k = l.k""",
)
def catalogue_dewey(t: Tables):
    records = bind.marc_records(t.part)
    classes = t.nation.select((F.col("n_nationkey") * 100).cast("string").alias("key"), F.col("n_name").alias("label"))
    facet = cat.dewey_facet(records, classes).select("id", _joined(F.col("dewey_facet"), "dewey_facet"))
    return facet.join(_one_row(t, _joined(F.expr(marc.dewey_text()), "dewey_text")), "id")


_BK = {"a": ("Horn", "Piano", None, "Violin", "Flute"), "b": ("Trumpet", "Organ", None, "Viola", "Oboe"), "c": ("Cornet", "Harpsichord", None, "Violoncello", "Clarinet"), "u": ("Brass, Unknown", "Keyboard, Unknown", None, "Bowed Strings, Unknown", "Woodwinds, Unknown")}


def _instrument_sql() -> str:
    cases = []
    for letter, labels in _BK.items():
        for first, label in zip("bkxsw", labels):
            if label:
                cases.append(f"WHEN '{first}{letter}' THEN '{label}'")
    cases += ["WHEN 'zu' THEN 'Unknown'"]
    code = f"{_pick('p_size', 'bkswz')} || {_pick('p_partkey', 'abcu')}"
    return f"coalesce(CASE {code} {' '.join(cases)} END, '')"


@query(
    "catalogue_music_codes",
    f"""WITH {_P} SELECT {_ID}, {_instrument_sql()} AS instruments,
     CASE p_size % 5 WHEN 0 THEN 'B.C.' WHEN 1 THEN '1st Century' WHEN 2 THEN (1700 + 10 * (p_partkey % 10)) || '''s'
      WHEN 3 THEN (1800 + 10 * (p_partkey % 10)) || '''s' ELSE (1900 + 10 * (p_partkey % 10)) || '''s' END AS eras FROM p""",
)
def catalogue_music_codes(t: Tables):
    return _one_row(t, _joined(cat.instruments(), "instruments"), _joined(cat.composition_eras(), "eras"))


@query(
    "semantic_records",
    f"""WITH {_P} SELECT {_ID}, 'The ' || {_TITLE} AS title, upper(thing[1]) || thing[2:] || ', .' || brand || ', ' || yr || '-' AS creator,
     replace(language_facet, '|', '; ') AS language, CASE p_type WHEN 'STANDARD' THEN 'Book' WHEN 'ECONOMY' THEN 'Serial' WHEN 'MEDIUM' THEN 'Musical Recording'
      WHEN 'LARGE' THEN 'Map or Globe' WHEN 'SMALL' THEN 'Musical Score' ELSE 'Unknown' END AS format FROM p
     JOIN ({_LANGUAGES}) AS l ON l.id = 'p' || k""",
)
def semantic_records(t: Tables):
    return cat.semantic_record(cat.catalogue_index(bind.marc_records(t.part), _languages(t), _classes(t)))


@query(
    "catalogue_index",
    f"""WITH {_P} SELECT {_ID}, 36 AS n_fields, 'The ' || {_TITLE} AS title_display, language_facet,
     coalesce(c.label, {_pick('p_size', 'ABCPQ')}) AS lc_1letter_facet, lower({_TITLE}) AS title_sort FROM p
     JOIN ({_LANGUAGES}) AS l ON l.id = 'p' || k LEFT JOIN {_CLASSES} ON c.key = {_pick('p_size', 'ABCPQ')}""",
)
def catalogue_index(t: Tables):
    """All fields of a record in one row."""
    rows = cat.catalogue_index(bind.marc_records(t.part), _languages(t), _classes(t))
    return rows.select(
        "id", F.lit(len(rows.columns)).alias("n_fields"), _joined(F.col("title_display"), "title_display"),
        _joined(F.col("language_facet"), "language_facet"), "lc_1letter_facet", "title_sort",
    )


@query(
    "full_records",
    f"""WITH {_P} SELECT {_ID}, k AS record_id, 19 AS n_fields, 'The ' || {_TITLE} || ' /' AS title FROM p""",
)
def full_records(t: Tables):
    """The stored XML value parsed again.

    Parts are short for the time that their parse takes, so they are dealt out by number, not by bytes.
    """
    parts = t.part.repartition(4 * t.spark.sparkContext.defaultParallelism, "p_partkey")
    shown = bind.marc_records(parts).select(cat.first_value("001").alias("id"), cat.full_record().alias("marc_display"))
    shape = "record_id STRING, fields ARRAY<STRUCT<tag: STRING, subfields: ARRAY<STRUCT<code: STRING, value: STRING>>>>"
    back = shown.select("id", F.from_xml("marc_display", shape, {"rowTag": "record"}).alias("r"))
    title = F.filter("r.fields", lambda f: f["tag"].try_cast("int") == 245)[0]["subfields"][0]["value"]
    return back.select("id", "r.record_id", F.size("r.fields").alias("n_fields"), title.alias("title"))


_CODES = "list_value('USD', 'GBP', 'NOK', 'XXX', 'EUR', 'JPY')[CAST(o_custkey % 6 AS INTEGER) + 1]"
_RATES = ", ".join(f"('{a}', '{b}', {r!r})" for a, b, r in cur.RATES)


@query(
    "prices_converted",
    f"""WITH r(a, b, rate) AS (VALUES {_RATES}), o AS (SELECT o_orderkey, o_totalprice, {_CODES} AS code FROM orders),
    f AS (SELECT code, CASE WHEN code = 'EUR' THEN 1.0 ELSE coalesce((SELECT rate FROM r WHERE a = code AND b = 'EUR'),
      1 / (SELECT rate FROM r WHERE a = 'EUR' AND b = code),
      (SELECT CAST(1 AS DOUBLE) / rate FROM r WHERE a = 'USD' AND b = code) * (SELECT rate FROM r WHERE a = 'USD' AND b = 'EUR')) END AS factor
      FROM (SELECT DISTINCT code FROM o))
    SELECT o_orderkey, code, round(o_totalprice * CAST(factor AS DOUBLE), 4) AS converted FROM o JOIN f USING (code)""",
)
def prices_converted(t: Tables):
    codes = F.array(*[F.lit(c) for c in ("USD", "GBP", "NOK", "XXX", "EUR", "JPY")])
    priced = t.orders.select("o_orderkey", "o_totalprice", F.get(codes, F.pmod("o_custkey", F.lit(6)).cast("int")).alias("code"))
    rows = cur.convert(priced, "o_totalprice", "code", "EUR", cur.rates_table(t.spark))
    return rows.select("o_orderkey", "code", F.round("converted", 4).alias("converted"))
