"""Allow or block URLs: by rules, and elsewhere by gradient-boosted trees on lexical features.

Rules (host, path) fit a host and its subdomains where the URL's path begins with the rule's;
the longest fitting rule wins (of equally long ones the first listed). URLs that a rule decides
are the labelled ones. Of these a bounded sample (``SAMPLE`` distinct URLs of each verdict, by
hash, weighted back to the verdict's number of URLs) trains a boosted ensemble of the
machine-learning library on lengths, depth, digit ratio, entropy, parameter counts and the share
of blocked URLs under the host's suffixes. These shares, and the overall one, count all distinct
labelled URLs. Everything else runs over all URLs with built-in functions and the library's own
transformers.

Cases: a null URL or one without ``://`` has an empty host and path, fits no rule and is judged
by its (empty) features; without any labelled URL, or with one verdict only, the rest gets that
verdict, or ``allow``; repeated rows are judged alike; other columns are not read; an empty
table gives no rows. The rule list is a parameter and small; suffix shares grow with the corpus,
so they are joined to the distinct hosts, and these to the URLs, without a hint.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.functions.shape import let
from broadsheet.llm.work import stored

ALLOW, BLOCK = "allow", "block"
SAMPLE = 10_000
TREES, DEPTH = 20, 4
SMOOTHING = 20.0  # weight of the overall share in a suffix's share
SUFFIXES = (1, 2, 3)  # labels of the host's end
FEATURES = (
    "url_length host_length path_length host_labels depth digit_ratio entropy parameters query_length "
    "fragment escapes hyphens longest_label"
).split()


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty for a null or without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The text of the longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(rule.text)).otherwise(out)
    return out


def lexical(url: Column, host: Column, path: Column) -> list[Column]:
    """The columns of ``FEATURES``."""
    text = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    count = lambda pattern, of=text: F.length(of) - F.length(F.regexp_replace(of, pattern, ""))

    def entropy(chars: Column) -> Column:
        n = F.size(chars).cast("double")
        share = lambda c: F.size(F.filter(chars, lambda x: x == c)) / n
        return F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda s, c: s - let(share(c), lambda p: p * F.log2(p)))

    values = [
        F.length(text),
        F.length(host),
        F.length(path),
        F.when(host == "", 0).otherwise(F.size(labels)),
        F.size(F.filter(F.split(path, "/"), lambda x: x != "")),
        F.when(F.length(text) > 0, count("[0-9]") / F.length(text)).otherwise(0.0),
        let(F.filter(F.split(text, ""), lambda c: c != ""), entropy),
        F.size(F.filter(F.split(query, "&"), lambda x: x != "")),
        F.length(query),
        F.contains(text, F.lit("#")).cast("int"),
        count("%"),
        count("-"),
        F.coalesce(F.array_max(F.transform(labels, F.length)), F.lit(0)),
    ]
    return [v.cast("double").alias(name) for name, v in zip(FEATURES, values)]


def suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def candidates(labelled: DataFrame, counts: dict[float, float]) -> DataFrame:
    """Somewhat over ``SAMPLE`` URLs of each label, those of the least hashes, cut without a shuffle.

    ``counts``: how many URLs there are of each label. Hashes are even, so that under a threshold
    six standard deviations above ``SAMPLE`` lie the ``SAMPLE`` least ones.
    """
    wanted = SAMPLE + 6 * math.sqrt(SAMPLE)
    few = F.lit(False)
    for label, count in counts.items():
        least = F.lit(True) if count <= wanted else F.xxhash64("url") <= int(wanted / count * 2**64) - 2**63
        few = few | ((F.col("label") == label) & least)
    return labelled.where(few)


def judged(pages: DataFrame, rules: Sequence[Rule], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, block_probability) of each page."""
    base = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"))
    base = base.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    base = base.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict_of = F.lit(None).cast("string")
    for rule in rules:
        verdict_of = F.when(F.col("rule") == rule.text, rule.verdict).otherwise(verdict_of)
    base = base.withColumn("told", verdict_of)
    labelled = stored(
        base.where("told is not null")
        .select("url", "host", "path", (F.col("told") == BLOCK).cast("double").alias("label"))
        .distinct(),
        "urls",
    )
    rows, blocked = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not rows or blocked in (0, rows):
        rest = F.lit(1.0 if rows and blocked == rows else 0.0)
        scored = base.withColumn("block_probability", rest)
    else:
        share = blocked / rows
        order = Window.partitionBy("label").orderBy(F.xxhash64("url"), "url")
        weight = F.when(F.col("label") == 1, max(1.0, blocked / SAMPLE)).otherwise(max(1.0, (rows - blocked) / SAMPLE))
        few = candidates(labelled, {0.0: rows - blocked, 1.0: blocked})
        sample = few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE).withColumn("weight", weight)
        ends = F.explode(F.array_distinct(F.array(*[suffix(F.col("host"), k) for k in SUFFIXES])))
        shares = (
            labelled.select(ends.alias("suffix"), "label")
            .groupBy("suffix")
            .agg(((F.sum("label") + SMOOTHING * share) / (F.count("*") + SMOOTHING)).alias("share"))
        )
        shares = stored(shares, "suffixes")
        hosts = base.select("host").distinct()
        for k in SUFFIXES:
            own = shares.select(F.col("suffix").alias(f"suffix_{k}"), F.col("share").alias(f"share_{k}"))
            hosts = hosts.withColumn(f"suffix_{k}", suffix(F.col("host"), k)).join(own, f"suffix_{k}", "left")
            hosts = hosts.withColumn(f"share_{k}", F.coalesce(f"share_{k}", F.lit(share))).drop(f"suffix_{k}")
        hosts = stored(hosts, "hosts")

        def featured(df: DataFrame, *keep: str) -> DataFrame:
            out = df.join(hosts, "host")
            of_host = [f"share_{k}" for k in SUFFIXES]
            out = out.select(*keep, "host", *lexical(F.col("url"), F.col("host"), F.col("path")), *of_host)
            return VectorAssembler(inputCols=[*FEATURES, *of_host], outputCol="features").transform(out).select(*keep, "host", "features")

        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=5, checkpointInterval=-1, weightCol="weight")
        model = trees.fit(stored(featured(sample, "label", "weight").drop("host"), "examples"))
        scored = model.transform(featured(base, "page_id", "url", "path", "rule", "told"))
        scored = scored.withColumn("block_probability", vector_to_array(F.col("probability"))[1])
    verdict = F.coalesce("told", F.when(F.col("block_probability") >= 0.5, BLOCK).otherwise(ALLOW))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "block_probability")
