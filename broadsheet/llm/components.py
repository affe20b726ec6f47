"""Connected components of a table of links, with tables as state."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from broadsheet.llm.work import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest vertex reachable from each vertex of a link: (vertex, component).

    Each round takes the least label among neighbours and then follows the label's own label,
    so that distances halve. Labels live in the shared folder between rounds; a round's
    aggregation combines before its shuffle, so a hub is no hot task. Links with a null end
    are ignored; an empty table of links gives no rows.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    both = stored(ends.union(ends.select("b", "a")).distinct(), "links")
    label = stored(
        both.groupBy(F.col("a").alias("vertex")).agg(F.min("b").alias("least")).select(
            "vertex", F.least("vertex", "least").alias("component")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(label.select(F.col("vertex").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("vertex"))
            .agg(F.min("component").alias("near"))
        )
        low = label.join(near, "vertex").select(
            "vertex", "component", F.least("component", "near").alias("low")
        )
        jump = label.select(F.col("vertex").alias("low"), F.col("component").alias("far"))
        step = stored(
            low.join(jump, "low", "left").select(
                "vertex",
                F.least("low", F.coalesce("far", "low")).alias("component"),
                (F.least("low", F.coalesce("far", "low")) < F.col("component")).alias("moved"),
            ),
            "labels",
        )
        label = step.select("vertex", "component")
        if step.where("moved").isEmpty():
            return label
