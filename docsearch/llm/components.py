"""Connected components of a link table: smallest label, with doubling of the reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsearch.llm.common import written

#: Ways over which the members of one label are dealt when labels are looked up.
SALTS = 16


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node reachable) for every end of ``links`` (a, b longs).

    Each round takes the least label among the neighbours and then the label of
    that label, so a chain of n links takes about log n rounds. A round is
    written to the shared folder. Nodes are expected to have few links each; a
    label may have any number of members, which are dealt over salts.
    """
    both = written(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter("a <> b").distinct(), "links")
    labels = written(
        both.groupBy("a").agg(F.min("b").alias("b"))
        .select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    before = None
    while True:
        total = labels.agg(F.sum(F.col("label").cast("decimal(20,0)")).alias("s")).first()["s"]
        if total == before:
            return labels
        before = total
        heard = both.join(labels, both["b"] == labels["node"]).select(
            F.col("a").alias("node"), "label")
        nearest = labels.union(heard).groupBy("node").agg(F.min("label").alias("label"))
        nearest = written(nearest, "labels")
        upper = nearest.filter("label <> node").select(
            F.col("node").alias("label"), F.col("label").alias("up"),
            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        labels = written(
            nearest.withColumn("salt", F.pmod(F.hash("node"), F.lit(SALTS)))
            .join(upper, ["label", "salt"], "left")
            .select("node", F.coalesce("up", "label").alias("label")), "labels")
