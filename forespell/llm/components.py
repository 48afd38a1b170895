"""Connected components of a table of links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forespell.session import scratch_path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends here, and nothing is computed twice."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable from each node of ``links`` (a, b: longs).

    Every round the smallest label among a node's neighbours lowers the node's own label
    and that of the node its label names (its root, or on the way there), and then labels
    take their label's label. So whole settled regions hook onto smaller ones, and the
    number of rounds follows the logarithm of the number of nodes (squared at worst; Liu
    and Tarjan's extended connect and shortcut). Labels only fall, and stop when all ends
    of links agree. A node with very many links is one hot key of a join that AQE splits,
    and the minimum is taken before the shuffle. Null ends are ignored.
    """
    usable = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).select("a", "b")
    both = written(usable.union(usable.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        roots = low.filter("label < was").groupBy("was").agg(F.min("label").alias("label")).select(F.col("was").alias("root"), F.col("label").alias("hook"))
        hooked = written(low.join(roots, F.col("node") == F.col("root"), "left").select("node", "was", F.least("label", F.coalesce("hook", "label")).alias("label")), "hooked")
        up = hooked.select(F.col("node").alias("top"), F.col("label").alias("above"))
        jumped = hooked.join(up, F.col("label") == F.col("top"), "left")
        new = jumped.select("node", F.least("label", F.coalesce("above", "label")).alias("label"), (F.least("label", F.coalesce("above", "label")) != F.col("was")).alias("moved"))
        new = written(new, "labels")
        labels = new.select("node", "label")
        if new.filter("moved").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
