"""The dictionary as a tree of shared beginnings: its edges as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forespell.functions import common_prefix
from forespell.operators.prepare import number_rows
from forespell.plans.prefixes import distinct_prefixes, exploded_for, keyed_entries, profile_queries, reduce_by_prefix
from forespell.session import cut_lineage


def neighbours_share(keyed: DataFrame) -> DataFrame:
    """``shared``: what each key has in common with the next one in sorted order.

    Keys meet their neighbours inside the partitions of one range exchange. The last key of
    a partition meets the first of the next one that has any: one row a partition.
    """
    numbered = number_rows(keyed.select("key"), [F.col("key")])
    following = F.lead("key").over(Window.partitionBy("part").orderBy("row"))
    firsts = numbered.filter(F.col("row") == 0)
    later = firsts.select("part", F.lead("key").over(Window.orderBy("part")).alias("_later"))
    paired = numbered.withColumn("_next", following).join(F.broadcast(later), "part")
    paired = paired.withColumn("_next", F.coalesce("_next", "_later")).filter(F.col("_next").isNotNull())
    return paired.select(common_prefix(F.col("key"), F.col("_next")).alias("shared"))


def prefix_edges(dictionary: DataFrame, case_sensitive: bool = True) -> DataFrame:
    """``parent, label, matches, max_weight, ends``: one row for each edge of the tree.

    Nodes are the empty prefix, every prefix at which entries part ways, and every entry;
    beginnings with a single continuation are merged into one label. ``parent`` is the
    node above, ``label`` what follows it down to the node below, ``matches`` and
    ``max_weight`` are over the entries that start with both, and ``ends`` says whether an
    entry is just that. The root has no edge.

    Entries part ways where neighbours in sorted order do. Parents and counts are found by
    equality, at the lengths of the prefixes at which entries part, which are far fewer
    than the lengths of the entries.
    """
    keyed = keyed_entries(dictionary, case_sensitive).select("key", "weight")
    forks = neighbours_share(keyed).union(keyed.sparkSession.createDataFrame([("",)], "shared STRING")).distinct()
    forks = cut_lineage(forks.withColumnRenamed("shared", "prefix"))
    distinct = distinct_prefixes(forks)
    profile = profile_queries(distinct)

    def counted(exploded: DataFrame) -> DataFrame:
        return exploded.groupBy("prefix").agg(
            F.count("*").alias("matches"), F.max("weight").alias("max_weight"), F.bool_or(F.col("key") == F.col("prefix")).alias("ends")
        )

    inner = reduce_by_prefix(keyed, distinct, profile, counted).select(F.col("prefix").alias("key"), "matches", "max_weight", "ends")
    # an entry at which none part is a node of its own
    alone = keyed.join(forks.select(F.col("prefix").alias("key")), "key", "left_anti")
    leaves = alone.groupBy("key").agg(F.count("*").alias("matches"), F.max("weight").alias("max_weight")).withColumn("ends", F.lit(True))
    nodes = inner.unionByName(leaves)
    above = exploded_for(nodes.select("key"), distinct, profile).filter(F.length("prefix") < F.length("key"))
    wanted = distinct.select("prefix")
    met = above.join(F.broadcast(wanted) if profile.broadcasts() == 1 else wanted.hint("shuffle_merge"), "prefix")
    parents = met.groupBy("key").agg(F.max_by("prefix", F.length("prefix")).alias("parent"))
    label = F.expr("substring(key, length(parent) + 1)")
    return parents.join(nodes, "key").select("parent", label.alias("label"), "matches", "max_weight", "ends")
