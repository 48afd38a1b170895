"""The heaviest entries of many position ranges, from the maxima of blocks of positions.

Level 0 is the entries by position; a block of level i covers ``fan ** i`` positions and
knows the heaviest entry inside. Any range is a few blocks of each level, and the ``k``
heaviest entries of disjoint blocks lie in the ``k`` blocks with the heaviest maxima. So a
range costs its blocks plus ``k`` blocks opened on each level, however wide it is.

That is for ``k`` above ``LIMIT_PUSHED``. For fewer, what is asked stays one row with an
array, whatever it covers. A range of up to a chunk of positions lies in one of the
overlapping windows of two chunks, and its best entries are sorted out of that window's
row. A wider one is the ends in two windows and, between them, one or two runs of siblings
on each level of a tree whose nodes know their ``n`` heaviest entries.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forespell.plans.prefixes import BROADCAST_ROWS, HOT_COPIES
from forespell.plans.topn import LIMIT_PUSHED, top_n
from forespell.session import cut_lineage

FAN = 256
# Positions of a chunk, rounded up to whole blocks.
CHUNK = 512
# Keys at most that are spread because very many ranges meet them.
HOT_KEYS = 10_000
# A key of a tree: its level above this bit, the parent below it.
_LEVEL_BITS = 48


class BlockMaxima(NamedTuple):
    """Entries by position, and the blocks above them; ``levels[i]`` holds blocks of ``fan ** (i + 1)`` positions."""

    entries: DataFrame
    levels: tuple[DataFrame, ...]
    fan: int


def block_maxima(positioned: DataFrame, fan: int = FAN) -> BlockMaxima:
    """The blocks of a dictionary with ``pos``: ``block, last, first`` (the maximum, ties to the last or first position).

    The first level is one aggregate of the entries, summed where they lie; each further
    one has a ``fan``-th of the rows. Levels end when one block or less than ``fan`` blocks are left.
    """
    if fan < 2:
        raise ValueError("a block holds at least two")
    best = [F.max(F.struct("weight", "pos")).alias("last"), F.max(F.struct("weight", (-F.col("pos")).alias("back"))).alias("first")]
    rows = positioned.select(F.floor(F.col("pos") / fan).alias("block"), "weight", "pos")
    level = cut_lineage(rows.groupBy("block").agg(*best))
    levels = [level]
    while level.count() > fan:
        above = level.select(F.floor(F.col("block") / fan).alias("block"), "last", "first")
        level = cut_lineage(above.groupBy("block").agg(F.max("last").alias("last"), F.max("first").alias("first")))
        levels.append(level)
    return BlockMaxima(positioned, tuple(levels), fan)


def save_block_maxima(maxima: BlockMaxima, path: str) -> None:
    """Store entries and blocks, sorted by position, so that a lookup skips row groups."""
    path = path.rstrip("/")
    maxima.entries.repartitionByRange("pos").sortWithinPartitions("pos").write.mode("overwrite").parquet(f"{path}/level=0")
    for i, level in enumerate(maxima.levels, 1):
        level.repartitionByRange("block").sortWithinPartitions("block").write.mode("overwrite").parquet(f"{path}/level={i}")
    sizes = maxima.entries.sparkSession.range(1).select(F.lit(maxima.fan).alias("fan"), F.lit(len(maxima.levels)).alias("levels"))
    sizes.coalesce(1).write.mode("overwrite").parquet(f"{path}/sizes")


def load_block_maxima(spark: SparkSession, path: str) -> BlockMaxima:
    path = path.rstrip("/")
    sizes = spark.read.parquet(f"{path}/sizes").first()
    levels = tuple(spark.read.parquet(f"{path}/level={i}") for i in range(1, sizes["levels"] + 1))
    return BlockMaxima(spark.read.parquet(f"{path}/level=0"), levels, sizes["fan"])


def _run(low: Column, high: Column) -> Column:
    """The whole numbers from ``low`` to below ``high``."""
    return F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))


def _covering(ranges: DataFrame, levels: int, fan: int) -> DataFrame:
    """Add ``nodes_0`` to ``nodes_<levels>``: the positions and blocks that make up ``lb`` to ``rb``.

    On each level those up to the next whole block and from the last one on; what lies
    between is left to the level above, and the last level takes it all.
    """
    low = [F.expr(f"(cast(lb AS BIGINT) + {fan**i - 1}) div {fan**i}") for i in range(levels + 1)]
    high = [F.expr(f"cast(rb AS BIGINT) div {fan**i}") for i in range(levels + 1)]
    nodes = {f"nodes_{levels}": _run(low[-1], high[-1])}
    for i in range(levels):
        ends = F.concat(_run(low[i], low[i + 1] * fan), _run(high[i + 1] * fan, high[i]))
        nodes[f"nodes_{i}"] = F.when(low[i + 1] < high[i + 1], ends).otherwise(_run(low[i], high[i]))
    return ranges.withColumns(nodes)


class Windows(NamedTuple):
    """Overlapping windows of two chunks: ``at, held, first``, entries by position and the position of the first.

    ``dense`` says that no position is missing or taken twice, so that a place in ``held`` follows from a position.
    """

    rows: DataFrame
    chunk: int
    dense: bool


def chunk_of(maxima: BlockMaxima) -> int:
    """Positions of a chunk: a whole number of blocks of the first level."""
    return maxima.fan * -(-CHUNK // maxima.fan)


def _items(maxima: BlockMaxima, scan: bool) -> DataFrame:
    """``pos, chunk, item``; items in falling order are heaviest first, ties to the last position (``scan``: the first)."""
    place = -F.col("pos") if scan else F.col("pos")
    chunk = F.floor(F.col("pos") / chunk_of(maxima))
    return maxima.entries.filter("pos >= 0").select("pos", chunk.alias("chunk"), F.struct("weight", place.alias("place"), "text").alias("item"))


def _heaviest(items: Column, n: Column | int) -> Column:
    return F.slice(F.sort_array(items, asc=False), F.lit(1), F.lit(n) if isinstance(n, int) else n.cast("int"))


def windows_of(maxima: BlockMaxima, scan: bool = False) -> Windows:
    """The windows of a dictionary; window ``c`` starts with chunk ``c``."""
    at = F.explode(F.array(F.col("chunk") - 1, F.col("chunk")))
    each = _items(maxima, scan).select(at.alias("at"), "pos", "item").filter("at >= 0")
    sorted_ = each.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("pos", "item"))).alias("all"))
    first, size, places = F.col("all")[0]["pos"], F.size("all"), F.col("all")["pos"]
    dense = (F.element_at("all", -1)["pos"] - first + 1 == size) & (F.size(F.array_distinct(places)) == size)
    rows = cut_lineage(sorted_.select("at", F.col("all")["item"].alias("held"), first.alias("first"), dense.alias("dense")))
    return Windows(rows.select("at", "held", "first"), chunk_of(maxima), rows.filter(~F.col("dense")).isEmpty())


def _meet(asked: DataFrame, held: DataFrame) -> DataFrame:
    """Join on ``at``. Keys that very many rows ask for are repeated under salts, and their rows spread over them."""
    heat = asked.groupBy("at").agg(F.count("*").alias("rows")).filter(F.col("rows") > HOT_COPIES)
    hot = heat.orderBy(F.desc("rows")).limit(HOT_KEYS).collect()
    if not hot:
        return asked.join(held, "at")
    salts = asked.sparkSession.createDataFrame([(r["at"], -(-r["rows"] // HOT_COPIES)) for r in hot], "at BIGINT, _hot BIGINT")
    # rand, not a hash of the row: equal ranges must part, too
    salt = F.coalesce(F.floor(F.rand(17) * F.col("_hot")), F.lit(0))
    repeats = F.explode(F.coalesce(F.sequence(F.lit(0).cast("bigint"), F.col("_hot") - 1), F.array(F.lit(0).cast("bigint"))))
    left = asked.join(F.broadcast(salts), "at", "left").withColumn("_salt", salt).drop("_hot")
    right = held.join(F.broadcast(salts), "at", "left").withColumn("_salt", repeats).drop("_hot")
    return left.join(right, ["at", "_salt"]).drop("_salt")


def _inside(windows: Windows) -> Column:
    """The items of ``held`` at ``lb`` to ``rb``.

    For a dense window only functions with generated code are used: the join then passes on
    what was cut out of a window, never a copy of the window for each range.
    """
    if not windows.dense:
        place = lambda item: F.abs(item["place"])
        return F.filter("held", lambda item: (place(item) >= F.col("lb")) & (place(item) < F.col("rb")))
    start = F.greatest("lb", "first")
    length = F.greatest(F.least(F.col("rb"), F.col("first") + F.size("held")) - start, F.lit(0))
    return F.slice("held", (start - F.col("first") + 1).cast("int"), length.cast("int"))


def heaviest_of_narrow(windows: Windows, ranges: DataFrame, n: Column) -> DataFrame:
    """The columns of ``ranges`` (with ``lb, rb``, no further apart than a chunk) and ``best``, the ``n`` heaviest items."""
    asked = ranges.withColumn("at", F.expr(f"lb div {windows.chunk}"))
    met = _meet(asked, windows.rows)
    return met.select(*ranges.columns, _heaviest(_inside(windows), n).alias("best"))


def ranked_items(found: DataFrame, scan: bool = False) -> DataFrame:
    """``best`` as rows: ``rank, pos, text, weight`` after the other columns."""
    kept = [c for c in found.columns if c != "best"]
    # outer: of an inner one the optimiser infers a condition that sorts every array once more
    flat = found.select(*kept, F.posexplode_outer("best").alias("_at", "_item")).filter("_at is not null")
    pos = -F.col("_item.place") if scan else F.col("_item.place")
    return flat.select(*kept, (F.col("_at") + 1).alias("rank"), pos.alias("pos"), "_item.text", "_item.weight")


def _tree(maxima: BlockMaxima, n: int, scan: bool) -> tuple[DataFrame, int]:
    """``at, kids``: siblings by parent, each with its ``n`` heaviest items; and the number of levels.

    The nodes of the lowest level are chunks; those of the highest, no more than ``fan``, have one parent.
    """
    items = _items(maxima, scan)
    chunks = (items.agg(F.max("chunk")).first()[0] or 0) + 1
    level = cut_lineage(items.groupBy(F.col("chunk").alias("node")).agg(_heaviest(F.collect_list("item"), n).alias("best")))
    rows, levels = None, 0
    while True:
        last = chunks <= maxima.fan
        parent = F.lit(0).cast("bigint") if last else F.floor(F.col("node") / maxima.fan)
        kids = level.groupBy(parent.alias("parent")).agg(F.collect_list(F.struct("node", "best")).alias("kids"))
        part = kids.select((F.lit(levels << _LEVEL_BITS) + F.col("parent")).alias("at"), "kids")
        rows = part if rows is None else rows.union(part)
        levels += 1
        if last:
            return rows, levels
        level = kids.select(F.col("parent").alias("node"), _heaviest(F.flatten(F.col("kids")["best"]), n).alias("best"))
        chunks = -(-chunks // maxima.fan)


def heaviest_of_wide(maxima: BlockMaxima, windows: Windows, ranges: DataFrame, n: int, scan: bool = False) -> DataFrame:
    """``range, best`` of each (``range, lb, rb, n``) row, wider than a chunk; ``n`` is the largest of the column ``n``."""
    tree, levels = _tree(maxima, n, scan)
    spans = [windows.chunk * maxima.fan**i for i in range(levels + 1)]
    low = [F.expr(f"(lb + {span - 1}) div {span}") for span in spans]
    high = [F.expr(f"rb div {span}") for span in spans]

    def run(level: int, parent: Column, start: Column, stop: Column) -> Column:
        return F.struct((F.lit(level << _LEVEL_BITS) + parent).alias("at"), start.alias("lo"), stop.alias("hi"))

    nothing, fan = F.lit(0).cast("bigint"), maxima.fan
    runs = [F.array(run(levels - 1, nothing, low[levels - 1], high[levels - 1]))]
    for i in range(levels - 1):
        ends = F.array(
            run(i, low[i + 1] - 1, low[i], low[i + 1] * fan),
            run(i, high[i + 1], high[i + 1] * fan, high[i]),
        )
        # all in one family, or to either side of what the levels above hold
        apart = low[i + 1] <= high[i + 1]
        runs.append(F.when(apart, ends).otherwise(F.array(run(i, high[i + 1], low[i], high[i]))))
    span = windows.chunk
    ends = F.explode(F.array(F.struct("lb", (low[0] * span).alias("rb")), F.struct((high[0] * span).alias("lb"), F.col("rb"))))
    edges = ranges.select("range", "n", ends.alias("_end")).select("range", "n", "_end.lb", "_end.rb").filter("lb < rb")
    edges = heaviest_of_narrow(windows, edges, F.col("n")).select("range", "n", "best")
    nodes = ranges.select("range", "n", F.explode(F.concat(*runs)).alias("_run")).select("range", "n", "_run.*").filter("lo < hi")
    within = F.filter("kids", lambda kid: (kid["node"] >= F.col("lo")) & (kid["node"] < F.col("hi")))
    middles = _meet(nodes, tree).select("range", "n", _heaviest(F.flatten(within["best"]), F.col("n")).alias("best"))
    parts = edges.union(middles).groupBy("range").agg(F.max("n").alias("n"), F.flatten(F.collect_list("best")).alias("parts"))
    return parts.select("range", _heaviest(F.col("parts"), F.col("n")).alias("best"))


def heaviest_of_ranges(maxima: BlockMaxima, ranges: DataFrame, n: int, scan: bool = False) -> DataFrame:
    """``range, rank, pos, text, weight``: the ``n`` heaviest entries of each (``range, lb, rb, n``) row.

    Equal weights go to the later position, or with ``scan`` to the earlier. A range may
    ask for fewer than ``n`` by its own column ``n``.
    """
    fan, levels = maxima.fan, len(maxima.levels)
    covered = _covering(ranges, levels, fan)
    # an upper bound of the rows that meet a level
    rows = ranges.count() * min(n, BROADCAST_ROWS) * fan + 2 * fan
    small = rows <= BROADCAST_ROWS

    def meet(nodes: DataFrame, level: DataFrame, key: str) -> DataFrame:
        return level.join(F.broadcast(nodes) if small else nodes, level[key] == nodes["node"]).drop("node")

    order = [F.desc("weight"), F.asc("pos") if scan else F.desc("pos")]
    opened = None
    for i in range(levels, 0, -1):
        nodes = covered.select("range", "n", F.explode(f"nodes_{i}").alias("node"))
        nodes = nodes if opened is None else nodes.unionByName(opened)
        maximum = F.col("first" if scan else "last")
        met = meet(nodes, maxima.levels[i - 1], "block")
        place = -maximum["back"] if scan else maximum["pos"]
        found = met.select("range", "n", "block", maximum["weight"].alias("weight"), place.alias("pos"))
        heaviest = top_n(found, ["range"], order, n).filter(F.col("rank") <= F.col("n"))
        children = F.explode(F.sequence(F.col("block") * fan, F.col("block") * fan + fan - 1))
        opened = heaviest.select("range", "n", children.alias("node"))
    nodes = covered.select("range", "n", F.explode("nodes_0").alias("node"))
    nodes = nodes if opened is None else nodes.unionByName(opened)
    found = meet(nodes, maxima.entries.select("pos", "text", "weight"), "pos")
    return top_n(found, ["range"], order, n).filter(F.col("rank") <= F.col("n"))
