"""Near-duplicate groups: MinHash bands propose, odd sketches sift, full sets decide.

Each text is the set of its distinct word shingles (A-Z folded). Texts with equal sets
form a class, and everything below works on one representative per class.

1. ``SAMPLES`` MinHash values of a set are cut into bands; sets that agree in a band
   meet. Rows per band follow the similarity, so that a pair exactly at the threshold
   meets with probability above 1 - 1e-5.
2. The MinHash samples are folded into an *odd sketch*: sample i with value v flips bit
   hash(i, v) of a bitmap. The XOR of two sketches holds the parity of the samples in
   which the sets differ, so its population count z of n bits estimates that number as
   ``-n/2 * ln(1 - 2z/n)``, most precisely at high similarity. Pairs estimated more than
   four standard errors below the threshold go no further.
3. First every member of a bucket is compared with the bucket's hub, the member that
   shares most buckets with others; links are confirmed on full shingle sets. Copies of
   one text thereby need one comparison each, however many there are. Only buckets whose
   members are then still in several components are looked at again: every member
   outside the hub's component against all members of other components, in blocks of
   ``BLOCK``. Nothing is left out: each pair that meets in a band is linked directly,
   refused, or lies within one component already.
4. Components of the confirmed links come from repeated joins.

Empty and null texts have an empty set: n_shingles 0, linked with nothing, kept. Rows
with null doc_id are linked by their text like others, but carry no id: they are nobody's
component_id, their own is that of their group (null if nobody in it has an id) and
``kept`` is false if the group has an id, null otherwise. Repeated rows are copies like
any others; those with the smallest doc_id of the group are all kept. Texts of any length
are read whole. An empty table gives an empty result. Extra columns are left aside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forespell.llm.components import components, written
from forespell.llm.words import distinct, mix, packed, per_row, shingles, slices, words

SAMPLES = 252
SKETCH_WORDS = 8
BLOCK = 2048

_DRAW = np.random.default_rng(20240)
_FACTORS = (_DRAW.integers(0, 1 << 32, SAMPLES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_SALTS = _DRAW.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)


def band_rows(similarity: float) -> int:
    """The most rows per band (of SAMPLES) that let a pair at ``similarity`` slip with at most 1e-5."""
    fits = [r for r in range(1, 15) if SAMPLES % r == 0 and (1 - similarity**r) ** (SAMPLES // r) <= 1e-5]
    return max(fits, default=1)


def signatures(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SAMPLES MinHash values for each row's set of 64-bit shingles."""
    low = (values >> np.uint64(32)).astype(np.uint32)
    full = np.flatnonzero(np.diff(first))
    out = np.zeros((len(first) - 1, SAMPLES), np.uint32)
    if len(full):
        room = np.empty_like(low)
        starts = first[full]
        for k, factor in enumerate(_FACTORS):
            np.multiply(low, factor, out=room)
            out[full, k] = np.minimum.reduceat(room, starts)
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples, SKETCH_WORDS 64-bit words for each row."""
    bit = mix(samples.astype(np.uint64) + _SALTS[None, :]) % np.uint64(64 * SKETCH_WORDS)
    flat = bit.astype(np.int64) + 64 * SKETCH_WORDS * np.arange(len(samples))[:, None]
    odd = np.bincount(flat.ravel(), minlength=len(samples) * 64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(samples), -1), axis=1).view(np.uint64)


def most_flips(similarity: float) -> int:
    """The largest population count of an XOR that four standard errors allow at ``similarity``."""
    bits = 64 * SKETCH_WORDS
    low = max(0.0, similarity - 4 * np.sqrt(similarity * (1 - similarity) / SAMPLES))
    differing = 2 * SAMPLES * (1 - low)
    expected = bits / 2 * (1 - np.exp(-2 * differing / bits))
    return int(min(bits, expected + 4 * np.sqrt(bits) / 4))


def _sets(documents: DataFrame, size: int, similarity: float) -> DataFrame:
    """row per document: doc_id, n_shingles, set (two longs naming the set), bands, sketch."""
    rows_per_band = band_rows(similarity)
    bands = SAMPLES // rows_per_band

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "text"):
            n = part.num_rows
            values, first = distinct(*shingles(words(data, offsets, fold=True), size), n)
            count = np.diff(first)
            samples = signatures(values, first)
            keys = np.zeros((n, bands), np.uint64)
            for k in range(rows_per_band):
                keys = mix(keys * np.uint64(31) + samples[:, k::rows_per_band] + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            flat = np.where(count > 0, bands, 0)
            yield pa.record_batch(
                {
                    "doc_id": part.column("doc_id"),
                    "n_shingles": pa.array(count.astype(np.int64)),
                    "sum": pa.array(per_row(np.add, values, first).view(np.int64)),
                    "xor": pa.array(per_row(np.bitwise_xor, mix(values + np.uint64(1)), first).view(np.int64)),
                    "bands": packed(keys[count > 0].ravel().view(np.int64), np.concatenate([[0], np.cumsum(flat)]), pa.int64()),
                    "sketch": pa.array([s.tobytes() for s in odd_sketches(samples)], pa.binary()),
                }
            )

    schema = "doc_id long, n_shingles long, sum long, xor long, bands array<long>, sketch binary"
    return documents.select("doc_id", "text").mapInArrow(rows, schema)


def _shingle_sets(documents: DataFrame, size: int) -> DataFrame:
    """doc_id, set: the distinct shingles of each text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "text"):
            values, first = distinct(*shingles(words(data, offsets, fold=True), size), part.num_rows)
            yield pa.record_batch({"doc_id": part.column("doc_id"), "set": packed(values.view(np.int64), first, pa.int64())})

    return documents.mapInArrow(rows, "doc_id long, set array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    left, right = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    near = F.size(F.array_intersect("set_a", "set_b"))
    every = F.size("set_a") + F.size("set_b") - near
    return pairs.join(left, "a").join(right, "b").filter(100 * near >= round(100 * similarity) * every).select("a", "b")


def _few_flips(a: str, b: str, most: int):
    """Whether the odd sketches in columns a and b differ in few enough bits."""
    flips = F.lit(0)
    for k in range(SKETCH_WORDS):
        part = [F.conv(F.hex(F.substring(c, 8 * k + 1, 8)), 16, -10).cast("long") for c in (a, b)]
        flips = flips + F.bit_count(part[0].bitwiseXOR(part[1]))
    return flips <= most


def _blocks(members: DataFrame, carried: list[str]) -> DataFrame:
    """The members of each bucket dealt into blocks: every odd one (``asks``) meets every one.

    They come in an exchange on bucket, block and part, so the blocks of one bucket go to
    different tasks, and none sees more than about BLOCK by BLOCK members of a bucket.
    """
    sizes = members.groupBy("bucket").agg(
        F.count("*").alias("rows"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("rows_blocks"),
        F.ceil(F.count_if("odd") / BLOCK).cast("int").alias("odd_blocks"),
    )
    sized = members.join(sizes.filter("rows > 1 and odd_blocks > 0"), "bucket")
    block = F.pmod(F.xxhash64("node"), F.col("rows_blocks")).cast("int")
    odd_block = F.pmod(F.xxhash64("node", F.lit(1)), F.col("odd_blocks")).cast("int")
    everywhere = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    rows = sized.select("bucket", block.alias("block"), everywhere("odd_blocks").alias("part"), *carried, F.lit(False).alias("asks"))
    asks = sized.filter("odd").select("bucket", everywhere("rows_blocks").alias("block"), odd_block.alias("part"), *carried, F.lit(True).alias("asks"))
    return rows.union(asks).repartition("bucket", "block", "part")


def _likely(members: DataFrame, most: int, percent: int) -> DataFrame:
    """bucket, node: the members with a partner that sketches and sizes allow.

    A pair counts in the first band it shares alone, so few rows carry sets onwards.
    """

    def flagged(group: pd.DataFrame) -> pd.DataFrame:
        ask, row = group[group["asks"]], group[~group["asks"]]
        seen = np.zeros(len(row), bool)
        out: list[int] = []
        if len(ask) and len(row):
            sketches = np.stack([np.frombuffer(x, np.uint64) for x in row["sketch"]])
            bands = np.stack(row["bands"].to_numpy())
            comps, count = row["component"].to_numpy(), row["n_shingles"].to_numpy()
            bucket = group["bucket"].iloc[0]
            for node, comp, sketch, own, n in zip(ask["node"], ask["component"], ask["sketch"], ask["bands"], ask["n_shingles"], strict=True):
                near = np.flatnonzero((100 * np.minimum(count, n) >= percent * np.maximum(count, n)) & (comps != comp))
                near = near[np.bitwise_count(sketches[near] ^ np.frombuffer(sketch, np.uint64)).sum(axis=1) <= most]
                near = near[own[np.argmax(bands[near] == own, axis=1)] == bucket]
                if len(near):
                    seen[near] = True
                    out.append(node)
        nodes = np.unique(np.concatenate([row["node"].to_numpy()[seen], np.array(out, np.int64)]))
        return pd.DataFrame({"bucket": np.full(len(nodes), group["bucket"].iloc[0]), "node": nodes})

    blocks = _blocks(members, ["node", "component", "sketch", "bands", "n_shingles"])
    return blocks.groupBy("bucket", "block", "part").applyInPandas(flagged, "bucket long, node long").distinct()


def _stragglers(members: DataFrame, full: DataFrame, most: int, similarity: float) -> DataFrame:
    """Links a < b between members of one bucket that are in different components.

    ``members``: bucket, node, component, odd (not in the component of the bucket's
    hub), sketch, bands, n_shingles. One side of a pair is odd. What the sketches and
    the sizes of the sets allow is confirmed where it meets, on the full sets, and links
    alone leave the task.
    """
    percent = round(100 * similarity)
    members = written(members, "members")
    likely = members.join(_likely(members, most, percent), ["bucket", "node"], "left_semi")
    likely = likely.select("bucket", "node", "component", "odd", "sketch").join(full, "node")

    def links(group: pd.DataFrame) -> pd.DataFrame:
        ask, row = group[group["asks"]], group[~group["asks"]]
        found: set[tuple[int, int]] = set()
        if len(ask) and len(row):
            sketches = np.stack([np.frombuffer(x, np.uint64) for x in row["sketch"]])
            nodes, comps, sets = row["node"].to_numpy(), row["component"].to_numpy(), row["set"].to_numpy()
            count = np.array([len(x) for x in sets])
            for node, comp, sketch, mine in zip(ask["node"], ask["component"], ask["sketch"], ask["set"], strict=True):
                near = (100 * np.minimum(count, len(mine)) >= percent * np.maximum(count, len(mine))) & (comps != comp)
                near = np.flatnonzero(near)
                flips = np.bitwise_count(sketches[near] ^ np.frombuffer(sketch, np.uint64)).sum(axis=1)
                near = near[flips <= most]
                if not len(near):
                    continue
                n = count[near]
                values = np.concatenate(sets[near])
                order = np.sort(mine)
                hit = order[np.minimum(np.searchsorted(order, values), len(order) - 1)] == values
                common = np.add.reduceat(hit.astype(np.int64), np.cumsum(n) - n)
                for other in nodes[near[100 * common >= percent * (n + len(mine) - common)]].tolist():
                    found.add((min(node, other), max(node, other)))
        flat = np.array(sorted(found), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": flat[:, 0], "b": flat[:, 1]})

    blocks = _blocks(likely, ["node", "component", "sketch", "set"])
    return blocks.groupBy("bucket", "block", "part").applyInPandas(links, "a long, b long").distinct()


def near_duplicates(documents: DataFrame, words_per_shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document (see the module's notes)."""
    most = most_flips(similarity)
    numbered = documents.select("doc_id", "text")
    sets = written(_sets(numbered, words_per_shingle, similarity), "sets")
    # A class is named by its set, its node by the smallest doc_id.
    classes = sets.filter("n_shingles > 0").groupBy("sum", "xor", "n_shingles").agg(F.min("doc_id").alias("node"))
    classes = written(classes, "classes")
    nodes = classes.filter("node is not null")
    # Ids of documents have no bound: these joins shuffle at every size.
    picked = sets.join(nodes.select("node").hint("shuffle_merge"), F.col("doc_id") == F.col("node"), "left_semi").select(F.col("doc_id").alias("node"), "n_shingles", "bands", "sketch").dropDuplicates(["node"])
    met = picked.select("node", F.explode("bands").alias("bucket"))
    sizes = met.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    met = written(met.join(sizes, "bucket"), "met")
    shared = met.groupBy("node").agg(F.sum("n").alias("degree"))
    hubs = met.join(shared, "node").groupBy("bucket").agg(F.max_by("node", F.struct("degree", -F.col("node"))).alias("hub"))
    stars = met.join(hubs, "bucket").filter("node != hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    sketches = written(picked.join(shared.select("node"), "node", "left_semi"), "sketches")
    left, right = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    stars = stars.join(left, "a").join(right, "b").filter(_few_flips("sa", "sb", most)).select("a", "b")
    texts = numbered.join(sketches.select(F.col("node").alias("doc_id")).hint("shuffle_merge"), "doc_id", "left_semi")
    full = written(_shingle_sets(texts, words_per_shingle).withColumnRenamed("doc_id", "node").dropDuplicates(["node"]), "full")
    links = written(confirmed(stars, full, similarity), "links")
    found = written(components(links), "components")

    # Buckets that still hold several components.
    named = met.join(found, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    split = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high").select("bucket")
    hub_of = hubs.join(found, F.col("hub") == F.col("node"), "left").select("bucket", "hub", F.coalesce("component", "hub").alias("hub_component"))
    # The hub's own pairs are settled; buckets of two are done.
    members = named.join(split, "bucket").join(hub_of, "bucket").filter("node != hub")
    members = members.select("bucket", "node", "component", (F.col("component") != F.col("hub_component")).alias("odd"))
    inside = members.groupBy("bucket").agg(F.count("*").alias("n"), F.max("odd").alias("any_odd")).filter("n > 1 and any_odd")
    members = members.join(inside.select("bucket"), "bucket", "left_semi").join(sketches, "node")
    again = written(_stragglers(members, full, most, similarity), "links")
    if not again.isEmpty():
        found = written(components(links.union(again)), "components")

    groups = classes.join(found, "node", "left").select(F.col("sum").alias("s"), F.col("xor").alias("x"), F.col("n_shingles").alias("n"), F.coalesce("component", "node").alias("component_id"))
    joined = sets.join(groups, (F.col("sum") == F.col("s")) & (F.col("xor") == F.col("x")) & (F.col("n_shingles") == F.col("n")), "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    alone = F.coalesce(F.col("doc_id").eqNullSafe(component), F.lit(False))
    kept = F.when(F.col("n_shingles") == 0, F.lit(True)).when(component.isNotNull(), alone)
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def deduplicated(documents: DataFrame, words_per_shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest doc_id.

    Equal rows count once. Rows without doc_id cannot be told from each other and stay.
    """
    found = near_duplicates(documents, words_per_shingle, similarity)
    ids = written(found.filter("kept and doc_id is not null").select("doc_id").distinct(), "kept")
    chosen = documents.join(ids.hint("shuffle_merge"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return chosen.select(documents.columns).union(documents.filter("doc_id is null"))
