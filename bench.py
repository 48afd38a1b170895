"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR  tables to read (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)

The dictionary (words of the documents) is built and stored first, as users do;
the other queries read the stored one. Each runs once to warm up and once for
the clock.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import forespell as fs
from forespell.session import local_session, scratch_path
from registry import spark_queries

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
LOOKUPS = ["", "E", "Ex", "th", "de", "que", "Th", "a", "b", "c"]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def once(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def timed(work) -> float:
    work()
    return once(work)


def median_ms(work) -> float:
    """Median over the lookups, after one round to warm up."""
    for prefix in LOOKUPS:
        work(prefix)
    return round(1000 * statistics.median(once(lambda p=p: work(p)) for p in LOOKUPS * 2), 1)


def typed_prefixes(spark: SparkSession, n: int) -> DataFrame:
    """``n`` queries: the first 1 to 8 letters of words as they occur in the documents."""
    words = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(
        F.monotonically_increasing_id().alias("doc"), F.posexplode(F.split("text", " ")).alias("at", "w")
    )
    reach = (F.pmod(F.xxhash64("doc", "at"), F.lit(8)) + 1).cast("int")
    queries = words.filter(F.col("w") != "").limit(n)
    return queries.select(
        (F.col("doc") * 100_000 + F.col("at")).alias("qid"), F.left("w", reach).alias("q"), F.lit(5).alias("k")
    )


def operators(spark: SparkSession, dictionary: DataFrame) -> dict:
    typed = spark_queries.typed(spark, SF_DIR)
    events = spark_queries.event_prefixes(spark, SF_DIR)
    heavy = fs.heavy_weight(dictionary)
    positioned = fs.with_position(dictionary)
    blocks = fs.block_maxima(positioned)
    ranges = spark_queries.order_ranges(spark, SF_DIR)
    large = spark.createDataFrame([(0, "", 20_000), *[(i, q, 5) for i, q in enumerate(LOOKUPS, 1)]], "qid BIGINT, q STRING, k INT")
    return {
        "dedup": lambda: fs.dedup(dictionary),
        "dedup_ci": lambda: fs.dedup(dictionary, case_sensitive=False),
        "input_stats": lambda: fs.input_stats(dictionary),
        "with_position": lambda: fs.with_position(dictionary),
        "prefix_ranges": lambda: fs.prefix_ranges(dictionary, typed),
        "match_counts": lambda: fs.match_counts(dictionary, typed),
        "next_char_facets_batch": lambda: fs.next_char_facets_batch(dictionary, typed),
        "complete_batch_per_k": lambda: fs.complete_batch(dictionary, typed),
        "complete_batch_ci": lambda: fs.complete_batch(dictionary, typed, case_sensitive=False),
        "complete_batch_dup_queries": lambda: fs.complete_batch(dictionary, events),
        "completion_table": lambda: fs.completion_rows(dictionary, 4, 10, method="explode"),
        "completion_rollup": lambda: fs.completion_rows(dictionary, 4, 10),
        "suggestions_json": lambda: fs.suggestions_json(fs.complete_batch(dictionary, typed)),
        "complete_batch_heavy_first": lambda: fs.complete_batch(dictionary, typed, heavy_from=heavy),
        "complete_batch_ten": lambda: fs.complete_batch(dictionary, fs.queries_from(spark, LOOKUPS)),
        "complete_batch_scan_ties": lambda: fs.complete_batch(positioned, typed, ties="scan"),
        "complete_batch_large_k": lambda: fs.complete_batch(dictionary, large),
        "heaviest_in_ranges": lambda: fs.heaviest_in_ranges(blocks, ranges),
        "prefix_edges": lambda: fs.prefix_edges(dictionary),
        "match_entries": lambda: fs.match_entries(dictionary, typed),
        "common_extensions": lambda: fs.common_extensions(dictionary, typed),
        "word_start_matches": lambda: fs.word_start_matches(
            fs.dictionary_from(spark.read.parquet(f"{SF_DIR}/conversations.parquet"), "text"),
            fs.queries_from(spark, spark_queries.WORD_STARTS),
        ),
    }


def main() -> None:
    spark = local_session(CPUS, partitions=int(CPUS))
    seconds: dict[str, float] = {}
    extra: dict[str, float] = {}

    stored = scratch_path(spark, "dictionary")
    seconds["dictionary_words"] = timed(lambda: run(spark_queries.words(spark, SF_DIR)))
    seconds["dictionary_save"] = timed(lambda: fs.save_dictionary(spark_queries.words(spark, SF_DIR), stored))
    dictionary = fs.load_dictionary(spark, stored)
    extra["entries"] = dictionary.count()

    for name, query in operators(spark, dictionary).items():
        seconds[name] = timed(lambda query=query: run(query()))

    table_path = scratch_path(spark, "completions")
    built = fs.build_completion_table(dictionary, 4, 10)
    seconds["completion_table_save"] = timed(lambda: fs.save_completion_table(built, table_path))
    table = fs.load_completion_table(spark, table_path)
    seconds["complete_stream"] = timed(
        lambda: run(spark_queries.all_queries()["complete_stream"](spark, SF_DIR))
    )

    for n in (1_000, 100_000, 1_000_000):
        path = scratch_path(spark, "queries")
        typed_prefixes(spark, n).repartition(int(CPUS)).write.parquet(path)
        batch = spark.read.parquet(path)
        took = timed(lambda batch=batch: run(fs.complete_batch(dictionary, batch)))
        seconds[f"complete_batch_{n}"] = took
        extra[f"complete_batch_{n}_us_per_query"] = round(1e6 * took / n, 2)

    extra["complete_p50_ms"] = median_ms(lambda p: fs.complete(dictionary, p, 5).collect())
    extra["table_lookup_p50_ms"] = median_ms(
        lambda p: table.filter((F.col("prefix_length") == len(p)) & (F.col("prefix") == p)).collect()
    )

    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "extra": extra,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
