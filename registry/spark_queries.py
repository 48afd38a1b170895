"""The registered queries: every operator on the given tables.

Dictionaries: words of ``documents`` with their counts, ``part`` names (many
tied weights), page urls with their byte length, customers with their number of
orders. Query tables come from ``conversations`` (what was being typed last),
``events`` (few prefixes, asked very often) or a short list of prefixes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import forespell as fs
from forespell.functions import byte_length
from forespell.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

PREFIXES = ["", "t", "th", "the", "de", "é", "Zz", "the", "qu"]
MIXED_CASE = ["", "T", "tH", "THE", "dE", "É", "é", "zZ"]
LARGE_K = [(0, "th", 2000), *[(i, q, i) for i, q in enumerate(PREFIXES[:7], 1)]]
WORD_STARTS = ["the", "ou", "Et"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream, be it one file or a folder of files.

    A stream takes a folder, not a file; a pattern that fits the table alone stands for either.
    """
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fs.word_dictionary(table(spark, sf_dir, "documents"), "text")


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fs.dictionary_from(table(spark, sf_dir, "part"), "p_name")


def part_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names repeat, each time with another size."""
    return fs.dictionary_from(table(spark, sf_dir, "part"), "p_name", "p_size")


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return fs.dictionary_from(pages, "url", byte_length("url"), aggregate="min")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    named = table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"))
    return fs.dictionary_from(named, "c_name", "orders")


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three letters of the last word of every message; k varies by turn."""
    last = F.element_at(F.split("text", " "), -1)
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("qid"),
        F.left(last, F.lit(3)).alias("q"),
        (F.col("turn") % 7 + 1).cast("int").alias("k"),
    )


def typed_words(conversations: DataFrame) -> DataFrame:
    """The first 1 to 12 letters of every word of every message; k varies by turn."""
    words = conversations.select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("at", "w"))
    qid = (F.col("conv_id") * 1000 + F.col("turn")) * 10000 + F.col("at")
    numbered = words.filter(F.col("w") != "").select("turn", "w", qid.alias("qid"))
    return numbered.select(
        "qid",
        F.left("w", (F.col("qid") % 12 + 1).cast("int")).alias("q"),
        (F.col("turn") % 7 + 1).cast("int").alias("k"),
    )


def event_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to four letters of the event type: a handful of prefixes, asked very often."""
    reach = (F.col("event_id") % 4 + 1).cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("qid"), F.left("event_type", reach).alias("q"), F.lit(3).alias("k")
    )


def order_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of positions for every order, most narrow, some wide, some empty; k varies, and is missing for some."""
    start = (F.col("o_custkey") * 7 + F.col("o_orderkey")) % 60_000
    width = F.when(F.col("o_orderkey") % 97 == 0, 50_000).otherwise(F.col("o_orderkey") % 400 - 20)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("rid"),
        start.alias("lb"),
        (start + width).alias("rb"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderkey") % 9 + 1).cast("int").alias("k"),
    )


def entry_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a dictionary file, good and broken, made from every line item."""
    number = F.col("l_orderkey").cast("string")
    name = F.concat_ws("-", "l_returnflag", number, F.col("l_linenumber").cast("string"))
    weight = F.col("l_suppkey").cast("string")
    kinds = [
        F.concat(name, F.lit("\t"), weight),
        name,
        F.concat(name, F.lit("\t")),
        F.concat(name, F.lit("\t"), weight, F.lit("abc")),
        F.concat(name, F.lit("\t-"), weight),
        F.concat(name, F.lit("\t"), name, F.lit("\t"), weight),
        F.concat(name, F.lit("\t "), weight, F.lit("\r")),
        F.lit(""),
        F.concat(name, F.lit("\t"), weight, F.lit("99999999999999999999")),
    ]
    kind = (F.col("l_orderkey") + F.col("l_linenumber")) % len(kinds)
    line = F.get(F.array(*kinds), kind.cast("int"))
    return table(spark, sf_dir, "lineitem").select(line.alias("line"))


def write_lines(df: DataFrame, spark: SparkSession, label: str, **options: str) -> str:
    path = scratch_path(spark, label)
    df.write.options(**options).text(path)
    return path


def tab_lines(dictionary: DataFrame) -> DataFrame:
    return dictionary.select(F.concat_ws("\t", "text", F.col("weight").cast("string")).alias("value"))


def unpacked(packed: DataFrame) -> DataFrame:
    """``prefix, rank, text, weight`` of a packed completion table."""
    exploded = packed.select("prefix", F.posexplode("completions").alias("place", "entry"))
    return exploded.select("prefix", (F.col("place") + 1).alias("rank"), "entry.text", "entry.weight")


def dictionary_queries() -> dict[str, Query]:
    def request_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
        asked = F.get_json_object("props", "$.k").cast("int")
        return table(spark, sf_dir, "events").select(
            F.col("event_id").alias("qid"),
            F.when(F.col("event_type") != "error", F.col("event_type")).alias("q"),
            F.when(F.col("user_id") % 3 != 0, asked - 10).alias("k"),
        )

    def balances(spark: SparkSession, sf_dir: str) -> DataFrame:
        balance = F.floor("c_acctbal").cast("bigint")
        known = F.when(F.col("c_nationkey") != 3, balance)
        name = F.when(F.col("c_nationkey") != 5, F.col("c_name"))
        return table(spark, sf_dir, "customer").select(name.alias("text"), known.alias("weight"))

    def lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
        good, _ = fs.split_valid(entry_lines(spark, sf_dir), weight_type="decimal(20,0)", trailing="ignore")
        return good.select("text", F.col("weight").cast("string").alias("weight"))

    def tsv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = write_lines(tab_lines(urls(spark, sf_dir)), spark, "tsv")
        return fs.read_weighted_strings(spark, path, on_bad="fail")

    def gz_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = write_lines(tab_lines(customers(spark, sf_dir)), spark, "gz", compression="gzip")
        return fs.read_weighted_strings(spark, path, partitions=8)

    def query_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
        typed_lines = typed(spark, sf_dir).filter(~F.contains("q", F.lit("\n"))).select("q")
        path = write_lines(typed_lines, spark, "queries")
        return fs.read_queries(spark, path).groupBy("q", "k").agg(F.count("*").alias("n"))

    return {
        "dictionary_words": words,
        "dictionary_counts": part_names,
        "dictionary_rows": part_sizes,
        "dictionary_customers": customers,
        "split_valid_entries": lambda s, d: fs.split_valid(entry_lines(s, d))[0],
        "split_valid_quarantine": lambda s, d: fs.split_valid(entry_lines(s, d))[1],
        "split_valid_lenient": lenient,
        "split_pairs_entries": lambda s, d: fs.split_pairs(balances(s, d))[0],
        "split_pairs_quarantine": lambda s, d: fs.split_pairs(balances(s, d))[1],
        "tsv_round_trip": tsv_round_trip,
        "gz_round_trip": gz_round_trip,
        "query_lines": query_lines,
        "normalise_queries": lambda s, d: fs.normalise_queries(request_queries(s, d)),
        "refused_queries": lambda s, d: fs.split_queries(request_queries(s, d), min_chars=5)[1],
        "sort_dictionary": lambda s, d: fs.sort_dictionary(part_sizes(s, d)),
        "sort_dictionary_ci": lambda s, d: fs.sort_dictionary(words(s, d), case_sensitive=False),
        "dedup_min": lambda s, d: fs.dedup(part_sizes(s, d)),
        "dedup_max": lambda s, d: fs.dedup(part_sizes(s, d), on_duplicate="max"),
        "dedup_sum": lambda s, d: fs.dedup(part_sizes(s, d), on_duplicate="sum"),
        "dedup_ci": lambda s, d: fs.dedup(words(s, d), case_sensitive=False),
        "dedup_ci_max": lambda s, d: fs.dedup(words(s, d), False, on_duplicate="max"),
        "dedup_ci_sum": lambda s, d: fs.dedup(words(s, d), False, on_duplicate="sum"),
        "row_counts": lambda s, d: fs.row_counts(part_sizes(s, d)),
        "row_counts_ci": lambda s, d: fs.row_counts(words(s, d), case_sensitive=False),
        "input_stats": lambda s, d: fs.input_stats(words(s, d)),
        "with_position_copies": lambda s, d: fs.with_position(part_sizes(s, d), unique=False),
        "with_position": lambda s, d: fs.with_position(words(s, d)),
        "with_position_ci": lambda s, d: fs.with_position(words(s, d), case_sensitive=False),
    }


def lookup_queries() -> dict[str, Query]:
    def positioned_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fs.with_position(part_names(spark, sf_dir))

    def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fs.dictionary_from(table(spark, sf_dir, "conversations"), "text")

    def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "dictionary")
        fs.save_dictionary(words(spark, sf_dir), path)
        return fs.prefix_filter(fs.load_dictionary(spark, path), "th")

    def stored_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "dictionary")
        folded = fs.dedup(words(spark, sf_dir), case_sensitive=False)
        fs.save_dictionary(folded, path, case_sensitive=False)
        return fs.complete(fs.load_dictionary(spark, path, False), "TH", 20, case_sensitive=False)

    def reused(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "dictionary")
        fs.load_or_build(spark, path, lambda: words(spark, sf_dir))
        # the second call finds the stored words and does not build
        again = fs.load_or_build(spark, path, lambda: part_names(spark, sf_dir))
        return fs.input_stats(again)

    def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Stored from the names of parts, then, with one more file behind it, built anew."""
        path, source = scratch_path(spark, "dictionary"), scratch_path(spark, "source")
        names = lambda: fs.dictionary_from(spark.read.parquet(source), "name")
        table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).write.parquet(source)
        fs.load_or_build(spark, path, names, mode="check", sources=[source]).count()
        table(spark, sf_dir, "customer").select(F.col("c_name").alias("name")).write.mode("append").parquet(source)
        return fs.load_or_build(spark, path, names, mode="check", sources=[source])

    def plain_read_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "dictionary")
        fs.save_dictionary(words(spark, sf_dir), path)
        return fs.complete(fs.load_dictionary(spark, path, False), "tH", 10, case_sensitive=False)

    def decimal_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "dictionary")
        above = (F.col("weight").cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")).cast("decimal(20,0)")
        fs.save_dictionary(words(spark, sf_dir).withColumn("weight", above), path)
        best = fs.complete_batch(fs.load_dictionary(spark, path), fs.queries_from(spark, PREFIXES))
        return best.withColumn("weight", F.col("weight").cast("string"))

    def kept_positions(spark: SparkSession, sf_dir: str, case_sensitive: bool = True):
        path = scratch_path(spark, "positioned")
        fs.save_positioned(words(spark, sf_dir), path, case_sensitive, files=20)
        return fs.load_positioned(spark, path)

    def kept_url_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "positioned")
        fs.save_positioned(urls(spark, sf_dir), path, files=10)
        return fs.stored_common_extension(fs.load_positioned(spark, path), "https://w")

    def kept_word_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "word-starts")
        fs.save_word_starts(conversations(spark, sf_dir), path, reach=4)
        return fs.stored_word_start_matches(fs.load_word_starts(spark, path), fs.queries_from(spark, WORD_STARTS))

    def word_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fs.block_maxima(fs.with_position(words(spark, sf_dir)), fan=64)

    def stored_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "blocks")
        fs.save_block_maxima(word_blocks(spark, sf_dir), path)
        return fs.heaviest_in_ranges(fs.load_block_maxima(spark, path), order_ranges(spark, sf_dir), ties="scan")

    def argmaxes(spark: SparkSession, sf_dir: str) -> DataFrame:
        asked = order_ranges(spark, sf_dir).select("rid", F.col("lb").alias("first"), F.col("rb").alias("last"))
        return fs.range_argmaxes(word_blocks(spark, sf_dir), asked)

    def one_range(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fs.prefix_range(words(spark, sf_dir), "th")

    return {
        "stored_dictionary": stored,
        "stored_dictionary_ci": stored_ci,
        "load_or_build": reused,
        "load_or_build_check": checked,
        "prefix_edges": lambda s, d: fs.prefix_edges(words(s, d)),
        "prefix_edges_ci": lambda s, d: fs.prefix_edges(words(s, d), case_sensitive=False),
        "stored_plain_read_ci": plain_read_ci,
        "stored_decimal_weights": decimal_weights,
        "prefix_filter": lambda s, d: fs.prefix_filter(words(s, d), "th"),
        "prefix_filter_ci": lambda s, d: fs.prefix_filter(words(s, d), "Th", case_sensitive=False),
        "prefix_filter_urls": lambda s, d: fs.prefix_filter(urls(s, d), "https://"),
        "prefix_range": one_range,
        "prefix_ranges": lambda s, d: fs.prefix_ranges(words(s, d), typed(s, d)),
        "prefix_ranges_ci": lambda s, d: fs.prefix_ranges(words(s, d), fs.queries_from(s, MIXED_CASE), False),
        "match_count": lambda s, d: fs.match_count(words(s, d), "th"),
        "match_counts": lambda s, d: fs.match_counts(words(s, d), typed(s, d)),
        "match_counts_ci": lambda s, d: fs.match_counts(words(s, d), typed(s, d), case_sensitive=False),
        "match_entries": lambda s, d: fs.match_entries(words(s, d), fs.queries_from(s, PREFIXES)),
        "range_filter": lambda s, d: fs.range_filter(positioned_parts(s, d), 10, 40),
        "range_argmax": lambda s, d: fs.range_argmax(positioned_parts(s, d), 10, 39),
        "stored_positions": lambda s, d: kept_positions(s, d).entries(),
        "stored_positions_ci": lambda s, d: kept_positions(s, d, False).entries().select("text", "weight", "folded", "pos"),
        "stored_prefix_range": lambda s, d: fs.stored_prefix_range(kept_positions(s, d), "th"),
        "stored_match_count": lambda s, d: fs.stored_match_count(kept_positions(s, d), "th"),
        "stored_common_extension": kept_url_extension,
        "stored_word_starts": kept_word_starts,
        "heaviest_in_ranges": lambda s, d: fs.heaviest_in_ranges(word_blocks(s, d), order_ranges(s, d)),
        "heaviest_in_ranges_scan": stored_ranges,
        "range_argmaxes": argmaxes,
        "heaviest_in_range": lambda s, d: fs.heaviest_in_range(positioned_parts(s, d), 5, 60, 12),
        "heaviest_in_range_scan": lambda s, d: fs.heaviest_in_range(
            positioned_parts(s, d), 5, 60, 12, ties="scan"
        ),
        "word_start_filter": lambda s, d: fs.word_start_filter(conversations(s, d), "the"),
        "word_start_matches": lambda s, d: fs.word_start_matches(
            conversations(s, d), fs.queries_from(s, WORD_STARTS)
        ),
        "next_char_facets": lambda s, d: fs.next_char_facets(words(s, d), "th"),
        "next_char_facets_batch": lambda s, d: fs.next_char_facets_batch(words(s, d), typed(s, d)),
        "common_extension": lambda s, d: fs.common_extension(urls(s, d), "https://w"),
        "common_extensions": lambda s, d: fs.common_extensions(
            customers(s, d), fs.queries_from(s, ["", "C", "Cust", "Customer#00000012", "x"])
        ),
    }


def completion_queries() -> dict[str, Query]:
    def literal(spark: SparkSession, k: int = 5) -> DataFrame:
        return fs.queries_from(spark, PREFIXES, k)

    def scan_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
        dictionary = fs.with_position(words(spark, sf_dir))
        return fs.complete_batch(dictionary, typed(spark, sf_dir), ties="scan")

    def heavy_first(spark: SparkSession, sf_dir: str) -> DataFrame:
        dictionary = words(spark, sf_dir)
        heavy_from = fs.heavy_weight(dictionary)
        return fs.complete_batch(dictionary, typed(spark, sf_dir), heavy_from=heavy_from)

    def stored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "completions")
        fs.save_completion_table(fs.build_completion_table(words(spark, sf_dir), 3, 5), path)
        return unpacked(fs.load_completion_table(spark, path).filter(F.col("prefix_length") == 2))

    def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = table_stream(spark, sf_dir, "events")
        reach = (F.col("event_id") % 4 + 1).cast("int")
        return events.select(
            F.col("event_id").alias("qid"), F.left("event_type", reach).alias("q"), F.lit(3).alias("k")
        )

    def answered_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
        built = scratch_path(spark, "completions")
        fs.save_completion_table(fs.build_completion_table(words(spark, sf_dir), 4, 3), built)
        table = fs.load_completion_table(spark, built)
        return fs.complete_stream(event_stream(spark, sf_dir), table, 4, F.col("k"))

    def drained(stream: DataFrame) -> DataFrame:
        """Run the stream over what is there now and read its output back."""
        spark = stream.sparkSession
        path = scratch_path(spark, "stream")
        writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/state")
        writer.trigger(availableNow=True).start(f"{path}/answers").awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{path}/answers")

    def stream_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = drained(answered_stream(spark, sf_dir))
        flat = rows.select("qid", F.posexplode("completions").alias("place", "entry"))
        return flat.select("qid", (F.col("place") + 1).alias("rank"), "entry.text", "entry.weight")

    def stream_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
        return drained(fs.suggestions_json(answered_stream(spark, sf_dir))).select("qid", "json")

    def stream_lookup_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = fs.build_completion_table(words(spark, sf_dir), 4, 3, case_sensitive=False)
        rows = drained(fs.complete_stream(event_stream(spark, sf_dir), table, k=F.col("k"), case_sensitive=False))
        flat = rows.select("qid", F.posexplode("completions").alias("place", "entry"))
        return flat.select("qid", (F.col("place") + 1).alias("rank"), "entry.text", "entry.weight")

    def stream_of_any_length(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Short prefixes from the table, the others from the dictionary; every query keeps a row."""
        path = scratch_path(spark, "stream")
        talks = table_stream(spark, sf_dir, "conversations")
        built = fs.build_completion_table(words(spark, sf_dir), 4, 5)
        writer = fs.complete_stream_batch(
            typed_words(talks), words(spark, sf_dir), f"{path}/answers", table=built, keep_unmatched=True
        )
        writer = writer.option("checkpointLocation", f"{path}/state").trigger(availableNow=True)
        writer.start().awaitTermination()
        return spark.read.parquet(f"{path}/answers").drop("batch_id")

    def stored_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Words being typed, a third of them without k, answered from a stored table alone."""
        path = scratch_path(spark, "stream")
        fs.save_completion_table(fs.build_completion_table(words(spark, sf_dir), 12, 10), f"{path}/table")
        talks = table_stream(spark, sf_dir, "conversations")
        asked = typed_words(talks).withColumn("k", F.when(F.col("qid") % 3 != 0, F.col("k")))
        stored = fs.load_completion_table(spark, f"{path}/table")
        writer = fs.complete_stream_batch(asked, None, f"{path}/answers", table=stored, keep_unmatched=True)
        writer.option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(f"{path}/answers").drop("batch_id")

    def null_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
        asked = typed(spark, sf_dir).withColumn("q", F.when(F.col("qid") % 3 != 0, F.col("q")))
        return fs.complete_batch(words(spark, sf_dir), asked)

    def large_k(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fs.complete_batch(words(spark, sf_dir), spark.createDataFrame(LARGE_K, "qid BIGINT, q STRING, k INT"))

    def whole_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
        asked = table(spark, sf_dir, "pages").select(F.col("page_id").alias("qid"), F.col("url").alias("q"), F.lit(3).alias("k"))
        return fs.complete_batch(urls(spark, sf_dir), asked)

    def whole_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Every message as a prefix, and in every third place half of it."""
        talks = table(spark, sf_dir, "conversations")
        reach = F.when(F.col("turn") % 3 == 0, F.floor(F.length("text") / 2).cast("int")).otherwise(F.length("text"))
        asked = talks.select((F.col("conv_id") * 1000 + F.col("turn")).alias("qid"), F.left("text", reach).alias("q"), F.lit(3).alias("k"))
        return fs.complete_batch(fs.dictionary_from(talks, "text"), asked)

    def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "stream")
        writer = fs.complete_stream_batch(event_stream(spark, sf_dir), words(spark, sf_dir), f"{path}/answers")
        writer = writer.option("checkpointLocation", f"{path}/state").trigger(availableNow=True)
        writer.start().awaitTermination()
        return spark.read.parquet(f"{path}/answers").drop("batch_id")

    return {
        "complete": lambda s, d: fs.complete(words(s, d), "th", 10),
        "complete_ci": lambda s, d: fs.complete(words(s, d), "tH", 10, case_sensitive=False),
        "complete_empty_prefix": lambda s, d: fs.complete(words(s, d), "", 50),
        "complete_no_match": lambda s, d: fs.complete(words(s, d), "the the", 5),
        "complete_ties": lambda s, d: fs.complete(part_names(s, d), "", 20),
        "complete_scan_ties": lambda s, d: fs.complete(
            fs.with_position(words(s, d)), "th", 300, ties="scan"
        ),
        "complete_batch": lambda s, d: fs.complete_batch(words(s, d), literal(s)),
        "complete_batch_ci": lambda s, d: fs.complete_batch(
            words(s, d), fs.queries_from(s, MIXED_CASE, 10), case_sensitive=False
        ),
        "complete_batch_per_k": lambda s, d: fs.complete_batch(words(s, d), typed(s, d)),
        "complete_batch_heavy_first": heavy_first,
        "complete_batch_dup_queries": lambda s, d: fs.complete_batch(words(s, d), event_prefixes(s, d)),
        "complete_batch_unmatched": lambda s, d: fs.complete_batch(
            words(s, d), literal(s), keep_unmatched=True
        ),
        "complete_batch_scan_ties": scan_batch,
        "completion_table": lambda s, d: fs.completion_rows(words(s, d), 4, 3, method="explode"),
        "completion_rollup": lambda s, d: fs.completion_rows(words(s, d), 4, 3),
        "completion_rollup_long": lambda s, d: fs.completion_rows(words(s, d), 12, 2),
        "completion_table_ci": lambda s, d: fs.completion_rows(words(s, d), 3, 5, case_sensitive=False),
        "completion_table_packed": lambda s, d: unpacked(fs.build_completion_table(words(s, d), 2, 10)),
        "stored_completion_table": stored_table,
        "suggestions_rows": lambda s, d: fs.suggestions_rows(fs.complete_batch(words(s, d), literal(s, 10))),
        "suggestions_json": lambda s, d: fs.suggestions_json(
            fs.complete_batch(words(s, d), literal(s, 10), keep_unmatched=True)
        ),
        "result_lines": lambda s, d: fs.to_lines(fs.complete_batch(words(s, d), typed(s, d))),
        "complete_stream": stream_lookup,
        "complete_stream_json": stream_documents,
        "complete_stream_batch": stream_batches,
        "complete_stream_ci": stream_lookup_ci,
        "complete_stream_long": stream_of_any_length,
        "complete_stream_stored": stored_stream,
        "complete_batch_null_q": null_prefixes,
        "complete_batch_large_k": large_k,
        "complete_batch_long": whole_urls,
        "complete_batch_whole_texts": whole_texts,
    }


def all_queries() -> dict[str, Query]:
    return {**dictionary_queries(), **lookup_queries(), **completion_queries()}
