"""Build, complete and tabulate from files: ``python -m forespell --help``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

import forespell as fs


def build(spark: SparkSession, args: argparse.Namespace) -> None:
    """Entries file to stored dictionary; bad lines go next to it."""
    lines = fs.read_lines(spark, args.entries, args.partitions)
    good, bad = fs.split_valid(lines)
    case_sensitive = not args.ignore_case
    unique = fs.dedup(good, case_sensitive, args.on_duplicate)
    fs.load_or_build(spark, args.dictionary, lambda: unique, args.mode, case_sensitive)
    if args.quarantine:
        bad.write.mode("overwrite").json(args.quarantine)


def complete(spark: SparkSession, args: argparse.Namespace) -> None:
    """Query lines to answer lines or suggestion documents."""
    case_sensitive = not args.ignore_case
    dictionary = fs.load_dictionary(spark, args.dictionary, case_sensitive)
    queries = fs.read_queries(spark, args.queries, args.k)
    answered = fs.complete_batch(dictionary, queries, case_sensitive, keep_unmatched=args.json)
    if args.json:
        fs.suggestions_json(answered).select("json").write.mode("overwrite").text(args.output)
    else:
        lines = fs.to_lines(answered).repartitionByRange("qid", "rank")
        lines.sortWithinPartitions("qid", "rank").select("line").write.mode("overwrite").text(args.output)


def table(spark: SparkSession, args: argparse.Namespace) -> None:
    """Stored dictionary to stored completion table."""
    case_sensitive = not args.ignore_case
    dictionary = fs.load_dictionary(spark, args.dictionary, case_sensitive)
    built = fs.build_completion_table(dictionary, args.max_len, args.k, case_sensitive)
    fs.save_completion_table(built, args.table)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="forespell")
    commands = top.add_subparsers(required=True)

    one = commands.add_parser("build", help=build.__doc__)
    one.add_argument("entries")
    one.add_argument("dictionary")
    one.add_argument("--on-duplicate", choices=["min", "max", "sum"], default="min")
    one.add_argument("--mode", choices=["reuse", "rebuild"], default="reuse")
    one.add_argument("--partitions", type=int, help="spread the lines of a gzip file")
    one.add_argument("--quarantine", help="folder for the lines that are no entry")
    one.set_defaults(run=build)

    two = commands.add_parser("complete", help=complete.__doc__)
    two.add_argument("dictionary")
    two.add_argument("queries")
    two.add_argument("output")
    two.add_argument("--k", type=int, default=5)
    two.add_argument("--json", action="store_true", help="one suggestion document per query")
    two.set_defaults(run=complete)

    three = commands.add_parser("table", help=table.__doc__)
    three.add_argument("dictionary")
    three.add_argument("table")
    three.add_argument("--max-len", type=int, default=4)
    three.add_argument("--k", type=int, default=10)
    three.set_defaults(run=table)

    for command in (one, two, three):
        command.add_argument("--ignore-case", action="store_true")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(SparkSession.builder.appName("forespell").getOrCreate(), args)


if __name__ == "__main__":
    main()
