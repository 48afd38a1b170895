"""Headerless ``text<TAB>weight`` files, plain or gzip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forespell.functions import parse_weight

# The reasons a line can be quarantined for.
BLANK = "blank line"
NO_TAB = "no tab"
NUL = "NUL in text"
NOT_A_NUMBER = "weight is not a whole number"
OUT_OF_RANGE = "weight out of range"


def read_lines(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """One row per line, in column ``line``.

    Lines end at ``\\n`` only, so a lone carriage return stays inside the line.
    A gzip file is not splittable: one task reads it. Give ``partitions`` to
    spread its lines before the work that follows.
    """
    lines = spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")
    return lines.repartition(partitions) if partitions else lines


def parse_entries(lines: DataFrame, weight_type: str = "bigint", trailing: str = "reject") -> DataFrame:
    """``line, text, weight, reason``: split at the first tab and judge every line.

    ``reason`` is null for a good line. Quotes and backslashes have no meaning.
    """
    tab = F.instr("line", "\t")
    field = F.expr("substring(line, instr(line, '\t') + 1)")
    text = F.when(tab > 0, F.expr("substring(line, 1, instr(line, '\t') - 1)"))
    has_digits = field.rlike(
        r"^[ \t]*\+?[0-9]+\r?\z" if trailing == "reject" else r"^[ \t]*\+?[0-9]+"
    )
    weight = F.when(tab > 0, parse_weight(field, weight_type, trailing))
    reason = (
        F.when(F.col("line").rlike(r"^\r?\z"), BLANK)
        .when(tab == 0, NO_TAB)
        .when(F.contains(text, F.lit("\0")), NUL)
        .when(~has_digits, NOT_A_NUMBER)
        .when(weight.isNull(), OUT_OF_RANGE)
    )
    return lines.select("line", text.alias("text"), weight.alias("weight"), reason.alias("reason"))


def split_valid(
    lines: DataFrame, weight_type: str = "bigint", trailing: str = "reject"
) -> tuple[DataFrame, DataFrame]:
    """The dictionary ``text, weight`` and the quarantine ``line, reason``."""
    parsed = parse_entries(lines, weight_type, trailing)
    good = parsed.filter(F.col("reason").isNull()).select("text", "weight")
    bad = parsed.filter(F.col("reason").isNotNull()).select("line", "reason")
    return good, bad


def read_weighted_strings(
    spark: SparkSession,
    path: str | list[str],
    on_bad: str = "fail",
    partitions: int | None = None,
    weight_type: str = "bigint",
    trailing: str = "reject",
) -> DataFrame:
    """Read a dictionary file.

    ``on_bad='skip'`` leaves bad lines out (``split_valid`` shows them);
    ``on_bad='fail'`` stops the job at the first one.
    """
    lines = read_lines(spark, path, partitions)
    if on_bad == "skip":
        return split_valid(lines, weight_type, trailing)[0]
    if on_bad != "fail":
        raise ValueError(f"on_bad must be 'skip' or 'fail', not {on_bad!r}")
    parsed = parse_entries(lines, weight_type, trailing)
    complaint = F.raise_error(F.concat_ws(": ", "reason", "line")).cast("string")
    checked = F.when(F.col("reason").isNull(), F.col("text")).otherwise(complaint)
    return parsed.select(checked.alias("text"), "weight")
