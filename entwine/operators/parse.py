"""Raw lines parsed into rows; those that fail set apart with a reason (problem 6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entwine.plans.durable import small_side

#: Stands for a separator outside quotes; the mark itself is escaped in the data, so any text survives.
MARK, SEP, KEEP = "\u0001", "\u0001S", "\u0001E"

#: Rules: column, kind, argument. A column that a file lacks is not checked.
ROSTER_RULES = [
    ("raw_brand_name", "letter", None),
    ("website_hint", "host", None),
    ("publish_status", "one_of", "published|draft"),
    ("updated_on", "date", None),
]
HOST = r"^(?i:https?://)?[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+(?::\d+)?(?:/\S*)?$"
REASONS = ("quoting", "column_count", "invalid_value")


def separator(header: Column) -> Column:
    """The first of the usual separators in a header whose names are letters, digits and underscores."""
    return F.nullif(F.substring(F.regexp_replace(header, r"[^,;|\t]", ""), 1, 1), F.lit(""))


def split_record(line: Column, sep: Column) -> tuple[Column, Column]:
    """(quoting is right, fields) of a record; with wrong quoting the fields are those of the quotes taken literally.

    A field that starts with a quote ends with one before a separator or the end and doubles its inner quotes;
    other fields hold none. The line is cut at its quotes: pieces with an even index stand outside quotes, and
    an empty one between two quoted pieces is a doubled quote. All native, in time linear in the line.
    """
    pieces = F.split(F.replace(line, F.lit(MARK), F.lit(KEEP)), '"')
    last = F.size(pieces) - 1
    outside = F.transform(pieces, lambda x, i: F.when(i % 2 == 0, F.struct(i.alias("i"), x.alias("x"))))
    fits = lambda p: (
        ((p.i == 0) | (p.i == last) | (p.x != ""))
        & ((p.i == 0) | (p.x == "") | (F.substring(p.x, 1, 1) == sep))
        & ((p.i == last) | (p.x == "") | (F.right(p.x, F.lit(1)) == sep))
    )
    inner_fits = lambda p: F.when((p.i > 0) & (p.i < last) & (p.x == ""), F.lit(True)).otherwise(fits(p))
    right = (last % 2 == 0) & F.forall(F.filter(outside, lambda p: p.isNotNull()), inner_fits)
    rebuilt = F.array_join(
        F.transform(
            pieces,
            lambda x, i: F.when(i % 2 == 1, x).when((i > 0) & (i < last) & (x == ""), F.lit('"')).otherwise(F.replace(x, sep, F.lit(SEP))),
        ),
        "",
    )
    fields = F.transform(F.split(rebuilt, SEP), lambda x: F.replace(x, F.lit(KEEP), F.lit(MARK)))
    return right, fields


def parse_lines(lines: DataFrame) -> DataFrame:
    """line_id, file_name, line_no, names, fields, shape: every line but headers, cut by its file's separator.

    lines: line_id, file_name, line_no, raw_line; other columns are ignored. shape is null for a line with the
    right quoting and column count, else the reason. A null line, or one of a file without a usable header, has
    the wrong column count. A carriage return at the end is allowed.
    """
    head = lines.where("line_no = 1").groupBy("file_name").agg(F.min_by("raw_line", "line_id").alias("header"))
    head = head.withColumn("sep", F.coalesce(separator(F.col("header")), F.lit(",")))
    names = F.transform(split_record(F.regexp_replace("header", r"\r$", ""), F.col("sep"))[1], lambda x: F.trim(x))
    head = small_side(head.select("file_name", "sep", names.alias("names")))
    body = lines.where("line_no IS NULL OR line_no <> 1").select("line_id", "file_name", "line_no", F.regexp_replace("raw_line", r"\r$", "").alias("line"))
    joined = body.join(head, "file_name", "left").withColumn("sep", F.coalesce("sep", F.lit(",")))
    right, fields = split_record(F.col("line"), F.col("sep"))
    shape = F.when(F.col("line").isNull() | F.col("names").isNull(), "column_count").when(~right, "quoting").when(F.size(fields) != F.size("names"), "column_count")
    return joined.select("line_id", "file_name", "line_no", "names", fields.alias("fields"), shape.alias("shape"))


def holds(kind: Column, value: Column, argument: Column) -> Column:
    """Whether a value obeys a rule of `kind`; an empty one does, except that a letter is required."""
    empty = value == ""
    real = F.try_to_timestamp(value, F.lit("yyyy-MM-dd")).isNotNull() & value.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return (
        F.when(kind == "letter", value.rlike(r"\p{L}"))
        .when(kind == "host", empty | value.rlike(HOST))
        .when(kind == "one_of", empty | F.array_contains(F.split(argument, r"\|"), F.lower(value)))
        .when(kind == "date", empty | real)
        .otherwise(True)
    )


def rejected(parsed: DataFrame, rules: list[tuple[str, str, str | None]]) -> DataFrame:
    """line_id, reason, columns: the lines that are no valid record, with the columns at fault.

    The cells of well-formed lines become rows of line, column and value, meet the rule table and are
    aggregated by line; the rule table has one row per rule and is broadcast.
    """
    spark = parsed.sparkSession
    table = F.broadcast(spark.createDataFrame(rules, "column string, kind string, argument string"))
    cells = parsed.where("shape IS NULL").select("line_id", F.explode(F.arrays_zip(F.col("names").alias("column"), F.col("fields").alias("value"))).alias("cell")).select("line_id", "cell.column", "cell.value")
    wrong = cells.join(table, "column").where(~holds(F.col("kind"), F.col("value"), F.col("argument")))
    values = wrong.groupBy("line_id").agg(F.lit("invalid_value").alias("reason"), F.array_sort(F.collect_set("column")).alias("columns"))
    shapes = parsed.where("shape IS NOT NULL").select("line_id", F.col("shape").alias("reason"), F.array().cast("array<string>").alias("columns"))
    return shapes.unionByName(values)


def accepted(parsed: DataFrame, errors: DataFrame, columns: list[str]) -> DataFrame:
    """The valid lines as rows of `columns`; what a file lacks is null. Of headers with one name the first counts."""
    clean = parsed.where("shape IS NULL").join(errors.select("line_id"), "line_id", "left_anti")
    at = lambda c: F.nullif(F.array_position("names", c), F.lit(0)).cast("int")
    return clean.select("line_id", "file_name", "line_no", *[F.try_element_at("fields", at(c)).alias(c) for c in columns])
