"""CSV entities in and out.

Source files are UTF-8 (a BOM is stripped by Spark), comma separated, with a
header. Columns are found by their header name, in any order; columns that the
entity does not have are ignored, a missing one fails the read. Only the empty
field is NULL; text such as "NA" stays a value. Types are explicit, never
inferred; zip codes and VAT numbers are text so leading zeros survive.

Nothing is lost without a trace: a record with more or fewer fields than the
header, with a value that does not have its type, or with a quoted field that
nothing closes is malformed. By default reading such a record fails; a load
quarantines it instead.

A file is split among tasks by lines. Where no line leaves a quoted field open,
every line is a record; where one does, ``csv_records`` puts the lines of a
record together, with several tasks per file all the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import released_shuffles
from .csv_records import has_quoted_line_ends, records

CORRUPT = "_corrupt_record"

CUSTOMERS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("fiscal_code_hash", T.StringType()),
    T.StructField("birth_date", T.DateType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("zip_code", T.StringType()),
    T.StructField("registration_datetime", T.TimestampNTZType()),
    T.StructField("has_marketing_consent", T.IntegerType()),
    T.StructField("status", T.StringType()),
])

SUPPLIERS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("vat_number", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("zip_code", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("is_active", T.IntegerType()),
])

OPERATORS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("hire_date", T.DateType()),
    T.StructField("activity_type", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("status", T.StringType()),
])

REQUESTS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("supplier_id", T.LongType()),
    T.StructField("operator_id", T.LongType()),
    T.StructField("request_datetime", T.TimestampNTZType()),
    T.StructField("completed_datetime", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("service_duration_minutes", T.IntegerType()),
    T.StructField("notes", T.StringType()),
])

SCHEMAS = {"customers": CUSTOMERS_SCHEMA, "suppliers": SUPPLIERS_SCHEMA,
           "operators": OPERATORS_SCHEMA, "requests": REQUESTS_SCHEMA}

_READ_OPTIONS = {
    "header": "true",
    "escape": '"',             # doubled quotes inside quoted fields
    "nullValue": "",           # only the empty field is NULL ("NA" is a province)
    "nanValue": "NaN",
    "mode": "PERMISSIVE",
    "encoding": "UTF-8",
    "enforceSchema": "false",  # a file whose header line differs from the first one's fails
    "columnPruning": "false",  # fields are counted whatever columns a query selects
    "ignoreLeadingWhiteSpace": "false",   # text is kept byte for byte
    "ignoreTrailingWhiteSpace": "false",
}
_RAW = "_raw_line"
RAGGED = "fields"  # named in ``_corrupt_record`` when a record has too many or too few
TORN = "quotes"  # named there when nothing closes a quoted field
_NO_QUOTE = "\uffff"  # not a character: lines are first read without quoting


def _plain_lines(reader, path: str) -> DataFrame:
    """``line, torn`` of every line but the headers. Read without quoting a
    line is its fields joined by commas."""
    plain = reader.option("quote", _NO_QUOTE)
    header = plain.csv(path).columns
    fields = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _RAW]])
    read = plain.option("columnNameOfCorruptRecord", _RAW).schema(fields).csv(path).toDF(
        *[f"f{i}" for i in range(len(header))], _RAW)
    joined = F.concat_ws(",", *[F.coalesce(F.col(f"f{i}"), F.lit("")) for i in range(len(header))])
    return read.select(F.coalesce(_RAW, joined).alias("line"), F.lit(False).alias("torn"))


def _record_lines(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """``line, torn`` of every record but the headers, which must all be ``header``."""
    read = records(spark, path).select(F.regexp_replace("line", "\r$", "").alias("line"), "torn", "header")
    names = F.from_csv(F.regexp_replace("line", "^\ufeff", ""), ", ".join(f"c{i} string" for i in range(len(header))),
                       _parse_options())
    same = F.coalesce(F.concat_ws("\n", *[names[f"c{i}"] for i in range(len(header))]) == "\n".join(header), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("another header than in the first file: "), F.col("line"))).cast("boolean")
    return read.where(F.when(~F.col("header"), F.trim("line") != "").when(same, False).otherwise(wrong)).select("line", "torn")


def _parse_options() -> dict[str, str]:
    """For one record's text: line ends inside quotes are kept."""
    options = {k: v for k, v in _READ_OPTIONS.items() if k not in ("header", "enforceSchema", "encoding")}
    return options | {"multiLine": "true"}


def _fields(lines: DataFrame, text: T.StructType) -> DataFrame:
    """The columns of ``text`` and ``_torn`` of every line."""
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in text.names)
    parsed = F.from_csv("line", schema, _parse_options() | {"columnNameOfCorruptRecord": _RAW})
    # a generator: filters on its output do not parse the line again
    return lines.select(F.inline_outer(F.array(F.struct(parsed.alias("p"), F.col("torn").alias("_torn"))))).select("p.*", "_torn")


def read_entity(spark: SparkSession, path: str, entity: str, keep_corrupt: bool = False) -> DataFrame:
    """Read one entity CSV (file or folder; all files have the first
    one's header) with its fixed types. One job looks for quoted line ends.

    Fields are read as text and cast with ``try_cast``; a field whose text is
    present but does not cast is malformed. With ``keep_corrupt`` the names of
    such fields (``fields`` for a ragged record, ``quotes`` for a field that
    nothing closes) are listed in ``_corrupt_record``, NULL when the record is
    clean; without it a malformed record fails the query that reads it.
    """
    schema = SCHEMAS[entity]

    def reader():
        return spark.read.options(**_READ_OPTIONS)

    header = reader().csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _RAW]])
    several = has_quoted_line_ends(spark, path)
    raw = _fields(_record_lines(spark, path, header) if several else _plain_lines(reader(), path), text)
    bad = [F.when(F.col(_RAW).isNotNull(), F.lit(RAGGED)), F.when(F.col("_torn"), F.lit(TORN))] + [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    names = F.concat_ws(",", *bad)
    typed = raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) if not isinstance(f.dataType, T.StringType)
                         else F.col(f.name) for f in schema.fields], F.when(names != "", names).alias(CORRUPT))
    if keep_corrupt:
        return typed
    told = F.concat(F.lit(f"malformed record in {entity}: id "), F.coalesce(F.col("id").cast("string"), F.lit("NULL")),
                    F.lit(", "), F.col(CORRUPT))
    return typed.where(F.when(F.col(CORRUPT).isNotNull(), F.raise_error(told).cast("boolean")).otherwise(True)) \
                .drop(CORRUPT)


def split_corrupt(df: DataFrame, table: str, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Rows that parsed vs quarantine rows (``table, key, reason``) for lines
    with a malformed value (divergence: the whole file does not fail)."""
    bad = F.col(CORRUPT).isNotNull()
    good = df.where(~bad).drop(CORRUPT)
    q = df.where(bad).select(F.lit(table).alias("table"), F.col(key).cast("string").alias("key"),
                             F.lit("malformed_value").alias("reason"))
    return good, q


def serialise(df: DataFrame) -> DataFrame:
    """Dates as ``yyyy-MM-dd``, timestamps as ``yyyy-MM-dd HH:mm:ss``;
    NULL stays NULL (written as the empty field)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_entity(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header, comma, minimal quoting, NULL as the empty field."""
    out = (serialise(df).write.mode(mode)
        .option("header", "true").option("nullValue", "").option("emptyValue", '""')
        .option("escape", '"').option("quoteAll", "false")
        # the writer trims spaces and newlines at both ends by default: keep them
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))
    with released_shuffles(df.sparkSession):
        out.csv(path)
