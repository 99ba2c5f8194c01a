"""Schemas, readers and writers of the logical tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsight.functions import parse_wall_clock

MONEY = "decimal(18,2)"

SCHEMAS = {
    "plans": "plan_id int, plan_name string, plan_tier string, "
    f"monthly_price_usd {MONEY}, annual_price_usd {MONEY}",
    "subscriptions": "subscription_id bigint, customer_id bigint, plan_id int, status string, "
    "billing_cycle string, start_date date, end_date date, mrr_usd double, "
    "discount_pct double, trial_end_date date, cancellation_reason string",
    "customers": "customer_id bigint, company_name string, industry string, "
    "company_size string, country_code string, country_name string, timezone string, "
    "contact_email string, signup_date string, is_active boolean, "
    "churned_at timestamp_ntz, churn_reason string, nps_score int",
    "support_tickets": "ticket_id bigint, customer_id bigint, member_id bigint, "
    "category string, priority string, status string, created_at timestamp_ntz, "
    "resolved_at timestamp_ntz, satisfaction_score int, escalated boolean",
    "billing_invoices": f"customer_id bigint, amount_usd {MONEY}, status string",
    "team_members": "customer_id bigint, email string",
}

# Quotes are doubled and white space is kept, as spreadsheets write and read them.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}

# What the reader puts for a quoted empty field, which it would otherwise take for NULL.
QUOTED_EMPTY = "\x00"

# The names under which event documents carry the two ids. They differ in
# case only, so they are paths into a variant, never column names.
CUSTOMER_FIELDS = ("customer_id", "customerId", "customerID")
MEMBER_FIELDS = ("member_id", "memberId", "userId", "userID")


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[table])


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table; a NaN in a floating column is read as NULL."""
    df = spark.read.parquet(path)
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats}) if floats else df


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    rejected: str | None = None,
    **options: str,
) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass over the data).

    Fields may hold quotes, separators and line feeds, so a file is read by one task: files that
    `write_csv` wrote are as many as it had tasks. A row that does not fit the schema fails the
    read; with `rejected` its text is kept in a column of that name and the row's unreadable
    fields are NULL.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    checked = {"multiLine": True, "enforceSchema": False, "emptyValue": QUOTED_EMPTY}
    reader = spark.read.options(**{**CSV_OPTIONS, **checked, **options})
    if rejected is None:
        df = reader.option("mode", "FAILFAST").schema(schema).csv(path)
    else:
        wide = T.StructType([*schema.fields, T.StructField(rejected, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", rejected)
        df = reader.schema(wide).csv(path)
    texts = [f.name for f in schema if isinstance(f.dataType, T.StringType)]
    empty = {c: F.when(F.col(c) == QUOTED_EMPTY, "").otherwise(F.col(c)) for c in texts}
    return df.withColumns(empty) if texts else df


def read_query(
    spark: SparkSession,
    url: str,
    query: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 1,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Result of a query that the relational store runs; credentials come in `properties`.

    With `split_column` and `bounds` the result is read in `splits` parallel parts.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    if split_column is None:
        return reader.option("query", query).load()
    if bounds is None:
        raise ValueError("split_column needs bounds")
    low, high = bounds
    return (
        reader.option("dbtable", f"({query}) AS t")
        .option("partitionColumn", split_column)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", splits)
        .load()
    )


def _path(field: str, kind: str, of: str = "doc") -> Column:
    return F.try_variant_get(F.col(of), f"$.{field}", kind)


def documents(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to one variant column `doc`; text that is not JSON is dropped.

    Each text is parsed once, whatever is asked of `doc` afterwards.
    """
    parsed = _looked_up(lines, F.try_parse_json(F.col(column)).alias("doc"))
    return parsed.filter(F.col("doc").isNotNull())


def document_report(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines read, and those that `documents` drops as they are not JSON."""
    counts = lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.try_parse_json(F.col(column)).isNull()).alias("not JSON"),
    )
    return counts.unpivot([], ["lines", "not JSON"], "step", "documents")


def scan_documents(spark: SparkSession, path: str) -> DataFrame:
    """NDJSON files as `doc` (variant) and `rejected` (the text of a line that is no document).

    A document is a JSON object. Blank lines are skipped. Every other line is one row with one
    of the two columns, so the rejected ones can be kept, counted and mended.
    """
    schema = "doc variant, _corrupt_record string"
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    reader = reader.option("singleVariantColumn", "doc")
    is_object = F.try_variant_get(F.col("doc"), "$", "map<string,variant>").isNotNull()
    return reader.json(path).select(
        F.when(is_object, F.col("doc")).alias("doc"),
        F.coalesce("_corrupt_record", F.when(~is_object, F.to_json("doc"))).alias("rejected"),
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents of NDJSON files in one variant column, whatever fields they carry."""
    return scan_documents(spark, path).select("doc").filter(F.col("doc").isNotNull())


def scan_report(scanned: DataFrame) -> DataFrame:
    """Documents and rejected lines of `scan_documents`."""
    counts = scanned.agg(
        F.count("doc").alias("documents"), F.count("rejected").alias("rejected lines")
    )
    return counts.unpivot([], counts.columns, "step", "lines")


def document_fields(docs: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Typed columns from documents: output name -> ``field type`` (e.g. ``"step string"``)."""
    return docs.select(
        *[_path(*spec.split()).alias(name) for name, spec in fields.items()]
    )


# The keys under which exported documents write a number of a certain type.
TYPED_NUMBERS = ("$numberInt", "$numberLong", "$numberDouble", "$numberDecimal")


def _first_present(fields: Sequence[str]) -> Column:
    """The first field that is there and no explicit null, as a variant."""
    found = [_path(f, "variant") for f in fields]
    return F.coalesce(*[F.when(~F.is_variant_null(v), v) for v in found])


def _whole_number(name: str) -> Column:
    """A variant column as a whole number, by value: a fraction is cut off.

    It is a number in any notation, an object with the text of a typed number, or text of a
    whole number; anything else is NULL.
    """
    typed = F.try_variant_get(F.col(name), "$", "map<string,string>")
    text = F.coalesce(*[F.try_element_at(typed, F.lit(key)) for key in TYPED_NUMBERS])
    by_value = text.try_cast("decimal(38,9)").try_cast("bigint")
    return F.coalesce(F.try_variant_get(F.col(name), "$", "bigint"), by_value)


def _document_time(name: str = "time") -> Column:
    """Plain text, or the ``{"$date": ...}`` form of an exported native date."""
    texts = [_path("$date", "string", name), F.try_variant_get(F.col(name), "$", "string")]
    millis = _path("$date.$numberLong", "string", name).try_cast("bigint")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    native = epoch + F.make_dt_interval(secs=(millis / 1000).cast("decimal(18,6)"))
    return F.coalesce(native, reduce(F.coalesce, [parse_wall_clock(t) for t in texts]))


def _looked_up(docs: DataFrame, *fields: Column) -> DataFrame:
    """The fields of each document as columns that later filters do not look up again.

    As the row of a one-row table; a projection would be copied into each filter above it.
    """
    return docs.select(F.inline(F.array(F.struct(*fields))))


def activity_events(docs: DataFrame) -> DataFrame:
    """Normalised activity events from variant documents; every field is looked up once."""
    found = _looked_up(
        docs,
        _first_present(CUSTOMER_FIELDS).alias("customer"),
        _first_present(MEMBER_FIELDS).alias("member"),
        _path("timestamp", "variant").alias("time"),
        _path("event_type", "string").alias("event_type"),
        _path("feature", "string").alias("feature"),
        _path("session_duration_sec", "double").alias("session_duration_sec"),
    )
    return found.select(
        _whole_number("customer").alias("customer_id"),
        _whole_number("member").alias("member_id"),
        _document_time().alias("ts"),
        "event_type",
        "feature",
        "session_duration_sec",
    )


def onboarding_events(docs: DataFrame, id_field: str | None = None) -> DataFrame:
    """Normalised onboarding events from variant documents; `id_field` is kept as a number."""
    ids = [_path(id_field, "bigint").alias(id_field)] if id_field else []
    found = _looked_up(
        docs,
        *ids,
        _first_present(MEMBER_FIELDS).alias("member"),
        _path("timestamp", "variant").alias("time"),
        _path("step", "string").alias("step"),
        F.coalesce(_path("completed", "boolean"), F.lit(False)).alias("completed"),
        _path("duration_seconds", "double").alias("duration_seconds"),
    )
    return found.select(
        *[id_field] * bool(id_field),
        _whole_number("member").alias("member_id"),
        _document_time().alias("ts"),
        "step",
        "completed",
        "duration_seconds",
    )


def has_field(field: str) -> Column:
    """Whether a document carries the field, an explicit null included."""
    return _path(field, "variant").isNotNull()


def document_presence(docs: DataFrame, fields: Sequence[str] = CUSTOMER_FIELDS) -> DataFrame:
    """Documents per combination of present and missing fields, fields told apart by case.

    A field that holds an explicit null is present.

    The result has one row per combination: the present fields as text, and the count.
    """
    names = [F.when(has_field(f), F.lit(f)) for f in fields]
    return (
        docs.groupBy(F.concat_ws(",", *names).alias("present_fields"))
        .agg(F.count(F.lit(1)).alias("documents"))
        .orderBy("present_fields")
    )


def write_table(df: DataFrame, path: str) -> None:
    """Parquet, the hand-over format between stages."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, **options: str) -> None:
    """CSV part files with a header, for tools outside Spark.

    NULL is an empty field and empty text is quoted, so `read_csv` tells them apart.
    """
    df.write.mode("overwrite").options(**{**CSV_OPTIONS, **options}).csv(path)
