"""Landing data: typed scans, schema enforcement, session selection, idempotent session loads."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pitwall.functions import utc
from pitwall.operators.rows import qualify_first
from pitwall.schemas import SCHEMAS, partition_key
from pitwall.settings import NULL_TOKENS

PARTITIONS = ["meeting_key", "session_key"]


def _as(c: Column, kind: T.DataType, strict: bool) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        return c.cast("timestamp").cast("timestamp_ntz") if strict else utc(c)
    return c.cast(kind) if strict else c.try_cast(kind)


def conform(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """The schema's columns in its order and types; absent columns are NULL.

    Unreadable values become NULL, or raise when strict.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name not in have:
            c = F.lit(None).cast(f.dataType)
        elif have[f.name] == f.dataType:
            c = F.col(f.name)
        else:
            c = _as(F.col(f.name), f.dataType, strict)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_landing(df: DataFrame, root: str, feed: str) -> None:
    """One folder per meeting and session; a session with very many rows is written by several tasks."""
    by = [c for c in PARTITIONS if c in df.columns]
    time = next((c for c in ("date", "date_start") if c in df.columns), None)
    spread = df.repartitionByRange(*by, *([time] if time else []))
    spread.write.mode("overwrite").partitionBy(*by).parquet(f"{root}/{feed}")


def read_landing(spark: SparkSession, root: str, feed: str, sessions: Iterable[int] | None = None) -> DataFrame:
    """Scan of one feed with its declared schema; the session filter prunes folders."""
    df = spark.read.schema(SCHEMAS[feed]).parquet(f"{root}/{feed}")
    if sessions is not None:
        df = df.filter(F.col("session_key").isin(*[int(s) for s in sessions]))
    return df.select(*SCHEMAS[feed].fieldNames())


def read_json_landing(
    spark: SparkSession, path: str, feed: str, array_files: bool = True, tokens: Sequence[str] = NULL_TOKENS
) -> DataFrame:
    """JSON landing with null tokens.  A file holds one array, or one record per line when `array_files` is off."""
    schema = SCHEMAS[feed]
    arrays = {f.name for f in schema.fields if isinstance(f.dataType, T.ArrayType)}
    text = T.StructType([f if f.name in arrays else T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.schema(text).option("multiLine", array_files).json(path)
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if f.name not in arrays:
            for token in tokens:
                c = F.nullif(c, F.lit(token))
        cols.append(c.alias(f.name))
    return conform(raw.select(*cols), schema)


def read_variant_landing(spark: SparkSession, path: str, array_files: bool = True) -> DataFrame:
    """JSON landing whose fields change their type from record to record: one row per record, whole, in the VARIANT column `record`.

    Nothing is cast on the way in, so a gap that is a number here and a text there is both.
    """
    return spark.read.format("json").option("singleVariantColumn", "record").option("multiLine", array_files).load(path)


def field(record: Column, name: str, kind: str) -> Column:
    """A field of a VARIANT record as a type; NULL where it is absent or can't be that type."""
    return F.try_variant_get(record, f"$['{name}']", kind)


def variant_types(df: DataFrame, record: str = "record") -> dict[str, str]:
    """Per field of the records its type over all of them: numbers of several widths share the widest, and a field that is of different kinds in different
    records is a `VARIANT`.  All records count, not a sample: types are merged on the map side, and one text comes to the driver."""
    told = df.agg(F.schema_of_variant_agg(F.col(record))).first()[0] or ""
    inside = told[len("OBJECT<"):-1] if told.startswith("OBJECT<") else ""
    out, depth, begin = {}, 0, 0
    for i, c in enumerate(inside + ","):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            name, _, kind = inside[begin:i].strip().partition(": ")
            if name:
                out[name.strip("`")] = kind
            begin = i + 1
    return out


def typed_records(df: DataFrame, schema: T.StructType, tokens: Sequence[str] = NULL_TOKENS, record: str = "record", keep: Sequence[str] = ()) -> DataFrame:
    """VARIANT records as the columns of a feed, after the columns to `keep`: text fields take numbers as their text, other fields take texts that read as such, and
    null tokens are NULL."""
    cols = []
    for f in schema.fields:
        c = F.col(record)
        if isinstance(f.dataType, T.ArrayType):
            cols.append(field(c, f.name, f.dataType.simpleString()).alias(f.name))
            continue
        text = field(c, f.name, "string")
        for token in tokens:
            text = F.nullif(text, F.lit(token))
        cols.append(text.alias(f.name))
    kept = [T.StructField(c, df.schema[c].dataType) for c in keep]
    return conform(df.select(*keep, *cols), T.StructType([*kept, *schema.fields]))


def replace_sessions(df: DataFrame, path: str, feed: str) -> None:
    """Idempotent load: the sessions (meetings) present in `df` replace their stored rows, others stay.

    Rebalancing gathers small sessions into few files and splits a large one over several tasks.
    """
    key = partition_key(feed)
    df.hint("rebalance", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def select_sessions(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the wanted sessions; a session listed twice counts once."""
    return df.join(wanted.select(*keys).dropDuplicates(list(keys)), list(keys), "left_semi")


def discover_sessions(df: DataFrame, key: str, start: str, end: str, since: datetime.datetime, until: datetime.datetime) -> DataFrame:
    """Sessions that ended in [since, until), each once; sessions without both dates are skipped."""
    done = df.filter(F.col(start).isNotNull() & (F.col(end) >= F.lit(since)) & (F.col(end) < F.lit(until)))
    rest = [F.col(c) for c in df.columns if c not in (key, end)]
    return qualify_first(done, [key], [F.col(end), *rest])


def absent_only(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the target does not hold yet."""
    return df.join(target.select(*keys).distinct(), list(keys), "left_anti")


def session_calendar(df: DataFrame, start: str, keys: Sequence[str]) -> DataFrame:
    """Session days as one row per day and session, so a busy day is not gathered into one value."""
    return df.select(F.to_date(start).alias("day"), *keys).dropna(subset=["day"]).distinct()


def sessions_on(calendar: DataFrame, day: datetime.date) -> DataFrame:
    """Sessions of a run day; empty when it is not a session day."""
    return calendar.filter(F.col("day") == F.lit(day))


def typed_by_name(df: DataFrame) -> DataFrame:
    """Types for an inferred schema: text named `…date` or `…_at` is a time, numbers are doubles.

    Booleans and arrays keep their type.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType) and f.name.lower().endswith(("date", "_at")):
            c = utc(c)
        elif isinstance(f.dataType, T.NumericType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


AUDIT = {"processed_date": "date", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"}


def with_audit(df: DataFrame, now: datetime.datetime | None = None) -> DataFrame:
    """Adds missing audit columns and fills their gaps."""
    stamp = F.lit(now).cast("timestamp_ntz") if now else F.current_timestamp().cast("timestamp_ntz")
    out = df
    for name, kind in AUDIT.items():
        held = F.col(name) if name in df.columns else F.lit(None).cast(kind)
        out = out.withColumn(name, F.coalesce(held, stamp.cast(kind)))
    return out


def sync_schema(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Both sets of rows under the columns of either."""
    return target.unionByName(batch, allowMissingColumns=True)


def split_valid(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required fields, and the rejected rest."""
    complete = F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
    return df.filter(complete), df.filter(~complete)


def standard_names(df: DataFrame, text_fields: Sequence[str] = ()) -> DataFrame:
    """Upper-case column names; the given fields become text, with NULL as `None`."""
    forced = {c.lower() for c in text_fields}
    return df.select(
        *[
            (F.coalesce(F.col(c).cast("string"), F.lit("None")) if c.lower() in forced else F.col(c)).alias(c.upper())
            for c in df.columns
        ]
    )


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows range-partitioned and sorted by the columns, so files have narrow value ranges.

    Include the time among the columns, then a hot session is cut by time.
    """
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], partition: str = "event_date") -> None:
    clustered(df, columns).write.mode("overwrite").partitionBy(partition).parquet(path)


