"""Text lines to typed event rows: comma-separated records and access-log lines.

The decoders work on any DataFrame with a `value` column of lines: files, a stream of files or a topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywake.functions.times import from_epoch
from tallywake.schemas import TIME_UNIT

# Place of each field in a whitespace-separated access-log line, and its time format.
LOG_FIELDS = {"ip": 0, "user_id": 2, "ts": 3, "method": 5, "url": 6}
LOG_TIME = "dd/MM/yyyy:HH:mm:ss"

MODES = ("FAILFAST", "DROPMALFORMED", "PERMISSIVE")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the files that appear in a folder."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder)


def decode_records(lines: DataFrame, schema: str, mode: str = "FAILFAST", keep: tuple[str, ...] = ()) -> DataFrame:
    """Comma-separated `value` lines to the columns of `schema` by position, plus event time `ts`.

    Extra fields are ignored, an empty text field becomes null. A missing field or a bad number fails
    the job (FAILFAST), drops the line (DROPMALFORMED) or leaves nulls (PERMISSIVE). `keep` names
    columns of the input to pass on.
    """
    fields = T.StructType.fromDDL(schema).fields
    columns = {f.name: _typed(F.get("_parts", F.lit(i)), f.dataType) for i, f in enumerate(fields)}
    needed = [f.name for f in fields if not isinstance(f.dataType, T.StringType)]
    rows = _records(lines, F.split("value", ","), len(fields), columns, needed, mode, keep)
    return rows.withColumn("ts", from_epoch("timestamp", TIME_UNIT.get(schema, "s")))


def decode_access_log(lines: DataFrame, mode: str = "FAILFAST", keep: tuple[str, ...] = ()) -> DataFrame:
    """Access-log `value` lines to ip, user_id, ts, method, url. The zone field is ignored."""
    columns = {name: F.get("_parts", F.lit(i)) for name, i in LOG_FIELDS.items()}
    columns["ts"] = F.try_to_timestamp(columns["ts"], F.lit(LOG_TIME))
    width = max(LOG_FIELDS.values()) + 1
    return _records(lines, F.split("value", r"\s+"), width, columns, ["ts"], mode, keep)


def encode_records(rows: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows to comma-separated `value` lines, nulls as empty fields."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return rows.select(*keep, F.concat_ws(",", *fields).alias("value"))


def _typed(field: Column, dtype: T.DataType) -> Column:
    return F.nullif(field, F.lit("")) if isinstance(dtype, T.StringType) else field.try_cast(dtype)


def _records(lines: DataFrame, parts: Column, width: int, columns: dict[str, Column], needed: list[str], mode: str,
             keep: tuple[str, ...]) -> DataFrame:
    """Split each line once, type its fields once, and deal with lines that have too few fields or
    nothing in a `needed` one."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    typed = lines.select(*keep, "value", parts.alias("_parts")).select(
        *keep, "value", (F.size("_parts") >= width).alias("_complete"), *[c.alias(n) for n, c in columns.items()])
    complete = F.col("_complete")
    for name in needed:
        complete = complete & F.col(name).isNotNull()
    record = F.struct(*columns)
    if mode == "FAILFAST":
        bad = F.raise_error(F.concat(F.lit("malformed line: "), F.coalesce("value", F.lit("null"))))
        record = F.when(complete, record).otherwise(bad)
    elif mode == "DROPMALFORMED":
        record = F.when(complete, record)
    # A generator rather than a projection: later filters are not moved below it, where they would parse
    # every line again, and every line is checked whichever columns are used.
    records = F.array(record) if mode != "DROPMALFORMED" else F.array_compact(F.array(record))
    return typed.select(*keep, F.inline(records))
