"""Click cap per key, with one warning for each key that goes over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallywake.operators.rank import LIMIT_BEFORE_SHUFFLE, numbered

# Fixed value: text of the warning.
WARNING = "看广告有瘾，建议送到精神病院"


def cap_outcomes(df: DataFrame, keys: Sequence[str], ts: str, seq: str, max_count: int, reset: str = "never",
                 zone: str = "Asia/Shanghai") -> DataFrame:
    """The first `max_count` rows of each key with outcome 'pass', the one after them with 'blacklist'.

    `reset='daily'` starts the count afresh at midnight in `zone`. Later rows of a capped key are dropped
    by each map task before the shuffle (a rank limit), so a key with any number of rows sends
    max_count + 1 rows a task. For caps too large for that the rows are numbered by range of time.
    """
    parts = list(keys)
    if reset == "daily":
        local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(ts).cast("timestamp_ntz"))
        df, parts = df.withColumn("day", local.cast("date")), [*parts, "day"]
    elif reset != "never":
        raise ValueError(f"reset must be 'never' or 'daily', not {reset!r}")
    if max_count + 1 < LIMIT_BEFORE_SHUFFLE:
        placed = df.withColumn("nth", F.row_number().over(Window.partitionBy(*parts).orderBy(ts, seq)))
    else:
        placed = numbered(df, parts, [ts, seq], "nth")
    ranked = placed.where(F.col("nth") <= max_count + 1)
    return ranked.withColumn("outcome", F.when(F.col("nth") <= max_count, "pass").otherwise("blacklist"))


def click_cap(outcomes: DataFrame) -> DataFrame:
    """The rows within the cap."""
    return outcomes.where("outcome = 'pass'").drop("nth", "outcome")


def blacklist(outcomes: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """One warning per key (and day) that goes over the cap, at the first row over it."""
    days = ["day"] if "day" in outcomes.columns else []
    return outcomes.where("outcome = 'blacklist'").select(*keys, *days, ts, F.lit(WARNING).alias("msg"))
