"""Reading and normalising the attack-count statistics table.

The input is one row per (attack type, measure, period), with the period split
into parts ``year``/``month``/``day``/``hour``: zero-padded text, or integers.
Normalisation happens once, at load: the series key is trimmed and rows without
a key are dropped, so every later grouping and equality works on clean keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TYPE_COL = "attack_type"
MEASURE_COL = "sum"
RAW_MEASURE_COL = "_raw_measure"  # text sources only: the measure before the numeric cast
PART_COLS = ("year", "month", "day", "hour")
# Zero-padded width of each period part.
PART_WIDTH = {"year": 4, "month": 2, "day": 2, "hour": 2}

STAT_SCHEMA = T.StructType(
    [
        T.StructField(TYPE_COL, T.StringType(), True),
        T.StructField(MEASURE_COL, T.DoubleType(), True),
        T.StructField("year", T.StringType(), True),
        T.StructField("month", T.StringType(), True),
        T.StructField("day", T.StringType(), True),
        T.StructField("hour", T.StringType(), True),
    ]
)


def validate(df: DataFrame) -> DataFrame:
    """Fail early (before any job runs) when a required column is missing."""
    missing = [f.name for f in STAT_SCHEMA.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"statistics table lacks columns {missing}; has {df.columns}")
    return df


def normalize(df: DataFrame, trim_keys: bool = True, exact_scale: int | None = None) -> DataFrame:
    """Project the six contract columns, trim the key, drop rows without a key.

    The measure is cast to double (integer and text columns sum the same way;
    text that is not a number sums as NULL but still counts as present for the
    legacy count, kept in ``_raw_measure``).
    Period parts stay as stored, text or integers (integer parts also come from
    partition directories such as ``month=1``): rollups group on
    their integer values, so ``1`` and ``01`` are one period, and render
    zero-padded text only after aggregation, once per (series, period) instead
    of once per raw row.  Nothing else is filtered: null
    measures are kept because the legacy count rollup must see their groups.

    A sum of doubles depends in its last bits on the order of its terms, and with
    fractional measures a truncated forecast may then differ by one between task
    layouts.  ``exact_scale`` sums decimals of that many digits after the point
    instead: the sums, cast to double at the end, are the same for every layout.

    ``trim_keys=False`` is for tables whose stored keys are already trimmed: the
    key then stays a plain column, so a filter on one series (even one applied
    to a finished prediction table, which Catalyst moves below the per-series
    window) reaches the Parquet reader as a pushed equality.
    """
    validate(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    key = F.trim(F.col(TYPE_COL)) if trim_keys else F.col(TYPE_COL)
    measure = F.col(MEASURE_COL)
    text_measure = isinstance(types[MEASURE_COL], T.StringType)
    # A text measure is summed the way Hive sums text: numbers count, anything
    # else becomes NULL (ignored by the sums) instead of failing the job.  The
    # legacy count, like Hive's count(sum), counts every non-null raw value, so
    # the raw text is kept alongside for it.
    extra = [measure.alias(RAW_MEASURE_COL)] if text_measure else []
    kind = "double" if exact_scale is None else f"decimal(28,{exact_scale})"
    measure = measure.cast(kind) if kind == "double" and not text_measure else measure.try_cast(kind)
    parts = [F.col(c) if isinstance(types[c], (T.IntegralType, T.StringType)) else F.col(c).cast("string")
             for c in PART_COLS]
    # trim(x) is null exactly when x is, so the null test goes on the raw column,
    # where Parquet can evaluate it (PushedFilters: IsNotNull(attack_type)).
    return df.where(F.col(TYPE_COL).isNotNull()).select(
        key.alias(TYPE_COL),
        measure.alias(MEASURE_COL),
        *[p.alias(c) for p, c in zip(parts, PART_COLS)],
        *extra,
    )


def part_int(df: DataFrame, name: str):
    """A period part as an integer; text that is none is NULL."""
    part = F.col(name)
    return part.try_cast("int") if isinstance(df.schema[name].dataType, T.StringType) else part.cast("int")


def part_text(name: str):
    """An integer period part as text, zero-padded to the contract width."""
    return F.lpad(F.col(name).cast("string"), PART_WIDTH[name], "0")


def read_stat_parquet(spark: SparkSession, path: str, *, trim_keys: bool = True,
                      exact_scale: int | None = None) -> DataFrame:
    """Parquet statistics table (column pruning and pushdown come from the scan)."""
    return normalize(spark.read.parquet(path), trim_keys=trim_keys, exact_scale=exact_scale)


def read_stat_table(spark: SparkSession, name: str, *, trim_keys: bool = True,
                    exact_scale: int | None = None) -> DataFrame:
    """Catalog table (Hive or any other catalog the caller's session is bound to)."""
    return normalize(spark.table(name), trim_keys=trim_keys, exact_scale=exact_scale)


def spellings(raw: DataFrame) -> DataFrame:
    """The key dictionary of a raw table: (spelling, key), each distinct stored key and its trimmed form.

    One scan of one column, reduced in the tasks; worth storing beside the table.
    """
    return raw.select(F.col(TYPE_COL).alias("spelling")).where("spelling IS NOT NULL").distinct().select("spelling", F.trim("spelling").alias("key"))


def select_series(raw: DataFrame, keys: list[str], dictionary: DataFrame | None = None, *, most: int = 10_000) -> DataFrame:
    """The rows of a raw table whose trimmed key is one of ``keys``, by a predicate that reaches the scan.

    The trimmed key is an expression, which a Parquet reader cannot test; the
    stored spellings of the keys, looked up in ``dictionary`` (``spellings(raw)`` by
    default), are values, and ``IN`` on them is pushed.  Keys with more than
    ``most`` spellings together are tested on the trimmed key instead.
    """
    known = (spellings(raw) if dictionary is None else dictionary).where(F.col("key").isin(keys))
    found = [r.spelling for r in known.select("spelling").limit(most + 1).collect()]
    if len(found) > most:
        return raw.where(F.trim(TYPE_COL).isin(keys))
    return raw.where(F.col(TYPE_COL).isin(found))


def on_days(df: DataFrame, days: list[str]) -> DataFrame:
    """Rows of the given days (``yyyy-MM-dd``), or of months where all are ``yyyy-MM``.

    The parts are held against their values as they are stored, text in either
    spelling or integers, so that the predicates reach the scan or prune partitions;
    the exact test of the day follows.
    """
    def stored(name: str, at: slice) -> list:
        values = sorted({int(d[at]) for d in days})
        if not isinstance(df.schema[name].dataType, T.StringType):
            return values
        return sorted({str(v) for v in values} | {f"{v:0{PART_WIDTH[name]}d}" for v in values})

    places = (("year", slice(0, 4)), ("month", slice(5, 7)), ("day", slice(8, 10)))[:2 if all(len(d) == 7 for d in days) else 3]
    for name, at in places:
        df = df.where(F.col(name).isin(stored(name, at)))
    exact = F.lit(False)
    for d in sorted(set(days)):
        of = F.lit(True)
        for name, at in places:
            of = of & (part_int(df, name) == int(d[at]))
        exact = exact | of
    return df.where(exact)


def restrict_days(df: DataFrame, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Keep rows whose day lies in [first_day, last_day] (``yyyy-MM-dd``).

    The year bound compares the ``year`` column as it is stored, a text year (four
    digits by contract) with text and an integer year with an integer, so it reaches
    the Parquet scan (``PushedFilters``, row-group skipping) or prunes ``year``
    partitions; a bound on the months, by value, prunes ``month`` partitions below
    them, and the exact day bound is applied after both.  Rows whose parts are
    no calendar date are left out.
    """
    text = isinstance(df.schema["year"].dataType, T.StringType)
    year = lambda d: F.lit(d[:4] if text else int(d[:4]))
    day = F.try_make_timestamp_ntz(part_int(df, "year"), part_int(df, "month"), part_int(df, "day"),
                                   F.lit(0), F.lit(0), F.lit(0)).cast("date")
    months = part_int(df, "year") * 12 + part_int(df, "month")
    month = lambda d: int(d[:4]) * 12 + int(d[5:7])
    if first_day is not None:
        df = df.where(months >= month(first_day)).where((F.col("year") >= year(first_day)) & (day >= F.lit(first_day).cast("date")))
    if last_day is not None:
        df = df.where(months <= month(last_day)).where((F.col("year") <= year(last_day)) & (day <= F.lit(last_day).cast("date")))
    return df
