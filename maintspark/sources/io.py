"""Sources and sinks.

CSV and JSON are read with explicit schemas (no inference pass over the data).
Timestamps are read as text and parsed with ``try_to_timestamp`` in several
formats (date-only strings are valid); rows that do not parse are returned
apart instead of failing the job.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S

TIME_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm", "yyyy/MM/dd",
                "M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy"]
#: Cell texts that stand for a missing number or time (after trimming, any case).
MISSING = ["", "na", "n/a", "nan", "null", "none", "-", "#n/a"]
# The texts that pandas reads as missing, exactly so written.
MISSING_TEXT = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
                "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def parse_time(c: Column, formats: Sequence[str] = TIME_FORMATS) -> Column:
    """S3: first format that parses; NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def present(c: Column) -> Column:
    """The cell's trimmed text, NULL for the usual missing-value texts."""
    t = F.trim(c)
    return F.when(~F.lower(t).isin(MISSING), t)


def parse_number(c: Column, kind: T.DataType) -> Column:
    """NULL when the text is no number of the type; whole numbers may be written ``1.0``."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        d = c.try_cast("decimal(38,6)")
        return F.coalesce(c.try_cast(kind), F.when(d == F.floor(d), d.try_cast(kind)))
    return c.try_cast(kind)


def convert(c: Column, field: T.StructField, time_cols: Sequence[str]) -> Column:
    """One conversion for batch and stream: a cell's text to the field's type. Texts stay as
    they are, blanks included, but for the few that mean a missing one."""
    if isinstance(field.dataType, T.StringType):
        return F.when(~c.isin(MISSING_TEXT), c)
    return parse_time(present(c)) if field.name in time_cols else parse_number(present(c), field.dataType)


def bad_row(schema: T.StructType, time_cols: Sequence[str] = (S.TIME,)) -> Column:
    """A row (of texts) with a number or time that is there but does not convert."""
    bad = F.lit(False)
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            bad = bad | (present(F.col(f.name)).isNotNull() & convert(F.col(f.name), f, time_cols).isNull())
    return bad


def read_csv(spark: SparkSession, path: str, schema: T.StructType, time_cols: Sequence[str] = (S.TIME,)
             ) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows). Every column is read as text and converted with
    ``try_cast`` / ``try_to_timestamp``; missing-value texts become NULL, and a row with
    another text that does not convert is bad. (Explicit conversion instead of the parser's corrupt-record column, which
    CSV column pruning skips for columns a query does not read.)
    A missing path raises ``FileNotFoundError`` (S4)."""
    _require(spark, path)
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    raw = spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE").csv(path)
    conv = [convert(F.col(f.name), f, time_cols) for f in schema.fields]
    tagged = raw.select(*[c.alias(f.name) for f, c in zip(schema.fields, conv)], bad_row(schema, time_cols).alias("_bad"),
                        F.to_json(F.struct(*[F.col(f.name) for f in schema.fields])).alias("_raw"))
    good = tagged.filter(~F.col("_bad")).select(*schema.names)
    bad_rows = tagged.filter(F.col("_bad")).select(F.col("_raw").alias("raw_record"))
    return good, bad_rows


def read_telemetry_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return read_csv(spark, path, S.TELEMETRY)


def read_failures_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return read_csv(spark, path, S.FAILURES)


def load_datasets(spark: SparkSession, data_path: str, telemetry_file: str = "telemetry.csv",
                  failures_file: str = "failures.csv") -> tuple[DataFrame, DataFrame]:
    """Both tables from a folder (local, HDFS or an object store URI); either
    one missing raises ``FileNotFoundError``. No row is dropped: missing values are NULL, and
    a file with rows that do not convert raises ``ValueError`` with the first of them
    (``read_telemetry_csv`` / ``read_failures_csv`` return such rows apart instead)."""
    base = data_path.rstrip("/")
    out = []
    for read, name in ((read_telemetry_csv, telemetry_file), (read_failures_csv, failures_file)):
        good, bad = read(spark, f"{base}/{name}")
        if (first := bad.limit(3).collect()):
            raise ValueError(f"{name}: rows that do not convert, such as " + "; ".join(r.raw_record for r in first))
        out.append(good)
    return out[0], out[1]


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    """CSV files with a header, one a task; times with microseconds, missing values empty."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    told = df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in times}) if times else df
    told.write.mode(mode).options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def _require(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p) and not fs.globStatus(p):
        raise FileNotFoundError(path)


#: Partition column of stages; a table's own column ``month`` is left alone.
STAGE_MONTH = "_stage_month"


def stage_name(name: str) -> str:
    """A table name of this session that is not yet taken."""
    return f"stage_{name}_{uuid.uuid4().hex}"


def write_stage_table(df: DataFrame, name: str, path: str, key: str = S.KEY, time: str = S.TIME, buckets: int | None = None) -> None:
    """S5 as the table ``name`` at ``path``: by month, within it bucketed by machine and sorted by
    time. Windows and joins by machine over the table need no exchange, and a filter on
    ``STAGE_MONTH`` reads its months only. ``buckets``: the session's shuffle partitions by default.
    The rows are dealt by machine before they are written, so a bucket of a month is one file."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn(STAGE_MONTH, F.date_format(F.col(time), "yyyy-MM")).repartition(n, key)
    dealt.write.partitionBy(STAGE_MONTH).bucketBy(n, key).sortBy(key, time).option("path", path).format("parquet").saveAsTable(name)


def write_stage(df: DataFrame, path: str, time: str | None = S.TIME, mode: str = "overwrite") -> None:
    """Stage interchange as parquet, partitioned by month of ``time`` (not by machine:
    machines are many, months few); ``read_stage`` selects months by time."""
    w = df
    if time and time in df.columns:
        w = df.withColumn(STAGE_MONTH, F.date_format(F.col(time), "yyyy-MM"))
        w.write.mode(mode).partitionBy(STAGE_MONTH).parquet(path)
    else:
        w.write.mode(mode).parquet(path)


def read_stage(spark: SparkSession, path: str, time_from: str | None = None, time_to: str | None = None,
               time: str = S.TIME) -> DataFrame:
    """A written stage with its own columns. ``time_from`` (included) and ``time_to``
    (excluded) also select the months, so other partitions are not read."""
    df = spark.read.parquet(path)
    if STAGE_MONTH not in df.columns:
        return df
    if time_from is not None:
        df = df.filter((F.col(STAGE_MONTH) >= time_from[:7]) & (F.col(time) >= F.lit(time_from).cast("timestamp_ntz")))
    if time_to is not None:
        df = df.filter((F.col(STAGE_MONTH) <= time_to[:7]) & (F.col(time) < F.lit(time_to).cast("timestamp_ntz")))
    return df.drop(STAGE_MONTH)


RUN_RECORD = T.StructType([f for f in S.MODEL_RUN.fields])


def read_runs_json(spark: SparkSession, path: str) -> DataFrame:
    """Model-run records stored as one JSON object ``{version: {...}}`` per file.
    Each file is one small record map; it is parsed with a fixed map schema and exploded."""
    _require(spark, path)
    text = spark.read.text(path, wholetext=True)
    m = F.from_json(F.col("value"), T.MapType(T.StringType(), RUN_RECORD))
    rows = text.select(F.explode(m).alias("key", "r"))
    return rows.select(*[F.coalesce(F.col("r.version"), F.col("key")).alias("version") if n == "version"
                         else F.col(f"r.{n}").alias(n) for n in RUN_RECORD.names])


def write_runs_jsonl(runs: DataFrame, path: str) -> None:
    """Model-run table as JSON lines (one record per line, written by every task)."""
    runs.write.mode("overwrite").json(path)


def read_runs_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_RECORD).json(path)


def write_evaluation_json(evaluation: DataFrame, path: str) -> None:
    """The evaluation record(s) as JSON lines."""
    evaluation.write.mode("overwrite").json(path)


BATCH_REQUEST = T.StructType([T.StructField("predictions", T.ArrayType(S.READING), True)])


def read_batch_requests(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, each ``{"predictions": [reading, ...]}`` -> one row per reading."""
    return spark.read.schema(BATCH_REQUEST).json(path).select(F.inline("predictions"))


def explode_batch(df: DataFrame, column: str = "predictions") -> DataFrame:
    """S13 on a string column holding a batch request body."""
    return df.select(F.inline(F.from_json(F.col(column), BATCH_REQUEST)["predictions"]))
