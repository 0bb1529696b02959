"""Scans and sinks.

* Dated CSV folders: one file per day, the date is part of the file path.
  Columns are read as strings (never inferred) and coerced afterwards; the
  date comes from ``_metadata.file_path`` so a date predicate prunes files
  before they are opened.
* Files whose headers list the same columns in another order are read per
  header group and combined with ``unionByName`` (Spark applies one header
  by position otherwise). Finding the headers reads the matching files once
  more; naming the columns saves that.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import IDENTIFIER_COLUMNS, NEAR_ZERO_VARIANCE_COLUMNS
from tidemark.functions.numeric import coerce_numeric, drop_columns

DAY_FILE = r"(\d{4}-\d{2}-\d{2})\.csv$"
# Spellings that the study's CSV reader takes as missing (exact,
# case-sensitive).
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
               "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


_STATUS = re.compile(r"path=([^;]+); isDirectory=(\w+)(?:; length=(\d+))?")


def _fs_list(spark: SparkSession, path: str, suffix: str = ".csv") -> list[tuple[str, int]]:
    """(file path, size) of the files under ``path`` — filesystem metadata
    only (0-byte files included, unlike the file sources)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    it = fs.listFiles(p, True)
    out = []
    while it.hasNext():
        m = _STATUS.search(it.next().toString())
        if m and m.group(2) == "false" and m.group(1).endswith(suffix):
            out.append((m.group(1), int(m.group(3) or 0)))
    return sorted(out)


def _has_files(spark: SparkSession, path: str) -> bool:
    """Whether the folder exists and holds any Parquet file."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False
    files = fs.listFiles(p, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def _exists(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(path)


def _path_date(path: Column, date_regex: str) -> Column:
    """The date in a file's path; null where there is none."""
    return F.try_to_date(F.regexp_extract(path, date_regex, 1), "yyyy-MM-dd")


def file_headers(spark: SparkSession, path: str | Sequence[str], keep: Column | None = None) -> DataFrame:
    """(file, header line) for every file, found by one distributed text
    scan: the first row a task emits from a file's first block is its
    header. One row per file reaches the driver. ``keep``, a condition on
    ``_metadata`` alone, leaves files out before they are opened."""
    src = path if isinstance(path, str) else list(path)
    t = (spark.read.option("encoding", "ISO-8859-1").option("recursiveFileLookup", True)
         .option("pathGlobFilter", "*.csv").text(src))
    if keep is not None:
        t = t.filter(keep)
    t = t.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("bs"),
                 F.monotonically_increasing_id().alias("rid"), "value")
    return t.filter(F.col("bs") == 0).groupBy("f").agg(F.min_by("value", "rid").alias("header"))


def header_groups(spark: SparkSession, path: str | Sequence[str], keep: Column | None = None) -> dict[tuple, list[str]]:
    """Group CSV files by their header (column order matters)."""
    groups: dict[tuple, list[str]] = {}
    for r in file_headers(spark, path, keep).collect():
        cols = tuple(c.strip().strip('"') for c in (r["header"] or "").split(","))
        groups.setdefault(cols, []).append(r["f"])
    return {k: sorted(v) for k, v in groups.items()}


def _reader(spark: SparkSession):
    return (spark.read.option("header", True).option("encoding", "ISO-8859-1")
            .option("escape", '"').option("multiLine", True).option("mode", "PERMISSIVE")
            .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv"))


def normalise_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Map the null spellings to NULL (Spark has a single nullValue)."""
    cols = cols or [c for c, t in df.dtypes if t == "string"]
    return df.withColumns({c: F.when(F.col(c).isin(*NULL_TOKENS), None).otherwise(F.col(c))
                           for c in cols})


def read_csv_strings(spark: SparkSession, path: str, keep: Column | None = None,
                     columns: Sequence[str] | None = None) -> DataFrame:
    """All-string read of every CSV under ``path`` (0-byte files give no
    rows). When all headers agree this is one scan of the folder; files with
    a different column order are read per header group and combined by name.
    ``keep``, a condition on ``_metadata`` alone, leaves files out before they
    are opened. Where all headers are known to be ``columns``, they are not
    looked up first, and a file with another header raises. Adds ``_file``."""
    groups = {tuple(columns): []} if columns else header_groups(spark, path, keep)
    if not groups:
        return spark.createDataFrame([], T.StructType([T.StructField("_file", T.StringType())]))
    parts = []
    for cols, group in groups.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
        src = path if len(groups) == 1 else group
        part = _reader(spark).option("enforceSchema", columns is None).schema(schema).csv(src)
        part = part if keep is None else part.filter(keep)
        parts.append(part.withColumn("_file", F.col("_metadata.file_path")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return normalise_nulls(out, [c for c in out.columns if c != "_file"])


def read_dated_csv(spark: SparkSession, path: str, date_predicate: Callable[[Column], Column] | None = None,
                   date_regex: str = DAY_FILE, label: int | None = 1,
                   label_col: str = "Label", date_col: str = "__sample_date",
                   columns: Sequence[str] | None = None) -> DataFrame:
    """S1 + S2 + P5: every CSV under ``path`` whose path carries a date;
    0-byte files and names without a parseable date yield nothing; ``label``
    and the date are attached. ``date_predicate`` turns a date Column into a
    condition; it filters on file metadata, so other files are opened neither
    for their rows nor for their headers."""
    of_file = _path_date(F.col("_metadata.file_path"), date_regex)
    keep = of_file.isNotNull()
    if date_predicate is not None:
        keep = keep & date_predicate(of_file)
    df = read_csv_strings(spark, path, keep, columns)
    if "_file" not in df.columns or len(df.columns) == 1:  # no file at all
        return df.drop("_file").withColumn(date_col, F.lit(None).cast("date"))
    df = df.withColumn(date_col, _path_date(F.col("_file"), date_regex))
    if label is not None:
        df = df.withColumn(label_col, F.lit(label))
    return df


def read_labelled_csv(spark: SparkSession, path: str, label: int = 0,
                      label_col: str = "Label", date_col: str = "__sample_date") -> DataFrame:
    """S3: one labelled CSV (file or folder of parts), undated (NULL date);
    error if missing."""
    _exists(spark, path)
    df = read_csv_strings(spark, path)
    return df.withColumn(label_col, F.lit(label)).withColumn(date_col, F.lit(None).cast("date"))


def combine_labelled(dated: DataFrame, undated: DataFrame, numeric_cols: Sequence[str] | None = None,
                     drop: Sequence[str] = IDENTIFIER_COLUMNS + NEAR_ZERO_VARIANCE_COLUMNS,
                     keep: Sequence[str] = ()) -> DataFrame:
    """S5 + P6 + U1 + P1 + P2: shared columns (sorted), union by name, drop
    identifier / constant columns (``keep`` survives, e.g. a row id) and
    coerce the numeric ones (unparseable -> NULL)."""
    shared = sorted((set(dated.columns) & set(undated.columns)) - {"_file"})
    both = dated.select(*shared).unionByName(undated.select(*shared))
    both = drop_columns(both, [c for c in drop if c not in keep])
    if numeric_cols:
        both = coerce_numeric(both, numeric_cols)
    return both


def check_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Raise before any job, naming every missing column."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"the table lacks the columns {', '.join(missing)}")


def read_records_json(spark: SparkSession, path: str, numeric: Sequence[str], strings: Sequence[str]) -> DataFrame:
    """JSON records with back-fill — missing / unparseable numbers -> 0.0,
    missing strings -> ''."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*numeric, *strings]])
    df = spark.read.schema(schema).json(path)
    return df.select(*[F.coalesce(F.expr(f"try_cast(`{c}` AS DOUBLE)"), F.lit(0.0)).alias(c) for c in numeric],
                     *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in strings])


def write_result_parts(df: DataFrame, path: str, keys: Sequence[str] = ("stage", "protocol", "model_name")) -> None:
    """A JSON file ``{stage}_{protocol}_{model}.json`` for each row, beside those
    that are there, for ``read_result_parts``. One row per part, so the names are few
    and the driver renames the files that Spark has written."""
    spark = df.sparkSession
    names = [f.name for f in df.schema]
    done = df.withColumn("_part", F.concat_ws("_", *keys)).dropDuplicates(["_part"])
    staged = f"{path}/_staged"  # file sources pass over names with a leading underscore
    done.select("_part", *names).write.mode("overwrite").partitionBy("_part").json(staged)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(staged)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in fs.listStatus(at):
        name = folder.getPath().getName()
        if folder.isDirectory() and name.startswith("_part="):
            for f in fs.listStatus(folder.getPath()):
                if f.getPath().getName().endswith(".json"):
                    fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(f"{path}/{name[len('_part='):]}.json"))
    fs.delete(at, True)


RESULT_PART = r"(?:^|/)(cv|holdout)_(random|temporal)_([^/]*)\.json$"


def read_result_parts(spark: SparkSession, path: str) -> DataFrame:
    """Every ``{stage}_{protocol}_{model}.json`` part, with ``stage`` and
    ``protocol`` taken from the file name; other names are ignored."""
    df = spark.read.option("multiLine", True).json(path).withColumn("_file", F.col("_metadata.file_path"))
    return (df.withColumn("stage", F.regexp_extract("_file", RESULT_PART, 1))
              .withColumn("file_protocol", F.regexp_extract("_file", RESULT_PART, 2))
              .filter(F.col("stage") != ""))


def write_results(df: DataFrame, path: str, keys: Sequence[str] = ("stage", "protocol", "model_name"),
                  skip_existing: bool = True) -> DataFrame:
    """S9 + J6: idempotent per part — rows whose key combination already has
    a part are skipped (anti-join with what is on disk); new parts are
    written with dynamic partition overwrite. Returns what was written."""
    from tidemark.session import materialize
    spark = df.sparkSession
    todo = df
    if skip_existing and _has_files(spark, path):
        done = spark.read.schema(df.schema).parquet(path).select(*keys).distinct()
        todo = df.join(done, list(keys), "left_anti")
    todo = materialize(todo, "results")  # what is written must not depend on the folder written to
    todo.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    return todo


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def per_file_counts(spark: SparkSession, path: str, date_regex: str = DAY_FILE) -> DataFrame:
    """S12 + A6: rows per dated file without parsing columns; 0-byte files
    from the listing count 0 (listing right-joined to the counts)."""
    # file metadata from the filesystem listing: the file sources skip
    # 0-byte files, which must count as empty days here
    from tidemark.operators.quantiles import small_frame
    rows = [(f, n) for f, n in _fs_list(spark, path) if re.search(date_regex, f)]
    sch = T.StructType([T.StructField("_file", T.StringType()), T.StructField("length", T.LongType())])
    listed = small_frame(spark, rows, sch)
    counts = (spark.read.option("header", True).option("recursiveFileLookup", True)
              .option("pathGlobFilter", "*.csv").csv(path)
              .select(F.col("_metadata.file_path").alias("_file")).groupBy("_file").count())
    out = listed.join(counts, "_file", "left")
    return out.select(F.try_to_date(F.regexp_extract("_file", date_regex, 1), "yyyy-MM-dd").alias("day"),
                      "_file", F.coalesce("count", F.lit(0)).alias("n"))


def head(df: DataFrame, n: int = 10, order_by: Sequence[str] = ()) -> DataFrame:
    """The first n rows by ``order_by``, or else by all columns."""
    return df.orderBy(*(order_by or df.columns)).limit(n)


def write_daily_csv(df: DataFrame, path: str, date_col: str) -> None:
    """Write one CSV folder per day (``<date_col>=YYYY-MM-DD/``), the layout
    ``read_dated_csv(date_regex=...)`` reads back. Rows are gathered by day;
    a day holding most of the rows is split over as many tasks as its size
    needs, into several files of its folder."""
    (df.hint("rebalance", F.col(date_col)).write.mode("overwrite").option("header", True)
     .partitionBy(date_col).csv(path))


def lookup(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids`` (a batch of requested
    ids); a semi-join, so the optimizer broadcasts the id side only when its
    statistics show it is small."""
    return df.join(ids.select(key).distinct(), key, "left_semi")
