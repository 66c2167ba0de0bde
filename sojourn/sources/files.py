"""CSV and Parquet tables, and staged run folders."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sojourn.params import TABLES

#: Independent write jobs submitted together, so that small ones do not leave executors idle.
JOBS_AT_ONCE = 4

#: Raw demographics as exported upstream. ZIP stays text, so leading zeros survive.
RAW_PATIENT_COLUMNS = (
    "Id", "BIRTHDATE", "DEATHDATE", "SSN", "DRIVERS", "PASSPORT", "PREFIX", "FIRST", "MIDDLE",
    "LAST", "SUFFIX", "MAIDEN", "MARITAL", "RACE", "ETHNICITY", "GENDER", "BIRTHPLACE", "ADDRESS",
    "CITY", "STATE", "COUNTY", "FIPS", "ZIP", "LAT", "LON", "HEALTHCARE_EXPENSES",
    "HEALTHCARE_COVERAGE", "INCOME",
)
RAW_PATIENT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_PATIENT_COLUMNS])


def _hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One CSV table. Without a schema every column is read as text by its header name."""
    reader = spark.read.option("header", True).option("dateFormat", "yyyy-MM-dd")
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def csv_paths(spark: SparkSession, directory: str) -> dict[str, str]:
    """Every ``*.csv`` file or folder in a folder by lower-case stem, in name order; empty if none."""
    root, fs = _hadoop_path(spark, directory)
    if not fs.exists(root):
        return {}
    names = sorted(status.getPath().getName() for status in fs.listStatus(root))
    return {name[: -len(".csv")].lower(): f"{directory}/{name}" for name in names if name.lower().endswith(".csv")}


def load_csv_directory(
    spark: SparkSession, directory: str, schemas: Mapping[str, T.StructType] | None = None
) -> dict[str, DataFrame]:
    """Every CSV table of a folder keyed by lower-case stem, in name order; empty if none."""
    known = schemas or {}
    return {stem: read_csv_table(spark, path, known.get(stem)) for stem, path in csv_paths(spark, directory).items()}


def write_csv_table(df: DataFrame, path: str) -> None:
    """CSV with a header and ISO dates, replacing what was there."""
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def write_parquet_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_tables(
    tables: Mapping[str, DataFrame], directory: str, formats: Iterable[str] = ("parquet", "csv")
) -> None:
    """Write every table as ``<directory>/<name>.<format>``, as jobs side by side."""
    writers = {"parquet": write_parquet_table, "csv": write_csv_table}
    jobs = [(writers[kind], df, f"{directory}/{name}.{kind}") for name, df in tables.items() for kind in formats]
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        list(pool.map(lambda job: job[0](job[1], job[2]), jobs))


NANOS_OF_DAY = 86_400 * 10**9


def is_date_column(name: str) -> bool:
    """Whether the published tables hold a date under this name."""
    return name.endswith("_date") or name == "date_of_death"


def read_parquet_table(spark: SparkSession, path: str) -> DataFrame:
    """A published table by its physical schema, its date columns as dates.

    Files written elsewhere may hold dates as timestamps, also of nanoseconds, which are read as whole numbers.
    A time before 1970 belongs to the day it lies in.
    """
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    df = spark.read.parquet(path)
    dates = {}
    for field in df.schema:
        if not is_date_column(field.name) or isinstance(field.dataType, T.DateType):
            continue
        if isinstance(field.dataType, T.LongType):
            days = F.expr(f"cast((`{field.name}` - pmod(`{field.name}`, {NANOS_OF_DAY})) div {NANOS_OF_DAY} AS INT)")
            dates[field.name] = F.date_add(F.lit("1970-01-01").cast("date"), days)
        else:
            dates[field.name] = F.col(field.name).cast("date")
    return df.withColumns(dates) if dates else df


def load_exported_tables(
    spark: SparkSession, directory: str, names: Iterable[str] = TABLES
) -> dict[str, DataFrame]:
    return {name: read_parquet_table(spark, f"{directory}/{name}.parquet") for name in names}


def stage_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder.

    Only a local session may go without one; it gets a temporary folder that is
    removed when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder to stage tables")
    folder = tempfile.mkdtemp(prefix="sojourn-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_stage(spark: SparkSession) -> str:
    """A fresh folder name under the stage root; nothing is overwritten across runs."""
    return f"{stage_root(spark)}/sojourn/{uuid.uuid4().hex}"


def stage_table(df: DataFrame, directory: str, name: str) -> DataFrame:
    """Write a table once and read it back: lineage is cut and lost executors lose nothing."""
    path = f"{directory}/{name}.parquet"
    write_parquet_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_tables(
    plans: Mapping[str, DataFrame], directory: str | Callable[[str], str],
    measures: Mapping[str, Mapping[str, Column]] | None = None, measured: dict[str, int] | None = None,
    save: Callable[[DataFrame, str, str], DataFrame] = stage_table,
) -> dict[str, DataFrame]:
    """Stage tables that do not depend on each other, as jobs side by side. ``directory`` may be chosen by name.

    ``measures`` are aggregates by table, taken over the columns they need once it is written, and put into ``measured``.
    ``save`` writes a table under a name in a folder and returns it as it was written.
    """
    place = directory if callable(directory) else lambda name: directory

    def write(item: tuple[str, DataFrame]) -> DataFrame:
        name, df = item
        staged, wanted = save(df, place(name), name), (measures or {}).get(name)
        if wanted:
            measured.update(staged.agg(*[column.alias(rule) for rule, column in wanted.items()]).first().asDict())
        return staged

    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        return dict(zip(plans, pool.map(write, plans.items()), strict=True))


#: Bytes of input files behind one task of a step that sorts or groups; some 600,000 line items.
INPUT_PER_TASK = 8 << 20


def task_count(df: DataFrame, per_task: int | None = None) -> int:
    """Tasks for a step over a frame: the session's shuffle partitions, or as many more as its input files ask for."""
    paths = [_hadoop_path(df.sparkSession, name) for name in df.inputFiles()]
    size = sum(fs.getFileStatus(path).getLen() for path, fs in paths)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // (per_task or INPUT_PER_TASK)))


def spread(df: DataFrame, *keys: str, tasks: int | None = None) -> DataFrame:
    """Rows dealt by keys to tasks that grow in number with the input, so that what a task sorts or groups does not grow.

    A small input is left as it is. ``tasks`` is the number, if it comes from the input of an earlier step.
    """
    wanted = tasks or task_count(df)
    return df.repartition(wanted, *keys) if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def bucket_table(df: DataFrame, directory: str, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """A table of the catalog, bucketed and sorted by a key, one file a bucket; joins on the key then move no row.

    The entry's name is unique to the call; it goes when this process ends, the files stay.
    """
    spark = df.sparkSession
    number = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    entry = f"sojourn_{name}_{uuid.uuid4().hex}"
    writer = df.repartition(number, key).write.bucketBy(number, key).sortBy(key)
    writer.option("path", f"{directory}/{name}").saveAsTable(entry)
    atexit.register(_drop_entry, spark, entry)
    return spark.table(entry)


def save_bucketed(
    spark: SparkSession, tables: Mapping[str, DataFrame], directory: str, keys: Mapping[str, str], buckets: int | None = None
) -> dict[str, DataFrame]:
    """Tables saved by ``bucket_table``, each by a key of its own, as jobs side by side."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        saved = pool.map(lambda name: bucket_table(tables[name], directory, name, keys[name], buckets), tables)
        return dict(zip(tables, saved, strict=True))


def _drop_entry(spark: SparkSession, entry: str) -> None:
    if spark.sparkContext._jsc is not None:
        spark.sql(f"DROP TABLE IF EXISTS {entry}")
