"""Sources and sinks.

A *target* is either a catalog table name or a path (anything with a slash). Files are
Parquet unless a function says otherwise.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import VALID_FLAG, VALID_UNTIL
from tidemark.functions.contracts import conform
from tidemark.functions.hashing import KEYHASH
from tidemark.operators.joins import null_safe_join
from tidemark.operators.ordering import global_rank, range_parts
from tidemark.operators.reshape import union_all
from tidemark.session import checkpointed, scratch

BATCH_DATE = "batch_date"
STATE, CLOSED_DAY, RUN = LAYOUT = ("version_state", "closed_day", "closing_run")
OPEN_DAY = "9999-12-31"


_ABSENT = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


class NoSourceError(RuntimeError):
    """Not one member of a table family could be read."""


def _is_path(target: str) -> bool:
    return "/" in target


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a Parquet folder."""
    return spark.read.parquet(name) if _is_path(name) else spark.table(name)


def read_lookup(
    spark: SparkSession,
    name: str,
    jdbc: Mapping[str, str] | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """A lookup table; with ``jdbc`` options straight from an operational database.

    ``split`` (column, low, high, tasks) lets several tasks read ranges of a number column.
    """
    if jdbc is None:
        return read_table(spark, name)
    reader = spark.read.format("jdbc").options(**jdbc).option("dbtable", name)
    if split is not None:
        column, low, high, tasks = split
        reader = reader.options(
            partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=tasks
        )
    return reader.load()


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON object per line, never inferring the schema."""
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """CSV with a given schema; a value that does not fit it is an error."""
    return spark.read.schema(schema).options(header=header, mode="FAILFAST").csv(path)


def read_country_family(
    spark: SparkSession,
    members: Mapping[str, str],
    template: str,
    read: Callable[[SparkSession, str], DataFrame] = read_table,
) -> DataFrame:
    """Tables that exist once per market as one table with ``country``.

    ``members`` maps country to the suffix put into ``template`` (``"customer_{}"``). A
    missing member is skipped; no member at all is an error.
    """
    found = []
    for country, suffix in members.items():
        try:
            found.append(read(spark, template.format(suffix)).withColumn("country", F.lit(country.upper())))
        except AnalysisException as missing:
            if missing.getCondition() not in _ABSENT:
                raise
    if not found:
        raise NoSourceError(f"no table found for {template!r}")
    return union_all(found)


def _save(writer: DataFrameWriter, target: str) -> None:
    writer.parquet(target) if _is_path(target) else writer.saveAsTable(target)


def write_replace(df: DataFrame, target: str, schema: T.StructType | None = None) -> None:
    """Replace the target, creating it if needed; ``schema`` enforces column types and order.

    Never call it with a target that ``df`` is read from: write to a new path and swap.
    """
    out = df if schema is None else conform(df, schema)
    _save(out.write.mode("overwrite"), target)


def load_csv_overwrite(spark: SparkSession, path: str, schema: T.StructType | str, target: str) -> None:
    """CSV into a staging table, replacing what is there."""
    write_replace(read_csv(spark, path, schema), target)


def write_append(df: DataFrame, target: str) -> None:
    """Append in one atomic job; a failed task fails the whole append."""
    _save(df.write.mode("append"), target)


def append_batch(df: DataFrame, target: str, batch_date: date) -> None:
    """Append one day's batch; running the day again replaces it instead of doubling it."""
    spark = df.sparkSession
    dated = df.withColumn(BATCH_DATE, F.lit(batch_date))
    if _is_path(target):
        writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BATCH_DATE).parquet(target)
    elif not spark.catalog.tableExists(target):
        dated.write.partitionBy(BATCH_DATE).saveAsTable(target)
    else:
        # saveAsTable would replace the whole table; an insert replaces its partitions.
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            dated.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
        finally:
            spark.conf.set(mode, before)


def fan_out(df: DataFrame, sinks: Sequence[Callable[[DataFrame], None]]) -> None:
    """The same rows to several sinks, in the given order.

    They are computed once and written to the shared folder, so that the sinks agree even if
    executors are lost or the source moves on.
    """
    with scratch(df.sparkSession):
        kept = checkpointed(df)
        for sink in sinks:
            sink(kept)


def land_raw(df: DataFrame, folder: str, entity: str, load_date: date) -> None:
    """Dated raw copy under ``entity=.../load_date=.../``; a day can be landed again."""
    landed = df.withColumns({"entity": F.lit(entity), "load_date": F.lit(load_date)})
    (
        landed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("entity", "load_date")
        .json(folder)
    )


def write_ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_rejects(df: DataFrame, path: str) -> None:
    """Rejected rows with their reason as CSV with a header line."""
    flat = [
        F.to_json(f.name).alias(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def _laid_out(df: DataFrame, run: str, iso_col: str) -> DataFrame:
    """``df`` with its layout columns, range-partitioned and sorted for the Parquet statistics."""
    active = F.coalesce(F.col(VALID_FLAG), F.lit(False))
    laid = df.withColumns(
        {
            STATE: F.when(active, "active").otherwise("closed"),
            CLOSED_DAY: F.when(active, F.lit(OPEN_DAY).cast("date")).otherwise(F.to_date(VALID_UNTIL)),
            RUN: F.when(active, "open").otherwise(run),
        }
    )
    order = [c for c in (iso_col, KEYHASH) if c in df.columns]
    # Key hashes are spread evenly, so a day that holds most rows is split over many tasks.
    spread = laid.repartitionByRange(range_parts(df), *LAYOUT, *order)
    return spread.sortWithinPartitions(*LAYOUT, *order)


VERSIONS = "_versions"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def published(spark: SparkSession, target: str) -> tuple[int, dict] | None:
    """The latest pointer of a stored versioned table: (number, {"active": run, "closed": [runs]})."""
    fs, where = _hadoop(spark, f"{target.rstrip('/')}/{VERSIONS}")
    if not fs.exists(where):
        return None
    numbers = [int(s.getPath().getName()[:-5]) for s in fs.listStatus(where) if s.getPath().getName().endswith(".json")]
    if not numbers:
        return None
    latest = max(numbers)
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/{VERSIONS}/{latest:020d}.json"))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return latest, json.loads(text)


def _publish(spark: SparkSession, target: str, number: int, state: dict) -> None:
    """Makes ``state`` the table's state: one new pointer file, created only if no other writer made it."""
    fs, where = _hadoop(spark, f"{target.rstrip('/')}/{VERSIONS}/{number:020d}.json")
    out = fs.create(where, False)  # fails where another run published this number first
    try:
        out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
    finally:
        out.close()


def write_scd(df: DataFrame, target: str, iso_col: str = "iso_code") -> None:
    """A complete versioned table, replacing what is there.

    Folders split active from closed rows, and closed rows by the day they ended and the run
    that closed them. :func:`read_scd` uses these columns and drops them;
    :func:`update_scd` writes the next state without touching the closed rows. A path gets
    a pointer (``_versions``) that names its active generation and its closed runs.
    """
    _save(_laid_out(df, "first", iso_col).write.mode("overwrite").partitionBy(*LAYOUT), target)
    if _is_path(target):
        _publish(df.sparkSession, target, 0, {"active": "open", "closed": ["first"]})


def read_scd(
    spark: SparkSession, target: str, state: str | None = None, closed_since: date | None = None
) -> DataFrame:
    """A table of :func:`write_scd` without its layout columns.

    ``state`` (``"active"`` or ``"closed"``) and ``closed_since`` (active rows, and rows closed
    on that day or later) name folders, so other files are not opened. Where the table has a
    pointer, only the folders it names are read: what a run wrote before it published is not.
    """
    stored = read_table(spark, target)
    pointer = published(spark, target) if _is_path(target) else None
    if pointer is not None:
        _, now = pointer
        stored = stored.where(
            ((F.col(STATE) == "active") & (F.col(RUN) == now["active"]))
            | ((F.col(STATE) == "closed") & F.col(RUN).isin(*now["closed"]))
        )
    if state is not None:
        stored = stored.where(F.col(STATE) == state)
    if closed_since is not None:
        stored = stored.where(F.col(CLOSED_DAY) >= F.lit(closed_since))
    return stored.drop(*LAYOUT)


def update_scd(closed: DataFrame, active: DataFrame, target: str, run: str, iso_col: str = "iso_code") -> None:
    """The next state of a stored versioned table (a path): append ``closed``, replace the active rows.

    ``run`` names the run, e.g. its hour. Rows closed by earlier runs stay in their files. Both
    frames may be derived from ``target``: they are computed and written to the shared folder
    before anything changes. The closed rows go to folders of this run and the active rows to
    a new generation folder; neither is read until a new pointer names them, which is the last
    step. A run that breaks off at any point leaves the previous state, and can be repeated
    from the same inputs. Generations older than the previous one are removed afterwards.
    """
    if not _is_path(target):
        raise ValueError("update_scd needs a path")
    spark = active.sparkSession
    pointer = published(spark, target)
    number, before = pointer if pointer is not None else (-1, {"active": "open", "closed": ["first"]})
    generation = f"open-{run}-{uuid.uuid4().hex[:12]}"
    with scratch(spark):
        closed, active = checkpointed(closed), checkpointed(active)
        writer = _laid_out(closed, run, iso_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        _step("closed")
        writer.partitionBy(*LAYOUT).parquet(target)
        folder = f"{target.rstrip('/')}/{STATE}=active/{CLOSED_DAY}={OPEN_DAY}/{RUN}={generation}"
        _step("active")
        _laid_out(active, run, iso_col).drop(*LAYOUT).write.mode("errorifexists").parquet(folder)
        _step("publish")
        runs = [r for r in before["closed"] if r != run] + [run]
        _publish(spark, target, number + 1, {"active": generation, "closed": runs})
    fs, root = _hadoop(spark, f"{target.rstrip('/')}/{STATE}=active/{CLOSED_DAY}={OPEN_DAY}")
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{RUN}=") and name[len(RUN) + 1 :] not in (generation, before["active"]):
            fs.delete(status.getPath(), True)


def _step(name: str) -> None:
    """A place where tests make a run break off."""


def event_batches(
    df: DataFrame, key: Sequence[str], order: Sequence[str], size: int = 500, unique: bool = False
) -> DataFrame:
    """One row per batch of at most ``size`` records per market:
    ``key..., batch_no, n_records, body`` with ``body`` = ``{"records":[{"value":...}]}``.

    Batches follow the global order, so one market holding most rows is still cut into
    batches by many tasks.
    """
    ranked = global_rank(df, [*key, *order], "_rank", unique)
    firsts = ranked.groupBy(*key).agg(F.min("_rank").alias("_first"))
    placed = null_safe_join(ranked, firsts, key, "inner")
    numbered = placed.withColumn("batch_no", F.expr(f"(_rank - _first) div {int(size)}"))
    value = F.struct(*[c for c in df.columns if c not in key])
    records = F.sort_array(F.collect_list(F.struct("_rank", value.alias("value"))))
    body = F.to_json(
        F.struct(F.transform(records, lambda r: F.struct(r["value"].alias("value"))).alias("records")),
        {"ignoreNullFields": "false"},
    )
    return numbered.groupBy(*key, "batch_no").agg(
        F.count(F.lit(1)).alias("n_records"), body.alias("body")
    )
