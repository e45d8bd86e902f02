"""Writing results: summary tables (K1), views (K2), the termination log (K3),
the schema (K4), snapshots of saved tables (S10) and parameterised ad-hoc queries (S12).

Every writer takes a DataFrame and writes it with Spark's own writers; what passes
through the driver is catalog metadata (names, properties, one folder a day).
"""

from __future__ import annotations

import contextlib
import datetime
import re
import time
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.functions.time import AsOf
from vantage.plans.gold import BUILDERS
from vantage.plans.view_sql import VIEW_COMMENTS, view_texts
from vantage.sinks.versions import leased_until, lease, lock, properties, started
from vantage.sources.telemetry import Telemetry

# What each refreshed table is for.
TABLE_COMMENTS = {
    "gold_cost_daily": "List-price cost and DBUs a day, by workspace, product and SKU",
    "gold_job_health": "How the runs of each job went in 30 days",
    "gold_compute_inventory": "Clusters as last defined, flagged idle if a week passed without usage",
    "gold_compute_inventory_stateful": "Clusters as last defined, flagged zombie if they run without usage",
    "gold_user_activity": "Sign-ins and spending of each user in 30 days",
    "gold_governance_posture": "Counts of sensitive audit events of the last day, by workspace",
    "gold_pipeline_health": "How the updates of each pipeline ended in 7 days",
}

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}$")


def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"not a table identifier: {name!r}")
    return name


def create_schema(spark: SparkSession, schema: str, comment: str | None = None, location: str | None = None) -> None:
    """K4: ``CREATE SCHEMA IF NOT EXISTS ... COMMENT ... LOCATION ...``."""
    sql = f"CREATE SCHEMA IF NOT EXISTS {_ident(schema)}"
    if comment:
        sql += " COMMENT " + _quote(comment)
    if location:
        sql += " LOCATION " + _quote(location)
    spark.sql(sql)


def write_table(df: DataFrame, table: str, comment: str | None = None, partition_by: list[str] | None = None,
                publish: bool = True) -> str:
    """K1: full refresh of a summary table, with a comment; returns the version written.

    ``table`` is a view. A refresh writes a version table and switches the view to
    it in one catalog change, so readers see the old rows or the new ones at any
    time, and a refresh that dies anywhere before leaves the old ones in place.
    Refreshes may overlap: each claims its version while it writes, commits are
    done one after another, and of two full refreshes the one that began later
    stays. The versions before stay for queries that still read them; older ones
    are dropped, with what dead refreshes left once their claim has run out. Rows
    are rebalanced by the partition columns first, so a date is written by as many
    tasks as its size asks for, not by all of them. ``publish=False`` leaves the
    schema's snapshot as it is.
    """
    return _refresh(df, table, comment, partition_by, None, publish)


def replace_days(df: DataFrame, table: str, day: str, first: str, last: str, comment: str | None = None) -> str:
    """K1: replace the days ``first`` to ``last`` of a table that is partitioned by its date column ``day``.

    Only those days are written. The new state is a partitioned table of metadata
    alone: each of its days points to the folder of the newest refresh that covers
    it, so other days are neither read nor copied. Refreshes of other days that
    commit meanwhile are kept, and a day left without rows is gone.
    """
    bounds = tuple(datetime.date.fromisoformat(x).isoformat() for x in (first, last))
    rows = df.where(F.col(day).between(*(F.lit(b).cast("date") for b in bounds)))
    return _refresh(rows, table, comment, [day], bounds, True)


def _refresh(df: DataFrame, table: str, comment: str | None, partition_by: list[str] | None,
             days: tuple[str, str] | None, publish: bool) -> str:
    spark = df.sparkSession
    table = _ident(table).lower()  # as the catalog lists it
    version = f"{table}__v{time.time_ns()}"
    empty = spark.createDataFrame([], df.schema).write.format("parquet")
    (empty.partitionBy(*partition_by) if partition_by else empty).saveAsTable(version)
    with lease(spark, version):
        about = {"by": ",".join(partition_by or ()), **({"first": days[0], "last": days[1]} if days else {})}
        _set(spark, version, about)
        if partition_by:
            df = df.hint("rebalance", *(F.col(c) for c in partition_by))
        with small_tasks(spark):
            df.select(*spark.table(version).columns).write.insertInto(version)
        with lock(spark, f"{table}__lock"):
            _commit(spark, table, version, comment, publish)
    return version


#: Shuffled bytes that a refresh's tasks are given.
TASK_MB = 16


@contextlib.contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution gives the tasks of a refresh ``TASK_MB`` of shuffled rows while the block runs.

    By Spark's default they have 64 MB, which sorts and hash tables unfold to many times that: of a join, the aggregations
    on it and the sort before a partitioned write. A size that was set for the session stays."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, f"{TASK_MB}m")
    try:
        yield
    finally:
        spark.conf.unset(key)


def _commit(spark: SparkSession, table: str, version: str, comment: str | None, publish: bool) -> None:
    """Switch ``table`` to the state with ``version`` in it. Called with the table's lock held."""
    before = _current(spark, table)
    after = overlay({v: properties(spark, v) or {} for v in {*before, version}})
    target = after[0] if len(after) == 1 else _composed(spark, table, after)
    tail = f" COMMENT {_quote(comment)}" if comment else ""
    old = (properties(spark, table) or {}).get("target")
    spark.sql(f"CREATE OR REPLACE VIEW {table}{tail} TBLPROPERTIES ('version' = '{','.join(after)}', 'target' = '{target}') "
              f"AS SELECT * FROM {target}")
    if publish:
        publish_snapshot(spark, {table: target})
    _clean(spark, table, {*before, *after}, {target, old})


def overlay(found: Mapping[str, Mapping[str, str]]) -> list[str]:
    """Of versions and their properties, those that a table's rows come from, oldest first: the newest full refresh and
    the day refreshes begun after it, without those whose days one single later refresh covers."""
    ordered = sorted(found, key=started)
    full = [v for v in ordered if "first" not in found[v]]
    later = [v for v in ordered if "first" in found[v] and (not full or started(v) > started(full[-1]))]
    kept = [v for i, v in enumerate(later) if not any(
        found[w]["first"] <= found[v]["first"] and found[v]["last"] <= found[w]["last"] for w in later[i + 1:])]
    return full[-1:] + kept


def _composed(spark: SparkSession, table: str, parts: list[str]) -> str:
    """A table of metadata alone, whose days are folders of the version tables ``parts``, the newest that covers a day."""
    about = {v: properties(spark, v) or {} for v in parts}
    day = about[parts[0]].get("by", "")
    if any(p.get("by") != day for p in about.values()) or not day or "," in day:
        raise ValueError(f"{table} is not partitioned by one date column throughout")
    folders: dict[str, str] = {}
    for v in parts:  # oldest first
        first, last = about[v].get("first", ""), about[v].get("last", "9999-12-31")
        folders = {d: f for d, f in folders.items() if not first <= d <= last}
        root = next(r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {v}").collect() if r.col_name == "Location")
        folders |= {(d := r.partition.split("=", 1)[1]): f"{root}/{r.partition}" for r in spark.sql(f"SHOW PARTITIONS {v}").collect()}
    name = f"{table}__p{time.time_ns()}"
    root = next(r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {parts[-1]}").collect() if r.col_name == "Location")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(parts[-1]).schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{day}`) LOCATION {_quote(root + '__days')} "
              f"TBLPROPERTIES ('uses' = '{','.join(parts)}')")
    known = [f"PARTITION (`{day}` = {_quote(d)}) LOCATION {_quote(f)}" for d, f in sorted(folders.items())]
    for at in range(0, len(known), 500):  # a folder a day
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(known[at:at + 500])}")
    return name


def _clean(spark: SparkSession, table: str, keep: set[str], targets: set[str | None]) -> None:
    """Drop composed tables and versions that nothing uses and nobody claims."""
    targets = targets | {snapshot(spark, table.rpartition(".")[0]).get(table)}
    for old in versions(spark, table, "p"):
        if old not in targets:
            spark.sql(f"DROP TABLE IF EXISTS {old}")  # metadata alone: the folders are the versions'
    for t in targets - {None}:
        keep = keep | {t, *((properties(spark, t) or {}).get("uses", "").split(","))}
    for old in versions(spark, table):
        if old not in keep and leased_until(spark, old) < time.time():
            spark.sql(f"DROP TABLE IF EXISTS {old}")


def versions(spark: SparkSession, table: str, kind: str = "v") -> list[str]:
    """The version tables of ``table``, oldest first (catalog metadata); of kind ``p`` those composed of other
    versions, of kind ``s`` rows staged for a log."""
    schema, _, name = _ident(table).rpartition(".")
    listed = spark.sql(f"SHOW TABLES{' IN ' + schema if schema else ''} LIKE '{name}__{kind}*'").collect()
    own = re.compile(re.escape(f"{name}__{kind}") + r"\d+", re.IGNORECASE)  # no other table whose name begins alike
    return sorted((f"{schema}." if schema else "") + r.tableName for r in listed if own.fullmatch(r.tableName))


def _current(spark: SparkSession, table: str) -> list[str]:
    """The versions that ``table`` shows."""
    found = properties(spark, table)
    if found is not None and "version" not in found:
        raise ValueError(f"{table} exists and was not written by write_table")
    return found["version"].split(",") if found else []


def _set(spark: SparkSession, name: str, values: Mapping[str, str]) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({', '.join(f'{_quote(k)} = {_quote(v)}' for k, v in values.items())})")


SNAPSHOT = "saved_tables"


def publish_snapshot(spark: SparkSession, targets: Mapping[str, str]) -> None:
    """Make the given tables' states the ones that snapshot readers of their schema see, in one catalog change."""
    schema = next(iter(targets)).rpartition(".")[0]
    name = f"{schema}.{SNAPSHOT}" if schema else SNAPSHOT
    with lock(spark, f"{name}__lock"):
        held = ", ".join(f"{_quote('at.' + k)} = {_quote(v)}" for k, v in {**snapshot(spark, schema), **targets}.items())
        spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT 'What snapshot readers of this schema see' TBLPROPERTIES ({held}) "
                  "AS SELECT current_timestamp() AS now")


def snapshot(spark: SparkSession, schema: str) -> dict[str, str]:
    """Table -> the table that holds its rows in the schema's snapshot: states that were published together. Reading those
    gives rows that fit each other, whatever is refreshed meanwhile. Catalog metadata, no job."""
    found = properties(spark, f"{schema}.{SNAPSHOT}" if schema else SNAPSHOT) or {}
    return {k.removeprefix("at."): v for k, v in found.items() if k.startswith("at.")}


def refresh_summaries(t: Telemetry, schema: str, as_of=None) -> dict[str, str]:
    """K1 for the summary tables; returns name -> table. Snapshot readers see all of them change at once."""
    a = AsOf.of(as_of)
    out = {}
    for name, comment in TABLE_COMMENTS.items():
        table = f"{schema}.{name}"
        write_table(BUILDERS[name](t, a), table, comment,
                    partition_by=["date"] if name == "gold_cost_daily" else None, publish=False)
        out[name] = table
    publish_snapshot(t.spark, {table.lower(): properties(t.spark, table)["target"] for table in out.values()})
    return out


def refresh_cost_days(t: Telemetry, schema: str, first: str, last: str) -> str:
    """K1 for late billing: rebuild ``gold_cost_daily`` for the days ``first`` to ``last`` only.

    The filter on the day reaches the usage scan, so only those partitions are
    priced, and only they are written.
    """
    table = f"{schema}.gold_cost_daily"
    replace_days(BUILDERS["gold_cost_daily"](t, None), table, "date", first, last, TABLE_COMMENTS["gold_cost_daily"])
    return table


def create_live_views(t: Telemetry, schema: str, sources: Mapping[str, str], as_of=None) -> dict[str, str]:
    """K2: the five views (``v_...``) as catalog views over the source tables, computed when read; returns name -> view.

    Any session of the catalog sees them, and "now" in their text is the reader's, so they need no refresh. ``sources``
    names the catalog table of each source; ``as_of`` fixes the instant (tests). A schema has either these or stored ones
    (``refresh_views``), which won't replace them."""
    out = {}
    for name, text in view_texts(t, sources, AsOf.of(as_of)).items():
        out[name] = f"{_ident(schema)}.{name}"
        t.spark.sql(f"CREATE OR REPLACE VIEW {out[name]} COMMENT {_quote(VIEW_COMMENTS[name])} AS {text}")
    return out


def refresh_views(t: Telemetry, schema: str, as_of=None) -> dict[str, str]:
    """The five views' rows stored in ``schema``, for readers that can't afford to compute them; returns name -> table."""
    a = AsOf.of(as_of)
    out = {}
    for name, build in BUILDERS.items():
        if name.startswith("v_"):
            out[name] = f"{schema}.{name}"
            write_table(build(t, a), out[name])
    return out


def register_views(t: Telemetry, as_of=None, prefix: str = "") -> list[str]:
    """The five views as temporary views of this session, computed when read."""
    a = AsOf.of(as_of)
    names = []
    for name, build in BUILDERS.items():
        if name.startswith("v_"):
            build(t, a).createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
    return names


LOG_KEY = ("workspace_id", "cluster_id")


def append_termination_log(rows: DataFrame, table: str) -> None:
    """K3: create-if-absent and log what one run acted on (``rows`` have one ``run_id``).

    The log is partitioned by run, and a call replaces its run's partition in one
    commit with what was there and what is new, one row per (workspace, cluster).
    So a repeated call adds nothing, no other run is read or written, and calls of
    the same run at the same time take turns. Of two rows of a cluster the earlier stays.
    """
    spark = rows.sparkSession
    table = _ident(table).lower()
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (termination_time TIMESTAMP, cluster_names ARRAY<STRING>, "
              "workspace_id STRING, cluster_id STRING, run_id STRING) USING parquet PARTITIONED BY (run_id)")
    columns = spark.table(table).columns
    rows = rows.withColumn("termination_time", F.col("termination_time").cast("timestamp")).select(columns)
    runs = [r.run_id for r in rows.select("run_id").distinct().limit(2).collect()]
    if len(runs) > 1 or runs == [None]:
        raise ValueError("a call logs the rows of one run, which has an id")
    if not runs:
        return
    with lock(spark, f"{table}__lock"):
        spark.catalog.refreshTable(table)
        there = spark.table(table).where(F.col("run_id") == runs[0])
        both = there.withColumn("_late", F.lit(0)).unionByName(rows.withColumn("_late", F.lit(1)))
        kept = both.groupBy(*LOG_KEY, "run_id").agg(F.min_by(
            F.struct("termination_time", "cluster_names"), F.struct("_late", "termination_time", "cluster_names")).alias("_row"))
        for left in versions(spark, table, "s"):  # of a call that died
            spark.sql(f"DROP TABLE IF EXISTS {left}")
        staged = f"{table}__s{time.time_ns()}"  # a table can't be read while it is overwritten
        kept.select("_row.*", *LOG_KEY, "run_id").select(columns).coalesce(1).write.saveAsTable(staged)
        own = ", ".join(f"`{c}`" for c in columns if c != "run_id")
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (run_id = {_quote(runs[0])}) SELECT {own} FROM {staged}")
        spark.sql(f"DROP TABLE IF EXISTS {staged}")


def run_query(spark: SparkSession, query: str, params: Mapping[str, object] | None = None, **frames: DataFrame) -> DataFrame:
    """A parameterised SQL query (``:name`` markers bound by Spark, never
    spliced into the text); returns a lazy DataFrame. ``{name}`` stands for a frame."""
    return spark.sql(query, args=dict(params or {}), **frames)


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
