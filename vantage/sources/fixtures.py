"""Source-shaped test tables derived from the TPC-H-like parquet test data.

The derivation is deterministic and matches FIXTURES.md; the flat SQL form of
the same derivation is used by the DuckDB oracle (``vantage.oracle``). Here the
columns are nested (structs, a map) the way the platform tables hold them, so
struct-field and map-key access is exercised. All time columns are wall-clock
``timestamp_ntz`` so nothing depends on the session time zone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the test derivation.
AS_OF = "2024-01-31 00:00:00"
BASE = "2023-12-03 00:00:00"


def _ts(text: str) -> Column:
    return F.to_timestamp_ntz(F.lit(text))


def _after(base: str, days: Column | int = 0, hours: Column | int = 0, mins: Column | int = 0) -> Column:
    def c(v):
        return v.cast("int") if isinstance(v, Column) else F.lit(v)

    return _ts(base) + F.make_dt_interval(days=c(days), hours=c(hours), mins=c(mins))


def _s(c: Column) -> Column:
    return c.cast("string")


def usage(raw: Callable[[str], DataFrame]) -> DataFrame:
    c = F.col
    day = (c("l_orderkey") * 7 + c("l_linenumber")) % 60
    hour = (c("l_partkey") + c("l_linenumber")) % 24
    flag = c("l_returnflag")
    return raw("lineitem").select(
        _s(c("l_suppkey") % 5).alias("workspace_id"),
        F.concat(F.lit("SKU_"), _s(F.floor(c("l_partkey") / 3).cast("long"))).alias("sku_name"),
        F.when(flag == "A", "JOBS").when(flag == "N", "SQL").otherwise("ALL_PURPOSE").alias("billing_origin_product"),
        F.to_date(_after(BASE, days=day)).alias("usage_date"),
        _after(BASE, days=day, hours=hour).alias("usage_start_time"),
        _after(BASE, days=day, hours=hour + 1).alias("usage_end_time"),
        c("l_quantity").cast("decimal(18,2)").alias("usage_quantity"),
        F.struct(
            F.when(c("l_linenumber") != 7,
                   F.concat(F.lit("user"), _s(c("l_orderkey") % 150), F.lit("@example.com"))).alias("run_as"),
        ).alias("identity_metadata"),
        F.struct(
            F.when((flag == "R") & (c("l_suppkey") % 4 != 0),
                   F.concat(F.lit("c-"), _s(c("l_suppkey")))).alias("cluster_id"),
            F.when(flag == "A", F.concat(F.lit("job_"), _s(c("l_suppkey") % 10))).alias("job_name"),
            F.when((flag == "N") & (c("l_linestatus") == "O"),
                   F.concat(F.lit("/nb/"), _s(c("l_partkey") % 10))).alias("notebook_path"),
        ).alias("usage_metadata"),
    )


def list_prices(raw: Callable[[str], DataFrame]) -> DataFrame:
    """Three consecutive versions per SKU, one per row of ``part``; every 25th SKU has no price, and of every 40th SKU
    the second version ends five days late, into the third."""
    key = F.col("p_partkey")
    sku, version = F.floor(key / 3).cast("long"), key % 3
    return raw("part").filter(sku % 25 != 24).select(
        F.concat(F.lit("SKU_"), _s(sku)).alias("sku_name"),
        F.when(version == 0, _ts("2023-01-01 00:00:00")).when(version == 1, _ts("2023-12-20 00:00:00"))
        .otherwise(_ts("2024-01-15 00:00:00")).alias("price_start_time"),
        F.when(version == 0, _ts("2023-12-20 00:00:00"))
        .when((version == 1) & (sku % 40 == 7), _ts("2024-01-20 00:00:00"))
        .when(version == 1, _ts("2024-01-15 00:00:00")).alias("price_end_time"),
        F.struct(F.struct(F.col("p_retailprice").cast("decimal(18,2)").alias("default")).alias("effective_list"))
        .alias("pricing"),
    )


def audit(raw: Callable[[str], DataFrame]) -> DataFrame:
    c = F.col
    ev = raw("events").withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).try_cast("int"))
    k, etype, uid = c("k"), c("event_type"), c("user_id")

    def pick(mod: int, names: list[str]) -> Column:
        out = F.when(k % mod == 0, names[0])
        for i, name in enumerate(names[1:-1], start=1):
            out = out.when(k % mod == i, name)
        return out.otherwise(names[-1])

    action = (F.when(etype == "view", pick(3, ["mintOAuthToken", "mintOAuthAuthorizationCode",
                                                "workspaceInHouseOAuthClientAuthentication"]))
              .when(etype == "signup", pick(2, ["addPrincipalToGroup", "removePrincipalFromGroup"]))
              .when(etype == "error", pick(2, ["IpAccessDenied", "accountIpAclsValidationFailed"]))
              .when(etype == "purchase", pick(3, ["deleteCluster", "deleteJob", "deleteTable"]))
              .otherwise(pick(2, ["updatePermissions", "getTable"])))
    return ev.select(
        c("event_id"),
        c("ts").alias("event_time"),
        F.to_date("ts").alias("event_date"),
        _s(uid % 5).alias("workspace_id"),
        F.when(etype == "click", "unityCatalog").otherwise("workspace").alias("service_name"),
        action.alias("action_name"),
        F.struct(F.when(uid % 25 == 0, F.concat(F.lit("System-User-"), _s(uid)))
                 .otherwise(F.concat(F.lit("user"), _s(uid), F.lit("@example.com"))).alias("email"))
        .alias("user_identity"),
        F.concat(F.lit("10.0."), _s(uid % 256), F.lit("."), _s(k)).alias("source_ip_address"),
        F.create_map(F.lit("targetGroupName"), F.when(k % 3 == 0, "admins").otherwise("users"),
                     F.lit("targetUserName"), F.concat(F.lit("user"), _s(k), F.lit("@example.com")))
        .alias("request_params"),
    )


# Every SCD2 entity gets five versions, one per TPC-H region key (0-4).
VERSION_KEYS = (0, 1, 2, 3, 4)


def _versions(raw: Callable[[str], DataFrame], table: str) -> DataFrame:
    """Five version rows per entity row (a fixed fan-out of 5, no join), each version a scan of its own: a file that one
    task reads has five times the rows, which the choice of the latest version sorts in that task."""
    return reduce(DataFrame.unionByName, (raw(table).withColumn("r_regionkey", F.lit(k)) for k in VERSION_KEYS))


def clusters(raw: Callable[[str], DataFrame], with_state: bool = True) -> DataFrame:
    c = F.col
    key = c("s_suppkey")
    cols = [
        F.concat(F.lit("c-"), _s(key)).alias("cluster_id"),
        _s(key % 5).alias("workspace_id"),
        F.concat(c("s_name"), F.lit("_v"), _s(c("r_regionkey"))).alias("cluster_name"),
        F.when(key % 3 != 0, F.concat(F.lit("user"), _s(key % 150), F.lit("@example.com"))).alias("owned_by"),
        F.when(key % 2 == 0, "UI").otherwise("JOB").alias("cluster_source"),
        _after("2023-12-01 00:00:00", days=c("r_regionkey") * 10).alias("change_time"),
    ]
    if with_state:  # what G3b reads beyond G3: sizes are fixed for odd keys and a range for even ones
        own = key + c("r_regionkey")
        cols += [F.when(key % 3 == 0, "TERMINATED").otherwise("RUNNING").alias("state"),
                 F.concat(F.lit("driver-"), _s(own % 4)).alias("driver_node_type_id"),
                 F.when(own % 7 != 0, F.concat(F.lit("worker-"), _s(own % 5))).alias("node_type_id"),
                 F.when(key % 2 == 0, F.struct((own % 3 + 1).cast("int").alias("min_workers"), (own % 9 + 4).cast("int").alias("max_workers")))
                 .alias("autoscale"),
                 F.when(key % 2 == 1, (own % 8).cast("int")).alias("num_workers")]
    return _versions(raw, "supplier").select(*cols)


def jobs(raw: Callable[[str], DataFrame]) -> DataFrame:
    c = F.col
    key = c("c_custkey")
    return _versions(raw, "customer").filter(key % 10 != 9).select(
        _s(key % 5).alias("workspace_id"),
        key.alias("job_id"),
        F.concat(c("c_name"), F.lit("_v"), _s(c("r_regionkey"))).alias("name"),
        F.concat(F.lit("user"), _s(key % 150), F.lit("@example.com")).alias("creator_user_name"),
        _after("2023-06-01 00:00:00", days=c("r_regionkey") * 10).alias("change_time"),
    )


def job_run_timeline(raw: Callable[[str], DataFrame]) -> DataFrame:
    c = F.col
    ok = c("o_orderkey")
    minute = ok % 600 + c("l_linenumber") * 60
    status = c("o_orderstatus")
    lines = raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        _s(c("o_custkey") % 5).alias("workspace_id"),
        c("o_custkey").alias("job_id"),
        ok.alias("run_id"),
        _after(BASE, days=ok % 60, mins=minute).alias("period_start_time"),
        _after(BASE, days=ok % 60, mins=minute + 30 + c("l_partkey") % 30).alias("period_end_time"),
        F.when(c("l_linenumber") >= 6,
               F.when(status == "F", "FAILED").when(status == "O", "SUCCESS").otherwise("CANCELED"))
        .alias("result_state"),
    )


def pipelines(raw: Callable[[str], DataFrame]) -> DataFrame:
    c = F.col
    return _versions(raw, "nation").select(
        _s(c("n_nationkey") % 5).alias("workspace_id"),
        c("n_nationkey").alias("pipeline_id"),
        F.concat(c("n_name"), F.lit("_v"), _s(c("r_regionkey"))).alias("name"),
        _after("2023-06-01 00:00:00", days=c("r_regionkey") * 10).alias("change_time"),
    )


def pipeline_update_timeline(raw: Callable[[str], DataFrame]) -> DataFrame:
    c = F.col
    ok, prio = c("o_orderkey"), c("o_orderpriority")
    return raw("orders").select(
        _s(ok % 20 % 5).alias("workspace_id"),
        (ok % 20).alias("pipeline_id"),
        _after(BASE, days=ok % 60, hours=c("o_custkey") % 24).alias("period_start_time"),
        F.when(prio == "1-URGENT", "FAILED").when(prio == "2-HIGH", F.lit(None).cast("string"))
        .otherwise("COMPLETED").alias("result_state"),
    )


def query_history(raw: Callable[[str], DataFrame]) -> DataFrame:
    c = F.col
    ok = c("o_orderkey")
    return raw("orders").select(
        F.concat(F.lit("user"), _s(c("o_custkey") % 50), F.lit("@example.com")).alias("executed_by"),
        F.struct(F.concat(F.lit("wh-"), _s(ok % 4)).alias("warehouse_id")).alias("compute"),
        c("o_orderpriority").alias("statement_type"),
        F.floor("o_totalprice").cast("bigint").alias("total_duration_ms"),
        (ok % 1000).alias("rows_produced"),
        F.when(c("o_orderstatus") == "F", "FAILED").otherwise("FINISHED").alias("execution_status"),
        _after(BASE, days=ok % 60, hours=c("o_custkey") % 24).alias("start_time"),
    )


def conversations(raw: Callable[[str], DataFrame]) -> DataFrame:
    """The conversations, with code fences put around parts of most texts: a closed and an unclosed ``sql`` fence, a
    bare fence, a bare fence before a ``sql`` fence, an empty one, and none."""
    c = F.col
    kind, text = (c("conv_id") + c("turn")) % 6, c("text")
    block = lambda fence, end: F.concat(F.lit(f"See:\n{fence}\n  SELECT "), _s(c("conv_id")), F.lit("\n"), text, F.lit(end))
    return raw("conversations").select("conv_id", "turn", "role", F.when(kind == 0, block("```sql", "\n```\nDone."))
                                       .when(kind == 1, block("```", "```")).when(kind == 2, block("```sql", "\n"))
                                       .when(kind == 3, F.concat(F.lit("```\nplain\n```\n"), block("```sql", "```")))
                                       .when(kind == 4, F.concat(text, F.lit("``````"))).otherwise(text).alias("text"))


DERIVATIONS: dict[str, Callable[[Callable[[str], DataFrame]], DataFrame]] = {
    "usage": usage,
    "list_prices": list_prices,
    "audit": audit,
    "clusters": clusters,
    "jobs": jobs,
    "job_run_timeline": job_run_timeline,
    "pipelines": pipelines,
    "pipeline_update_timeline": pipeline_update_timeline,
    "query_history": query_history,
}


# Columns of the raw test tables that the derivation reads. Declaring them skips
# parquet schema inference (a Spark job per read) and prunes every other column.
RAW_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderpriority STRING",
    "part": "p_partkey BIGINT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING",
    "customer": "c_custkey BIGINT, c_name STRING",
    "nation": "n_nationkey INT, n_name STRING",
    "region": "r_regionkey INT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def raw_reader(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    def read(name: str) -> DataFrame:
        reader = spark.read
        if name in RAW_SCHEMAS:
            reader = reader.schema(RAW_SCHEMAS[name])
        return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

    return read


def loaders(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    raw = raw_reader(spark, sf_dir)
    out = {name: (lambda fn=fn: fn(raw)) for name, fn in DERIVATIONS.items()}
    out["conversations"] = lambda: conversations(raw)
    return out
