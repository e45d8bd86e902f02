"""Spark schemas of the source tables and the one output table with fixed DDL."""

from pyspark.sql import types as T

_S, _TS, _D, _L = T.StringType(), T.TimestampType(), T.DateType(), T.LongType()
_MONEY = T.DecimalType(18, 2)


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


USAGE = T.StructType([
    _f("workspace_id", _S), _f("sku_name", _S), _f("billing_origin_product", _S),
    _f("usage_date", _D), _f("usage_start_time", _TS), _f("usage_end_time", _TS),
    _f("usage_quantity", _MONEY),
    _f("identity_metadata", T.StructType([_f("run_as", _S)])),
    _f("usage_metadata", T.StructType([_f("cluster_id", _S), _f("job_name", _S), _f("notebook_path", _S)])),
])

LIST_PRICES = T.StructType([
    _f("sku_name", _S), _f("price_start_time", _TS), _f("price_end_time", _TS),
    _f("pricing", T.StructType([_f("effective_list", T.StructType([_f("default", _MONEY)]))])),
])

AUDIT = T.StructType([
    _f("event_id", _L), _f("event_time", _TS), _f("event_date", _D), _f("workspace_id", _S),
    _f("service_name", _S), _f("action_name", _S), _f("user_identity", T.StructType([_f("email", _S)])),
    _f("source_ip_address", _S), _f("request_params", T.MapType(_S, _S)),
])

CLUSTERS = T.StructType([
    _f("workspace_id", _S), _f("cluster_id", _S), _f("cluster_name", _S), _f("owned_by", _S),
    _f("cluster_source", _S), _f("change_time", _TS),
])

JOBS = T.StructType([
    _f("workspace_id", _S), _f("job_id", _L), _f("name", _S), _f("creator_user_name", _S), _f("change_time", _TS),
])

JOB_RUN_TIMELINE = T.StructType([
    _f("workspace_id", _S), _f("job_id", _L), _f("run_id", _L), _f("period_start_time", _TS),
    _f("period_end_time", _TS), _f("result_state", _S),
])

PIPELINES = T.StructType([
    _f("workspace_id", _S), _f("pipeline_id", T.IntegerType()), _f("name", _S), _f("change_time", _TS),
])

PIPELINE_UPDATE_TIMELINE = T.StructType([
    _f("workspace_id", _S), _f("pipeline_id", _L), _f("period_start_time", _TS), _f("result_state", _S),
])

QUERY_HISTORY = T.StructType([
    _f("executed_by", _S), _f("compute", T.StructType([_f("warehouse_id", _S)])), _f("statement_type", _S),
    _f("total_duration_ms", _L), _f("rows_produced", _L), _f("execution_status", _S), _f("start_time", _TS),
])

TERMINATION_LOG = T.StructType([
    _f("termination_time", _TS), _f("cluster_names", T.ArrayType(_S)),
])

SOURCES = {
    "usage": USAGE,
    "list_prices": LIST_PRICES,
    "audit": AUDIT,
    "clusters": CLUSTERS,
    "jobs": JOBS,
    "job_run_timeline": JOB_RUN_TIMELINE,
    "pipelines": PIPELINES,
    "pipeline_update_timeline": PIPELINE_UPDATE_TIMELINE,
    "query_history": QUERY_HISTORY,
}
