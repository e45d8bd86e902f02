"""DuckDB oracle texts: the flat fixture derivation plus one SQL text per query.

The driver registers the raw test tables (lineitem, orders, ...) as views;
each oracle text derives the source tables as CTEs and runs the query in plain
SQL. Decimal outputs are cast to DOUBLE and times are naive TIMESTAMPs, the
same normalisation the Spark side applies to its output.
"""

from __future__ import annotations

AS_OF_TS = "TIMESTAMP '2024-01-31 00:00:00'"
AS_OF_DATE = "DATE '2024-01-31'"

# Flat derivation of the source tables from the raw test tables (FIXTURES.md §2).
SOURCE_SQL = {
    "usage": """select cast(l_suppkey%5 as string) workspace_id, concat('SKU_',cast(l_partkey//3 as string)) sku_name,
 case l_returnflag when 'A' then 'JOBS' when 'N' then 'SQL' else 'ALL_PURPOSE' end billing_origin_product,
 cast(TIMESTAMP '2023-12-03 00:00:00' + INTERVAL '1' DAY * cast((l_orderkey*7+l_linenumber)%60 as int) as date) usage_date,
 TIMESTAMP '2023-12-03 00:00:00' + INTERVAL '1' DAY * cast((l_orderkey*7+l_linenumber)%60 as int) + INTERVAL '1' HOUR * cast((l_partkey+l_linenumber)%24 as int) usage_start_time,
 TIMESTAMP '2023-12-03 00:00:00' + INTERVAL '1' DAY * cast((l_orderkey*7+l_linenumber)%60 as int) + INTERVAL '1' HOUR * cast((l_partkey+l_linenumber)%24+1 as int) usage_end_time,
 cast(l_quantity as decimal(18,2)) usage_quantity,
 case when l_linenumber<>7 then concat('user',cast(l_orderkey%150 as string),'@example.com') end run_as,
 case when l_returnflag='R' and l_suppkey%4<>0 then concat('c-',cast(l_suppkey as string)) end cluster_id,
 case when l_returnflag='A' then concat('job_',cast(l_suppkey%10 as string)) end job_name,
 case when l_returnflag='N' and l_linestatus='O' then concat('/nb/',cast(l_partkey%10 as string)) end notebook_path from lineitem""",
    "list_prices": """select concat('SKU_',cast(p_partkey//3 as string)) sku_name,
 case p_partkey%3 when 0 then TIMESTAMP '2023-01-01 00:00:00' when 1 then TIMESTAMP '2023-12-20 00:00:00' else TIMESTAMP '2024-01-15 00:00:00' end price_start_time,
 case p_partkey%3 when 0 then TIMESTAMP '2023-12-20 00:00:00' when 1 then case when p_partkey//3%40=7 then TIMESTAMP '2024-01-20 00:00:00' else TIMESTAMP '2024-01-15 00:00:00' end end price_end_time,
 cast(p_retailprice as decimal(18,2)) price from part where p_partkey//3%25<>24""",
    "audit": """select event_id, ts event_time, cast(ts as date) event_date, cast(user_id%5 as string) workspace_id,
 case when user_id%25=0 then concat('System-User-',cast(user_id as string)) else concat('user',cast(user_id as string),'@example.com') end email,
 case when event_type='click' then 'unityCatalog' else 'workspace' end service_name,
 case event_type when 'view' then case k%3 when 0 then 'mintOAuthToken' when 1 then 'mintOAuthAuthorizationCode' else 'workspaceInHouseOAuthClientAuthentication' end
  when 'signup' then case k%2 when 0 then 'addPrincipalToGroup' else 'removePrincipalFromGroup' end
  when 'error' then case k%2 when 0 then 'IpAccessDenied' else 'accountIpAclsValidationFailed' end
  when 'purchase' then case k%3 when 0 then 'deleteCluster' when 1 then 'deleteJob' else 'deleteTable' end
  else case k%2 when 0 then 'updatePermissions' else 'getTable' end end action_name,
 case when k%3=0 then 'admins' else 'users' end target_group, concat('user',cast(k as string),'@example.com') target_user,
 concat('10.0.',cast(user_id%256 as string),'.',cast(k as string)) source_ip_address
 from (select *, cast(regexp_extract(props,'([0-9]+)',1) as int) k from events) e""",
    "clusters": """select concat('c-',cast(s_suppkey as string)) cluster_id, cast(s_suppkey%5 as string) workspace_id, concat(s_name,'_v',cast(r_regionkey as string)) cluster_name,
 case when s_suppkey%3<>0 then concat('user',cast(s_suppkey%150 as string),'@example.com') end owned_by, case when s_suppkey%2=0 then 'UI' else 'JOB' end cluster_source,
 TIMESTAMP '2023-12-01 00:00:00' + INTERVAL '1' DAY * cast(r_regionkey*10 as int) change_time,
 case s_suppkey % 3 when 0 then 'TERMINATED' else 'RUNNING' end AS state, concat('driver-', cast((s_suppkey+r_regionkey)%4 as string)) driver_node_type_id,
 case when (s_suppkey+r_regionkey)%7<>0 then concat('worker-', cast((s_suppkey+r_regionkey)%5 as string)) end node_type_id,
 case when s_suppkey%2=0 then concat('{"min_workers":', (s_suppkey+r_regionkey)%3+1, ',"max_workers":', (s_suppkey+r_regionkey)%9+4, '}') end autoscale,
 case when s_suppkey%2=1 then cast((s_suppkey+r_regionkey)%8 as int) end num_workers from supplier cross join region""",
    "jobs": """select cast(c_custkey%5 as string) workspace_id, c_custkey job_id, concat(c_name,'_v',cast(r_regionkey as string)) name, concat('user',cast(c_custkey%150 as string),'@example.com') creator_user_name,
 TIMESTAMP '2023-06-01 00:00:00' + INTERVAL '1' DAY * cast(r_regionkey*10 as int) change_time from customer cross join region where c_custkey%10<>9""",
    "job_run_timeline": """select cast(o_custkey%5 as string) workspace_id, o_custkey job_id, o_orderkey run_id,
 TIMESTAMP '2023-12-03 00:00:00' + INTERVAL '1' DAY * cast(o_orderkey%60 as int) + INTERVAL '1' MINUTE * cast(o_orderkey%600+l_linenumber*60 as int) period_start_time,
 TIMESTAMP '2023-12-03 00:00:00' + INTERVAL '1' DAY * cast(o_orderkey%60 as int) + INTERVAL '1' MINUTE * cast(o_orderkey%600+l_linenumber*60+30+l_partkey%30 as int) period_end_time,
 case when l_linenumber>=6 then case o_orderstatus when 'F' then 'FAILED' when 'O' then 'SUCCESS' else 'CANCELED' end end result_state
 from lineitem join orders on l_orderkey=o_orderkey""",
    "pipelines": """select cast(n_nationkey%5 as string) workspace_id, n_nationkey pipeline_id, concat(n_name,'_v',cast(r_regionkey as string)) name, TIMESTAMP '2023-06-01 00:00:00' + INTERVAL '1' DAY * cast(r_regionkey*10 as int) change_time from nation cross join region""",
    "pipeline_update_timeline": """select cast(o_orderkey%20%5 as string) workspace_id, o_orderkey%20 pipeline_id, TIMESTAMP '2023-12-03 00:00:00' + INTERVAL '1' DAY * cast(o_orderkey%60 as int) + INTERVAL '1' HOUR * cast(o_custkey%24 as int) period_start_time,
 case o_orderpriority when '1-URGENT' then 'FAILED' when '2-HIGH' then null else 'COMPLETED' end result_state from orders""",
    "query_history": """select concat('user',cast(o_custkey%50 as string),'@example.com') executed_by, concat('wh-',cast(o_orderkey%4 as string)) warehouse_id, o_orderpriority statement_type,
 cast(floor(o_totalprice) as bigint) total_duration_ms, o_orderkey%1000 rows_produced, case o_orderstatus when 'F' then 'FAILED' else 'FINISHED' end execution_status,
 TIMESTAMP '2023-12-03 00:00:00' + INTERVAL '1' DAY * cast(o_orderkey%60 as int) + INTERVAL '1' HOUR * cast(o_custkey%24 as int) start_time from orders""",
    "fenced_conversations": """select conv_id, turn, role, case (conv_id+turn)%6
 when 0 then concat('See:', chr(10), '```sql', chr(10), '  SELECT ', conv_id, chr(10), text, chr(10), '```', chr(10), 'Done.')
 when 1 then concat('See:', chr(10), '```', chr(10), '  SELECT ', conv_id, chr(10), text, '```')
 when 2 then concat('See:', chr(10), '```sql', chr(10), '  SELECT ', conv_id, chr(10), text, chr(10))
 when 3 then concat('```', chr(10), 'plain', chr(10), '```', chr(10), 'See:', chr(10), '```sql', chr(10), '  SELECT ', conv_id, chr(10), text, '```')
 when 4 then concat(text, '``````') else text end as text from conversations""",
}

ORDER = list(SOURCE_SQL)


def with_sources(body: str, *ctes: tuple[str, str]) -> str:
    """Prefix ``body`` with the source CTEs it names plus extra ``(name, sql)`` CTEs."""
    text = body + " " + " ".join(s for _, s in ctes)
    used = [n for n in ORDER if _mentions(text, n)]
    parts = [f"{n} AS ({SOURCE_SQL[n]})" for n in used]
    parts += [f"{n} AS ({s})" for n, s in ctes]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


def _mentions(text: str, name: str) -> bool:
    import re

    return re.search(rf"\b{name}\b", text) is not None
