"""Fenced-code extraction (N2), context JSON (N1) and termination log rows (M1)."""

import json

from pyspark.sql import functions as F

from tests.conftest import AS_OF, money, telemetry
from vantage.functions.text import fenced_block
from vantage.functions.time import AsOf
from vantage.plans import actions, context

CASES = [
    ("Here:\n```sql\nSELECT 1\n```\nbye", "SELECT 1"),
    ("```\nSELECT 2;\n```", "SELECT 2;"),
    ("start ```sql SELECT 3", "SELECT 3"),           # unclosed fence runs to the end
    ("```python\nx=1\n``` and ```sql\nSELECT 4\n```", "SELECT 4"),  # sql fence preferred
    ("no code here", None),
    (None, None),
]


def test_fenced_block(spark):
    df = spark.createDataFrame([(t,) for t, _ in CASES], "text string")
    got = [r.x for r in df.select(fenced_block(F.col("text")).alias("x")).collect()]
    assert got == [e for _, e in CASES]


def test_extract_keeps_every_row(spark):
    df = spark.createDataFrame([(1, 0, "assistant", CASES[0][0]), (1, 1, "user", "```x```")],
                               "conv_id long, turn long, role string, text string")
    out = context.extract_fenced_sql(df).collect()
    assert [r.extracted_sql for r in out] == ["SELECT 1", "x"]


def test_context_json_one_document_per_day_and_workspace(spark):
    usage = [dict(usage_quantity=money(2), sku_name=f"SKU_{i}") for i in range(3)]
    t = telemetry(spark, usage=usage)
    (row,) = context.cost_context_json(t, AsOf(AS_OF)).collect()
    doc = json.loads(row.context_json)
    assert [x["sku_name"] for x in doc] == ["SKU_0", "SKU_1", "SKU_2"]
    assert doc[0]["estimated_cost_usd"] is None and doc[0]["total_dbus"] == 2.0


def test_fence_runs_to_the_end_of_the_text(spark):
    """An unclosed fence ends with the text, not before its last line break."""
    df = spark.createDataFrame([("```sql\nSELECT 1\n\nFROM t\n",), ("``````",)], "text string")
    assert [r.x for r in df.select(fenced_block(F.col("text")).alias("x")).collect()] == ["SELECT 1\n\nFROM t", ""]


def test_fixture_texts_have_fences_at_every_size(spark):
    from vantage import registry

    t = registry.telemetry(spark, "/root/testdata/sf0.001")
    rows = context.assistant_sql(t).collect()
    found = [r.extracted_sql for r in rows if r.extracted_sql is not None]
    assert 0.5 * len(rows) < len(found) < len(rows) and "" in found and any(x.startswith("SELECT") for x in found)


def test_one_log_row_per_cluster_acted_on(spark):
    """One workspace holds nearly all clusters: still a row each, none gathered."""
    clusters = [dict(cluster_id=f"c-{i}", cluster_name=f"n{i:03d}", workspace_id="1" if i else "2") for i in range(200)]
    t = telemetry(spark, clusters=clusters)
    todo = actions.idle_cluster_actions(t, AsOf(AS_OF))
    rows = actions.termination_log_rows(todo.filter("cluster_id <> 'c-5'"), AsOf(AS_OF), "run-1")
    got = rows.collect()
    assert len(got) == 199 and all(len(r.cluster_names) == 1 and r.run_id == "run-1" for r in got)
    assert "c-5" not in {r.cluster_id for r in got}
    assert "Window" not in rows._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
