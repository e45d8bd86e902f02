from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vantage.session import build_session  # noqa: E402
from vantage.sources import schemas as S  # noqa: E402
from vantage.sources.telemetry import Telemetry  # noqa: E402

AS_OF = "2024-01-31 00:00:00"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    scratch = tempfile.mkdtemp(prefix="vantage-tests-")
    s = build_session("local[4]", app_name="vantage-tests", shuffle_partitions=8,
                      conf={"spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    yield s
    s.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


# Default values per source column; tests override what matters.
DEFAULTS = {
    "usage": dict(workspace_id="1", sku_name="SKU_1", billing_origin_product="JOBS", usage_date=d("2024-01-30"),
                  usage_start_time=ts("2024-01-30 10:00:00"), usage_end_time=ts("2024-01-30 11:00:00"),
                  usage_quantity=None, identity_metadata=("u@x.com",), usage_metadata=(None, None, None)),
    "list_prices": dict(sku_name="SKU_1", price_start_time=ts("2023-01-01 00:00:00"), price_end_time=None,
                        pricing=((None,),)),
    "audit": dict(event_id=1, event_time=ts("2024-01-30 10:00:00"), event_date=d("2024-01-30"), workspace_id="1",
                  service_name="workspace", action_name="getTable", user_identity=("u@x.com",),
                  source_ip_address="10.0.0.1", request_params={}),
    "clusters": dict(workspace_id="1", cluster_id="c-1", cluster_name="c1", owned_by="o@x.com", cluster_source="UI",
                     change_time=ts("2024-01-01 00:00:00")),
    "jobs": dict(workspace_id="1", job_id=1, name="job", creator_user_name="o@x.com",
                 change_time=ts("2024-01-01 00:00:00")),
    "job_run_timeline": dict(workspace_id="1", job_id=1, run_id=1, period_start_time=ts("2024-01-30 10:00:00"),
                             period_end_time=ts("2024-01-30 10:30:00"), result_state=None),
    "pipelines": dict(workspace_id="1", pipeline_id=1, name="p", change_time=ts("2024-01-01 00:00:00")),
    "pipeline_update_timeline": dict(workspace_id="1", pipeline_id=1, period_start_time=ts("2024-01-30 10:00:00"),
                                     result_state=None),
    "query_history": dict(executed_by="u@x.com", compute=("wh-1",), statement_type="SELECT", total_duration_ms=1000,
                          rows_produced=1, execution_status="FINISHED", start_time=ts("2024-01-30 10:00:00")),
}


def frame(spark, name: str, rows: list[dict], schema=None):
    """A source-shaped DataFrame from partial rows (missing columns take defaults)."""
    schema = schema or S.SOURCES[name]
    full = []
    for r in rows:
        row = dict(DEFAULTS[name])
        row.update(r)
        full.append(tuple(row[f.name] for f in schema.fields))
    return spark.createDataFrame(full, schema)


def telemetry(spark, **tables) -> Telemetry:
    """Telemetry from hand-made rows; every source not given is empty."""
    frames = {}
    for name in S.SOURCES:
        frames[name] = frame(spark, name, tables.get(name, []))
    return Telemetry.from_frames(spark, frames)


def money(x) -> object:
    from decimal import Decimal

    return None if x is None else Decimal(str(x))
