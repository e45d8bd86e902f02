"""How refreshes that overlap keep out of each other's way: leases on what is being written, a lock around commits.

Both live in the catalog, whose one atomic operation is used: creating a table fails if it is there. A *lease* is a property
of a version table: until when its writer claims it. A writer renews it while it works, so what a dead one left runs out. A
*lock* is a small table with an owner and an end. It is held for a commit only, which is catalog metadata and takes
moments; one that a dead process left is taken over after its end.
"""

from __future__ import annotations

import contextlib
import threading
import time
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

#: Seconds that a version is claimed by its writer without a renewal, and a commit by its owner.
LEASE, COMMIT = 3600.0, 300.0
MISSING = "TABLE_OR_VIEW_NOT_FOUND"
PRESENT = ("TABLE_OR_VIEW_ALREADY_EXISTS", "LOCATION_ALREADY_EXISTS")


def properties(spark: SparkSession, name: str) -> dict[str, str] | None:
    """The properties of a table or view; None if there is none of that name."""
    if not spark.catalog.tableExists(name):
        return None
    try:
        return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    except AnalysisException as e:
        if e.getCondition() != MISSING:
            raise
        return None


def started(version: str) -> int:
    """When the refresh that writes ``version`` began (nanoseconds; part of its name)."""
    return int(version.rsplit("__", 1)[1][1:])


def leased_until(spark: SparkSession, version: str) -> float:
    """Until when the version is claimed; one without a lease is being created."""
    until = (properties(spark, version) or {}).get("lease_until")
    return started(version) / 1e9 + LEASE if until is None else float(until)


@contextlib.contextmanager
def lease(spark: SparkSession, version: str) -> Iterator[None]:
    """Claim ``version`` while the block runs; afterwards, also after an error, it is nobody's."""
    def claim(until: float) -> None:
        spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES ('lease_until' = '{until}')")

    over = threading.Event()

    def renew() -> None:
        while not over.wait(LEASE / 3):
            claim(time.time() + LEASE)

    claim(time.time() + LEASE)
    renewal = threading.Thread(target=renew, daemon=True)
    renewal.start()
    try:
        yield
    finally:
        over.set()
        renewal.join()
        if properties(spark, version) is not None:
            claim(0.0)


@contextlib.contextmanager
def lock(spark: SparkSession, name: str, patience: float = 2 * COMMIT) -> Iterator[None]:
    """Hold the lock table ``name`` while the block runs. The block's last step must ask ``holds`` if it took long."""
    owner, deadline = uuid.uuid4().hex, time.time() + patience
    while True:
        try:
            spark.sql(f"CREATE TABLE {name} (owner STRING) USING parquet "
                      f"TBLPROPERTIES ('held_by' = '{owner}', 'until' = '{time.time() + COMMIT}')")
            if (properties(spark, name) or {}).get("held_by") == owner:
                break
        except AnalysisException as e:
            if e.getCondition() not in PRESENT:
                raise
        held = properties(spark, name)
        if held is not None and float(held.get("until", 0)) < time.time():
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # its owner died
        elif time.time() > deadline:
            raise TimeoutError(f"{name} is held by another refresh")
        else:
            time.sleep(0.05)
    try:
        yield
    finally:
        if (properties(spark, name) or {}).get("held_by") == owner:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
