from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from watchfold.operators import classify as cl  # noqa: E402
from watchfold.plans.batch import run_batch  # noqa: E402
from watchfold.session import local_session, ship_code  # noqa: E402
from watchfold.sources.access_log import access_schema, read_access_log  # noqa: E402

TINY = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    ship_code(session)
    return session


@pytest.fixture(scope="session")
def log(spark):
    return read_access_log(spark, TINY).cache()


@pytest.fixture(scope="session")
def batch(spark):
    """The full batch job where all seven attack types occur."""
    return run_batch(read_access_log(spark, SMALL), effort=cl.Effort(trees=20, tree_depth=8, rounds=20))


@pytest.fixture
def events(spark):
    """Build access events from partial dicts; the rest has quiet defaults."""
    import datetime as dt

    base = dict(
        entity_id="e1", entity_type="User", department="d1", login_hour=10, is_off_hours=False,
        day_of_week="Monday", source_ip="10.0.0.1", geo_location="g1", geo_velocity_kmph=0.0,
        resource_accessed="r1", resource_type="t1", resource_sensitivity="Low", auth_method="MFA",
        login_status="Success", session_duration_min=10.0, command_sequence="a", device_fingerprint="f1",
        os="Linux", browser="Edge", protocol="SSH", privilege_level="User", bytes_uploaded=100,
        bytes_downloaded=200, failed_attempts=0, new_device=False, new_location=False, label="Normal",
        anomaly_type="Normal",
    )
    start = dt.datetime(2024, 1, 1)

    def make(rows):
        schema = access_schema()
        out = []
        for i, row in enumerate(rows):
            full = {**base, "event_id": i, "event_ts": start + dt.timedelta(minutes=i), **row}
            out.append(tuple(full[f.name] for f in schema.fields))
        return spark.createDataFrame(out, schema)

    return make
