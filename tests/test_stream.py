"""Stream jobs."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from watchfold.plans.batch import Fitted
from watchfold.streaming import live, running_state

NORMAL = {"entity_id": "calm", "department": "Engineering", "event_ts": "2024-02-01T10:00:00Z", "login_status": "Success"}


@pytest.fixture(scope="module")
def risky(log):
    """A quiet row of the log, and the same with every risk rule at work."""
    row = log.where("label = 'Normal' AND failed_attempts = 0").orderBy("event_id").first().asDict()
    calm = {k: v.isoformat() + "Z" if isinstance(v, dt.datetime) else v for k, v in row.items() if k != "event_id"}
    calm |= {"entity_id": "calm"}
    storm = {
        "entity_id": "storm", "is_off_hours": True, "login_hour": 2, "new_device": True, "new_location": True,
        "resource_sensitivity": "Critical", "privilege_level": "Admin", "failed_attempts": 17,
        "geo_velocity_kmph": 2750.0, "bytes_uploaded": 31_000_000, "login_status": "Failed",
    }
    return [calm, {**calm, **storm}]


def _folder(tmp_path, *batches):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, rows in enumerate(batches):
        (folder / f"{i}.json").write_text("\n".join(json.dumps(r) for r in rows))
    return str(folder)


def test_live_responses(spark, batch, tmp_path, risky):
    folder = _folder(tmp_path, risky)
    out = live.drain(live.json_stream(spark, folder), lambda b: live.respond_to(b, batch.fitted))
    got = {r["entity_id"]: r for r in out.collect()}
    assert out.columns == live.RESPONSE
    assert isinstance(got["calm"]["is_anomaly"], bool) and got["calm"]["event_id"].startswith("rt_")
    assert got["storm"]["risk_score"] > 50 and got["storm"]["risk_level"] in ("High", "Critical")
    if got["storm"]["is_anomaly"]:
        assert got["storm"]["attack_classification"] in batch.fitted.classifier.classes
        assert "Contribution Score" in got["storm"]["explanation"]
    assert json.loads(live.as_json(out).first()["response"])["recommended_actions"]


def test_saved_scorer_gives_the_same_answers(spark, batch, tmp_path, log):
    path = str(tmp_path / "fitted")
    batch.fitted.save(path)
    loaded = Fitted.load(spark, path)
    cols = ["event_id", "is_anomaly", "attack_classification", "risk_score"]
    a = live.respond_to(log, batch.fitted).select(*cols)
    b = live.respond_to(log, loaded).select(*cols)
    assert a.exceptAll(b).isEmpty() and a.count() == 1000


def test_state_carries_over_micro_batches(spark, events, tmp_path):
    status = ["Failed", "Failed", "Success", "Failed", "Failed", "Failed", "Success"]
    df = live.zoned(events([{"login_status": s, "session_duration_min": float(i)} for i, s in enumerate(status)]))
    folder = str(tmp_path / "in")
    df.where("event_id < 2").coalesce(1).write.parquet(folder)
    df.where("event_id BETWEEN 2 AND 4").coalesce(1).write.mode("append").parquet(folder)
    df.where("event_id > 4").coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = live.drain(running_state.running_stream(stream, 7.0, "0 seconds")).orderBy("event_id").collect()
    assert [r["consecutive_failures"] for r in out] == [1, 2, 0, 1, 2, 3, 0]
    assert [r["entity_avg_session"] for r in out] == pytest.approx([0, 0.5, 1, 1.5, 2, 2.5, 3])
    assert [r["time_since_last_login_min"] for r in out] == [7.0] + [1.0] * 6
    assert out[-1]["entity_std_session"] == pytest.approx(2.1602468994692865)


def test_rows_out_of_order_wait_for_the_watermark(spark, events, tmp_path):
    """Minutes 0 to 9 in five triggers, each up to four minutes late; one row too late; the last minutes still wait."""
    rows = [{"login_status": "Failed" if i % 3 else "Success", "resource_accessed": f"r{i % 2}"} for i in range(10)]
    df = live.zoned(events(rows))
    folder = str(tmp_path / "in")
    for part in ([3, 1], [4, 0], [7, 6, 2], [5, 9], [8]):
        df.where(F.col("event_id").isin(part)).coalesce(1).write.mode("append").parquet(folder)
    df.where("event_id = 1").withColumn("event_id", F.lit(77).cast("long")).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    path = str(tmp_path / "out")
    query = live.write_batches(running_state.running_stream(stream, 7.0, "5 minutes"), path)
    query.awaitTermination()
    out = spark.read.parquet(path).orderBy("event_id").collect()
    assert [r["event_id"] for r in out] == [0, 1, 2, 3, 4]  # the watermark ends at minute 9 - 5
    assert [r["entity_login_count"] for r in out] == [1, 2, 3, 4, 5]
    assert [r["consecutive_failures"] for r in out] == [0, 1, 2, 0, 1]
    assert [r["time_since_last_login_min"] for r in out] == [7.0] + [1.0] * 4
    assert [r["resource_access_entropy_to_date"] for r in out] == pytest.approx([0, 1, 0.9182958340544896, 1, 0.9709505944546686])
    assert running_state.late_rows(query) == 1


def test_equal_times_see_each_other(spark, events, tmp_path):
    at = dt.datetime(2024, 1, 1, 10)
    df = live.zoned(events([{"event_ts": at, "resource_accessed": f"r{i}"} for i in range(4)]))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    out = live.drain(running_state.running_stream(stream, None, "0 seconds")).orderBy("event_id").collect()
    assert [r["resource_access_entropy_to_date"] for r in out] == [2.0] * 4
    assert [r["entity_login_count"] for r in out] == [1, 2, 3, 4]


def test_empty_source_with_a_transform(spark, batch, tmp_path):
    (tmp_path / "none").mkdir()
    out = live.drain(live.json_stream(spark, str(tmp_path / "none")), lambda b: live.respond_to(b, batch.fitted))
    assert out.count() == 0 and out.columns == live.RESPONSE


def test_late_events_are_left_out_of_closed_hours(spark, tmp_path):
    at = lambda h: {**NORMAL, "event_ts": (dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)).isoformat() + "Z"}
    folder = _folder(tmp_path, [at(0.5), at(5.5)], [at(6.5)], [at(0.6), at(9.0)])
    stream = live.json_stream(spark, folder, files_per_batch=1)
    out = live.drain(live.hourly_anomalies(stream)).orderBy("hour_start").collect()
    assert [(r["hour_start"].hour, r["events"]) for r in out] == [(0, 1), (5, 1), (6, 1)]


def test_duplicates_across_batches(spark, tmp_path):
    row = {**NORMAL, "event_id": "7"}
    folder = _folder(tmp_path, [row, {**row, "event_id": "8"}], [row])
    out = live.drain(live.deduplicated(live.json_stream(spark, folder, files_per_batch=1)))
    assert sorted(r["event_id"] for r in out.collect()) == ["7", "8"]
    assert out.where(F.col("department") == "Engineering").count() == 2


def test_a_job_started_again_goes_on(spark, tmp_path):
    row = {**NORMAL, "event_id": "1"}
    folder, out = _folder(tmp_path, [row, {**row, "event_id": "2"}]), str(tmp_path / "out")

    def run():
        stream = live.deduplicated(live.json_stream(spark, folder))
        live.write_batches(stream, out).awaitTermination()
        return sorted(r["event_id"] for r in spark.read.parquet(out).collect())

    assert run() == ["1", "2"]
    assert run() == ["1", "2"]
    (tmp_path / "in" / "more.json").write_text("\n".join(json.dumps({**row, "event_id": i}) for i in "23"))
    assert run() == ["1", "2", "3"]


def test_time_under_either_name_and_empty_source(spark, tmp_path):
    late = {k: v for k, v in NORMAL.items() if k != "event_ts"} | {"timestamp": "2024-03-05T06:07:08Z"}
    out = live.drain(live.json_stream(spark, _folder(tmp_path, [NORMAL, late])))
    assert sorted(r["event_ts"].month for r in out.collect()) == [2, 3] and "timestamp" not in out.columns
    (tmp_path / "none").mkdir()
    assert live.drain(live.json_stream(spark, str(tmp_path / "none"))).count() == 0


def test_entities_share_state_keys(spark, events, tmp_path):
    """Many entities cost few calls of the state: rows that are stored do not grow with them."""
    rows = [{"entity_id": f"e{i % 3000}", "event_ts": dt.datetime(2024, 1, 1, 10 + i // 3000)} for i in range(6000)]
    df = live.zoned(events(rows))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    path = str(tmp_path / "out")
    query = live.write_batches(running_state.running_stream(stream, None, "0 seconds"), path)
    query.awaitTermination()
    out = spark.read.parquet(path)
    assert {(r["entity_login_count"], r["count"]) for r in out.groupBy("entity_login_count").count().collect()} == {(1, 3000), (2, 3000)}
    assert query.lastProgress.stateOperators[0].numRowsTotal < 3000


class _Map:
    def __init__(self):
        self.rows = {}

    def getValue(self, key):  # noqa: N802
        return self.rows.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self.rows[key] = value


def test_pages_double_and_keep_their_rows(monkeypatch):
    monkeypatch.setattr(running_state, "PAGE", 8)
    pages, n, stored = 1, 0, running_state.Pages(_Map(), 2)
    for first in range(0, 90, 30):  # ten rows of each step are known from the one before
        keys = np.array(["", *(f"k{i}" for i in range(first, first + 40))], object)
        got, held = stored.get(keys, pages)
        assert (got[11:] == 0).all() and (got[0] == first // 30).all() and (got[1:11] == bool(first)).all()
        pages, n = stored.update(keys, got + 1, held, pages, n)
    assert n == 101 and pages > 8 and stored.get(np.array(["k5", "k35"], object), pages)[0].tolist() == [[1, 1], [2, 2]]
