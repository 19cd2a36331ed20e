"""Registered queries: the stream jobs, run over what is available."""

from __future__ import annotations

from pyspark.sql import functions as F

from watchfold.operators import profiles, running
from watchfold.plans import oracle as o
from watchfold.plans.q_profiles import _apply_sql
from watchfold.plans.registry import batch, log, prepared, query, r
from watchfold.session import fresh_path
from watchfold.streaming import live, running_state


@query(
    "o01_ingest",
    o.sql("SELECT event_id, entity_id, resource_accessed, bytes_uploaded FROM access_log"),
)
def o01(spark, sf):
    out = live.drain(live.table_stream(spark, sf))
    return out.select("event_id", "entity_id", "resource_accessed", "bytes_uploaded")


@query(
    "o01_ingest_json",
    o.sql("SELECT CAST(event_id AS VARCHAR) AS event_id, entity_id, login_hour, new_device, epoch_us(event_ts) AS ts_us FROM access_log"),
)
def o01_json(spark, sf):
    """JSON records on a file stream."""
    path = fresh_path(spark, "json-in")
    live.zoned(log(spark, sf)).write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    out = live.drain(live.json_stream(spark, path))
    return out.select("event_id", "entity_id", "login_hour", "new_device", F.unix_micros("event_ts").alias("ts_us"))


@query(
    "o02_stateless_enrich",
    f"SELECT d.*, e.hour_sin, e.is_weekend, e.peer_session_deviation FROM ({_apply_sql('TRUE', 'TRUE', 5)}) d JOIN ("
    + o.sql(
        f"SELECT event_id, {o.enriched_columns(['hour_sin', 'is_weekend', 'peer_session_deviation'])} FROM enriched",
        o.ENRICHED,
    )
    + ") e USING (event_id)",
)
def o02(spark, sf):
    """Stream joined with the fitted tables; equal to the batch features."""
    out = live.drain(live.enrich_rows(live.table_stream(spark, sf), prepared(spark, sf)))
    zs = [r(c) for c in profiles.DEVIATIONS]
    return out.select(
        "event_id", *zs, *profiles.NOVELTIES, r("hour_sin"), "is_weekend", r("peer_session_deviation")
    )


#: The watermark, in milliseconds, ends at the last row and does not pass it within its millisecond.
_RELEASED = "epoch_us(event_ts) <= (SELECT max(epoch_us(event_ts)) // 1000 * 1000 FROM access_log)"


@query(
    "o03_live_responses",
    o.sql(f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS differing, true AS some_flagged FROM access_log WHERE {_RELEASED}"),
)
def o03(spark, sf):
    """Running state, enrichment, forest, class, risk, explanation and actions per event: as for the same rows in a batch."""
    fitted = batch(spark, sf).fitted
    rows = running_state.running_stream(live.table_stream(spark, sf), fitted.context.median_gap, "0 seconds")
    seen = live.drain(rows, lambda b: live.respond_to(b, fitted))
    once = running.running_features(live.zoned(log(spark, sf)), median_gap=fitted.context.median_gap)
    batched = live.respond_to(once, fitted)
    # Sums in another order may differ in the last digit, which shows in rounded texts: those are left out.
    same = ["is_anomaly", "attack_classification", "risk_level", "recommended_actions"]
    want = batched.select("event_id", F.struct(*same).alias("want"), F.col("risk_score").alias("score"))
    unlike = (F.struct(*same) != F.col("want")) | (F.abs(F.col("score") - F.col("risk_score")) > 0.011)
    # All rows but those that still wait for the watermark.
    end = log(spark, sf).agg(F.unix_micros(F.max("event_ts").cast("timestamp"))).first()[0] // 1000 * 1000
    waiting = live.zoned(log(spark, sf)).where(F.unix_micros("event_ts") > end).select("event_id")
    joined = seen.join(want.join(waiting, "event_id", "left_anti"), "event_id", "full")
    return joined.agg(
        F.count("is_anomaly").alias("n"),
        F.count_if(F.coalesce(unlike, F.lit(True))).alias("differing"),
        F.bool_or("is_anomaly").alias("some_flagged"),
    )


_STATE = [c.split()[0] for c in running_state.NEW_COLUMNS.split(", ")]


_ENTROPY = (
    "entropy AS (SELECT event_id, -sum(n / total * log2(n / total)) AS resource_access_entropy_to_date FROM ("
    "SELECT event_id, CAST(n AS DOUBLE) AS n, CAST(sum(n) OVER (PARTITION BY event_id) AS DOUBLE) AS total FROM ("
    "SELECT a.event_id, b.resource_accessed, count(*) AS n FROM access_log a JOIN access_log b "
    "ON a.entity_id = b.entity_id AND b.event_ts <= a.event_ts GROUP BY a.event_id, b.resource_accessed)) GROUP BY event_id)"
)
_OLD = [c for c in _STATE if c != "resource_access_entropy_to_date"]
_STATE_SQL = (
    f"SELECT event_id, {o.enriched_columns(_OLD)}, {o.rdas('resource_access_entropy_to_date')} "
    "FROM running JOIN entropy USING (event_id)"
)


def _rounded(out):
    digits = {**o.ENRICHED_COLUMNS, "resource_access_entropy_to_date": 6}
    return out.select("event_id", *[F.col(c) if digits[c] is None else r(c, digits[c]) for c in _STATE])


@query("o04_running_state", o.sql(f"{_STATE_SQL} WHERE {_RELEASED}", o.RUNNING, _ENTROPY))
def o04(spark, sf):
    """Running features and entropy from per-entity stream state; equal to the batch windows."""
    gap = prepared(spark, sf).context.median_gap
    return _rounded(live.drain(running_state.running_stream(live.table_stream(spark, sf), gap, "0 seconds")))


_PASSED = "epoch_us(event_ts) <= (SELECT (max(epoch_us(event_ts)) // 1000 - 43200000) * 1000 FROM access_log)"


@query("o04_disordered", o.sql(f"{_STATE_SQL} WHERE {_PASSED}", o.RUNNING, _ENTROPY))
def o04_disordered(spark, sf):
    """Rows up to half a day late, in five triggers: released in event order once the watermark has passed them."""
    gap = prepared(spark, sf).context.median_gap
    rows = live.zoned(log(spark, sf))
    late = F.unix_micros("event_ts") + F.pmod(F.xxhash64("event_id"), F.lit(43_200_000_000))
    start, stop = rows.agg(F.unix_micros(F.min("event_ts")), F.unix_micros(F.max("event_ts"))).first()
    step = (stop + 43_200_000_000 - start) // 5 + 1
    path = fresh_path(spark, "disordered")
    for k in range(5):
        part = rows.where((late >= start + k * step) & (late < start + (k + 1) * step))
        part.orderBy(F.xxhash64("event_id", F.lit(k))).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return _rounded(live.drain(running_state.running_stream(stream, gap, "12 hours")))


@query("o05_deduplicated", o.sql("SELECT event_id, entity_id FROM access_log"))
def o05(spark, sf):
    """Every event delivered twice, kept once."""
    path = fresh_path(spark, "twice")
    rows = live.zoned(log(spark, sf))
    for _ in range(2):
        rows.write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    return live.drain(live.deduplicated(stream)).select("event_id", "entity_id")


_HOURS = (
    "SELECT epoch_us(date_trunc('hour', event_ts)) AS hour_us, count(*) AS events, "
    "count(*) FILTER (WHERE label = 'Anomaly') AS anomalies FROM access_log GROUP BY 1"
)


@query("o06_hourly_anomalies", o.sql(_HOURS))
def o06(spark, sf):
    """Tumbling hours, complete mode."""
    stream = live.hourly_anomalies(live.table_stream(spark, sf))
    out = live.drain(stream, mode="complete")
    return out.select(F.unix_micros("hour_start").alias("hour_us"), "events", "anomalies")


@query(
    "o06_closed_hours",
    o.sql(
        f"SELECT * FROM ({_HOURS}) WHERE hour_us + 3600000000 <= "
        "(SELECT max(epoch_us(event_ts)) - 3600000000 FROM access_log)"
    ),
)
def o06_closed(spark, sf):
    """Append mode: only the hours the watermark has passed are emitted."""
    out = live.drain(live.hourly_anomalies(live.table_stream(spark, sf)))
    return out.select(F.unix_micros("hour_start").alias("hour_us"), "events", "anomalies")
