"""Profiles with cold starts, encoders with unseen values."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import TINY
from watchfold.functions import scalars as sc
from watchfold.operators import encoding, enrich, profiles
from watchfold.plans import registry


def test_cold_start_borrows_the_department(events):
    rows = [{"entity_id": "old", "session_duration_min": float(i)} for i in range(6)]
    rows += [{"entity_id": "new", "session_duration_min": 100.0, "device_fingerprint": "f9"} for _ in range(4)]
    rows += [{"entity_id": "lone", "department": None} for _ in range(4)]
    df = events(rows)
    prof = profiles.fit_profiles(df)
    got = {x["entity_id"]: x for x in prof.entity.collect()}
    dept = prof.department.first()
    assert not got["old"]["cold_start"] and got["old"]["event_count"] == 6
    assert got["new"]["cold_start"] and got["new"]["fallback_department"] == "d1"
    assert got["new"]["event_count"] == dept["event_count"] == 10
    assert got["new"]["session_median"] == dept["session_median"]
    assert got["lone"]["cold_start"] and got["lone"]["fallback_department"] is None
    assert got["lone"]["event_count"] == 4
    # the borrowed sets count: a device of a colleague is not new
    later = events([{"entity_id": "new", "device_fingerprint": "f1"}, {"entity_id": "new", "device_fingerprint": "f7"},
                    {"entity_id": "stranger"}, {"entity_id": "old", "geo_location": None}])
    flags = {x["event_id"]: x for x in profiles.apply_profiles(later, prof).collect()}
    assert flags[0]["profile_new_device"] == 0 and flags[1]["profile_new_device"] == 1
    assert flags[2]["profile_new_geo"] == 0 and flags[2]["profile_session_deviation"] == 0.0
    assert flags[3]["profile_new_geo"] == 1


def test_one_profile_per_entity_and_ties_to_the_smallest(events):
    df = events([{"geo_location": g, "login_hour": h} for g, h in (("b", 10), ("a", 9), ("a", 10), ("b", 9), ("c", 3))])
    prof = profiles.fit_profiles(df).entity.collect()
    assert len(prof) == 1
    assert prof[0]["geo_location_mode"] == "a" and prof[0]["login_hour_mode"] == 9 and prof[0]["n_geo_locations"] == 3


def test_flags_are_zero_on_the_fitted_rows(log):
    out = profiles.apply_profiles(log, profiles.fit_profiles(log))
    assert out.count() == 1000
    assert out.agg(*[F.sum(c) for c in profiles.NOVELTIES]).first() == (0, 0, 0)


def test_rows_are_not_joined_with_all_known_values(log):
    """However many values the profiles know, the rows meet only those that none of them knows."""
    prof = profiles.fit_profiles(log)
    other = log.withColumn("device_fingerprint", F.when(F.col("event_id") % 100 == 7, "other").otherwise(F.col("device_fingerprint")))
    for rows, unknown in ((log, 0), (other, 10)):
        out = profiles.apply_profiles(rows, prof)
        assert not set(out.inputFiles()) & set(prof.values.inputFiles())
        assert out.agg(*[F.sum(c) for c in profiles.NOVELTIES]).first() == (0, 0, unknown)


def test_profiles_split_medians_agree(log):
    a = profiles.fit_profiles(log).entity.orderBy("entity_id").toPandas()
    b = profiles.fit_profiles(log, rows_per_slice=20).entity.orderBy("entity_id").toPandas()
    pd.testing.assert_frame_equal(a, b)


def test_finite(spark):
    rows = spark.createDataFrame([(1.5,), (float("inf"),), (float("-inf"),), (float("nan"),), (None,)], "x double")
    assert [x[0] for x in rows.select(sc.finite(F.col("x"))).collect()] == [1.5, 0.0, 0.0, 0.0, 0.0]


def test_lenient_timestamps(spark):
    rows = spark.createDataFrame([("2024-01-01 10:00:00",), ("yesterday",), (None,)], "t string")
    got = [x[0] for x in rows.select(sc.parse_ts("t")).collect()]
    assert got[0] is not None and got[1] is None and got[2] is None


def _profiled(events, rows):
    df = enrich.enrich(events(rows))
    return profiles.apply_profiles(df, profiles.fit_profiles(df))


def test_matrix_rules(events):
    rows = [{"browser": b, "os": o, "new_device": nd} for b, o, nd in
            (("Edge", "A", True), (None, "B", False), ("Chrome", None, False))]
    df = _profiled(events, rows)
    enc = encoding.fit_encoder(df)
    m = {x["event_id"]: x.asDict() for x in encoding.apply_encoder(df, enc).collect()}
    assert "browser_Chrome" not in m[0] and m[0]["browser_Edge"] == 1.0 and m[1]["browser_Not_Applicable"] == 1.0
    assert "os_A" not in m[0] and m[1]["os_B"] == 1.0 and m[2]["os_B"] == 0.0
    assert m[0]["new_device"] == 1.0 and m[1]["new_device"] == 0.0
    assert m[0]["bytes_downloaded"] == 0.0  # constant column: spread 0 counts as 1
    # unseen values later
    late = df.withColumns({"privilege_level": F.lit("Root"), "login_status": F.lit("Locked"), "os": F.lit("Z")})
    x = encoding.apply_encoder(late, enc).first().asDict()
    assert x["privilege_level"] == -1.0 and x["login_status"] == -1.0 and x["os_B"] == 0.0
    assert all(v is not None and np.isfinite(v) for k, v in x.items() if k not in ("entity_id", "label", "anomaly_type"))


def test_sparse_dummies_agree_with_columns(log):
    df = encoding.prepare(log)
    enc = encoding.Encoder(encoding.fit_codes(df), None)
    cats = enc.categories()
    cols = {n: x for c in encoding.cfg.ONEHOT_COLUMNS for n, x in encoding.dummies(c, cats[c]).items()}
    dense = df.select(sum((x for x in cols.values()), F.lit(0)).alias("n")).agg(F.sum("n")).first()[0]
    assert encoding.sparse_dummies(log, enc).count() == dense


def test_align_orders_and_fills(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "event_id long, b double, a double")
    out = encoding.align(df, ["a", "zz", "b"])
    assert out.columns == ["event_id", "a", "zz", "b"] and out.first()[1:] == (0.0, 0.0, 2.0)


def test_encoder_round_trip(events, tmp_path, spark):
    df = _profiled(events, [{"browser": "Edge"}, {"browser": "Chrome"}])
    enc = encoding.fit_encoder(df)
    enc.save(str(tmp_path / "enc"))
    back = encoding.Encoder.load(spark, str(tmp_path / "enc"))
    assert back.categories() == enc.categories() and back.scales() == enc.scales()


def test_features_are_made_by_compiled_expressions(events):
    rows = events([{"browser": None}, {"browser": "Edge"}, {"browser": "Chrome", "failed_attempts": 3}])
    made = encoding.encode_beside(rows, encoding.fit_encoder(rows))
    assert "lambda" not in made._jdf.queryExecution().optimizedPlan().toString()
    for r in made.collect():
        assert r["features"]["at"] == sorted(r["features"]["at"]) and 0.0 not in r["features"]["x"]


def test_deviations_do_not_store_the_enriched_rows(spark, monkeypatch):
    """Made on the way they are those of stored enriched rows, and no wide table is written for them."""
    monkeypatch.setattr(registry, "_shared", {})
    new = ["event_id", *profiles.DEVIATIONS, *profiles.NOVELTIES]
    got = registry.deviations(spark, TINY).select(*new)
    names = {name for _, _, name in registry._shared}
    assert names == {"log", "profiles"}
    fitted = registry.fitted_profiles(spark, TINY)
    want = profiles.apply_profiles(registry.enriched(spark, TINY), fitted).select(*new)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
