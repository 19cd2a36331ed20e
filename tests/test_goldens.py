"""Risk, response, naming and narrative goldens."""

from pyspark.sql import functions as F

from watchfold.functions import scalars as sc
from watchfold.operators import explain, respond, risk

RISK_SCHEMA = (
    "name string, resource_sensitivity string, privilege_level string, is_off_hours boolean, new_device boolean, "
    "new_location boolean, failed_attempts int, geo_velocity_kmph double, anomaly_score double, attack string"
)
RISK_ROWS = [
    ("a", "Critical", "Admin", True, True, True, 5, 600.0, 100.0, "Brute Force"),
    ("b", "Low", "User", False, False, False, 0, 10.0, 0.0, "Normal"),
    ("c", "High", "PowerUser", False, False, False, 2, 500.0, 40.0, None),
    ("d", "Medium", "Service", False, False, False, 0, 0.0, 0.0, None),
]
RISK_WANT = {
    "a": (100.0, "Critical",
          "+35 High anomaly confidence | +20 Critical resource | +10 Admin privilege | +5 Off-hours login | "
          "+10 New device | +5 New location | +10 Multiple failed attempts (5) | +5 Impossible travel (600 km/h) | "
          "+15 Suspected Brute Force attack pattern"),
    "b": (0.0, "Low", ""),
    "c": (40.0, "Medium", "+14 Moderate anomaly confidence | +15 High sensitivity resource | +7 PowerUser privilege"),
    "d": (10.0, "Low", ""),
}


def test_risk_goldens(spark):
    rows = risk.score_risk(spark.createDataFrame(RISK_ROWS, RISK_SCHEMA)).collect()
    got = {x["name"]: (round(x["risk_score"], 9), x["risk_level"], x["risk_contributors"]) for x in rows}
    assert got == RISK_WANT


def test_risk_levels_are_continuous(spark):
    rows = spark.createDataFrame([(39.0,), (39.5,), (69.0,), (69.01,), (89.0,), (89.5,)], "s double")
    got = [x[0] for x in rows.select(risk.risk_level(F.col("s"))).collect()]
    assert got == ["Low", "Medium", "Medium", "High", "High", "Critical"]


def test_weights_are_normalised():
    assert risk.weights({"a": 1, "b": 3}) == {"a": 25.0, "b": 75.0}


def test_flags_accept_text_and_numbers(spark):
    rows = spark.createDataFrame([("True",), ("false",), ("1",), (None,)], "x string")
    assert [x[0] for x in rows.select(sc.truthy(F.col("x"))).collect()] == [True, False, True, False]


RESPONSES = [
    ("Brute Force", "Low", ["Log Event"]),
    ("Normal", "Critical", ["Log Event"]),
    ("Normal", "High", ["Log Event"]),
    ("Brute Force", "Medium", ["Alert SOC Analyst", "Rate Limit IP"]),
    ("Brute Force", "Critical", ["Alert SOC Analyst", "Disable Account", "Block Origin IP"]),
    ("Lateral Movement", "Critical", ["Alert SOC Analyst", "Isolate Device", "Revoke Active Sessions"]),
    ("Unknown Attack", "High", ["Alert SOC Analyst", "Trigger MFA Challenge"]),
    ("Credential Stuffing", "Medium", ["Alert SOC Analyst"]),
    ("Brute Force", "", []),
    (None, "High", ["Log Event"]),
    ("Brute Force", "No Such Level", []),
]


def test_responses(spark):
    rows = spark.createDataFrame(
        [(i, t, lv) for i, (t, lv, _) in enumerate(RESPONSES)], "event_id long, anomaly_type string, risk_level string"
    )
    acted = respond.recommend(rows)
    got = {x["event_id"]: x["actions"] for x in acted.collect()}
    assert got == {i: a for i, (_, _, a) in enumerate(RESPONSES)}
    assert respond.work_list(acted).where("event_id = 4").orderBy("step").collect()[1]["action"] == "Disable Account"


def test_human_names(spark):
    names = ["failed_attempts", "entity_login_count", "os_Data-pipeline", "browser_Not_Applicable"]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    assert [x[0] for x in rows.select(sc.human_name(F.col("n"))).collect()] == [
        "Failed login attempt count", "Entity Login Count", "Os Data-Pipeline", "Browser Not Applicable",
    ]


def test_narrative_and_summary(spark):
    rows = spark.createDataFrame(
        [(1, [2.0, 0.5, 1.0], [0.25, -0.5, 0.0])], "event_id long, features array<double>, shap array<double>"
    )
    top = explain.top_features(rows, ["new_device", "failed_attempts", "os_X"], 3)
    got = top.select(
        explain.narrative(F.col("top_features"), F.lit("Brute Force")).alias("t"),
        explain.analyst_summary(F.col("top_features"), F.lit("Brute Force"), F.lit("High")).alias("s"),
        F.transform("top_features", lambda t: t["direction"]).alias("d"),
    ).first()
    assert got["t"] == (
        "Attack Classification: **Brute Force**\nTop Behavioral Anomalies & Risk Drivers:\n"
        "  1. **Failed login attempt count** (Value: 0.5) -> Contribution Score: -0.5000\n"
        "  2. **New Device** (Value: 2.0) -> Contribution Score: +0.2500\n"
        "  3. **Os X** (Value: 1.0) -> Contribution Score: +0.0000"
    )
    assert "anomalous **failed login attempt count**, combined with unusual **new device**" in got["s"]
    assert got["d"] == ["decreases_risk", "increases_risk", "decreases_risk"]
