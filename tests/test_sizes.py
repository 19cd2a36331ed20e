"""Registered queries fit their models at the declared sizes."""

from types import SimpleNamespace

from watchfold import settings as cfg
from watchfold.operators import classify as cl
from watchfold.plans import q_models, registry


def test_registered_models_have_the_declared_sizes(monkeypatch):
    full = cl.Effort(cfg.RANDOM_FOREST["trees"], cfg.RANDOM_FOREST["depth"], cfg.BOOSTED["rounds"], None)
    seen = []
    monkeypatch.setattr(registry, "log", lambda *a: None)
    monkeypatch.setattr(registry, "run_batch", lambda rows, effort=cl.Effort(): seen.append(effort))
    monkeypatch.setattr(q_models, "_attacks", lambda *a: None)
    monkeypatch.setattr(cl, "compare_models", lambda rows, effort=cl.Effort(), folds=cfg.CV_FOLDS: seen.append((effort, folds)))
    session = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="sizes"))
    registry.batch(session, "nowhere")
    q_models._comparison(session, "nowhere")
    assert seen == [full, (full, 5)]


def test_queries_without_a_classifier_fit_none(spark, monkeypatch):
    """The matrix, the forest and the stream state come from the half of the batch job that needs no classifier."""
    from watchfold.plans import q_sources, q_stream

    monkeypatch.setattr(registry, "run_batch", None)
    monkeypatch.setattr(registry, "_shared", {})
    folder = "/root/testdata/sf0.001"
    assert q_sources.a05(spark, folder).agg({"events": "sum"}).first()[0] == 1000
    assert q_models.h02(spark, folder).first().asDict() == {"n": 1000, "outside": 0, "anomalies_score_higher": True}
    assert q_models.h01(spark, folder).count() == cfg.FOREST_TREES
    assert q_stream.o04(spark, folder).count() > 900


def test_the_batch_job_goes_on_from_what_is_prepared(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(registry, "_shared", {})
    monkeypatch.setattr(registry, "log", lambda *a: "log")
    monkeypatch.setattr(registry, "prepare", lambda rows: "prepared")
    monkeypatch.setattr(registry, "run_batch", lambda rows, prepared=None: seen.append(prepared) or SimpleNamespace(prepared="same"))
    registry.prepared(spark, "a")
    registry.batch(spark, "a")
    registry.batch(spark, "b")
    assert seen == ["prepared", None] and registry.prepared(spark, "b") == "same"
