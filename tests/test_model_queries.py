"""The model queries share one forest; a refit of it takes a few jobs."""

import pytest

from isotherm.operators import modeling as ml
from isotherm.plans import q_model as qm
from isotherm.plans.q_features import feature_frame

SMALL, TINY = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


@pytest.fixture
def jobs(spark):
    def count(group, run):
        spark.sparkContext.setJobGroup(group, group)
        try:
            return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return count


def test_a_refit_of_the_forest_takes_a_few_jobs(spark, jobs):
    """Spark's estimator took 93 with the preprocessing, for three parts; the number grew with the nodes."""
    f = feature_frame(spark, SMALL)
    model, n = jobs("refit", lambda: qm.refit(spark, SMALL, "forest"))
    assert sum(p.trees for p in model.parts) == 100 and n < 45
    test = f.where(f"data_split = 'test' and {qm.TARGET} is not null")
    scored = ml.metrics(ml.predict(model, test, qm.NUMERIC), qm.TARGET).first()
    assert scored.n == test.count()


def test_scores_residuals_and_importances_are_of_one_forest(spark, monkeypatch):
    fits, fit = [], ml.fit_forest
    monkeypatch.setattr(ml, "fit_forest", lambda *a, **k: (fits.append(1), fit(*a, **k))[1])
    f = feature_frame(spark, TINY)
    scored = {r.data_split: r for r in qm.model_forest(spark, TINY).collect()}
    pred = ml.predict(qm._model(spark, TINY, "forest"), f, qm.NUMERIC)
    again = {r.data_split: r for r in ml.metrics(pred, qm.TARGET, "prediction", ["data_split"]).collect()}
    assert len(fits) == 1 and scored.keys() == again.keys() == {"train", "validation", "test"}
    assert all(abs(scored[k].rmse - again[k].rmse) < 1e-9 for k in scored)
    assert abs(sum(v for _, v in ml.importances(qm._model(spark, TINY, "forest"), qm.NUMERIC)) - 1) < 1e-9
