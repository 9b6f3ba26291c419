import numpy as np
import pytest
from conftest import SF_SMALL

import __spark_entry__ as registry
from spendlight.operators import forecast


def test_model_recovers_a_known_plane(spark):
    rng = np.random.default_rng(7)
    rows = [(float(s), int(i), int(c), float(5 + 2 * s + 0.5 * i - 3 * c)) for s, i, c in rng.integers(1, 100, (60, 3))]
    months = spark.createDataFrame(rows, "spend_usd double, impressions bigint, clicks bigint, revenue_usd double")
    model = forecast.fit_revenue_model(months)
    assert list(model.coefficients) == pytest.approx([2, 0.5, -3], abs=1e-6)
    assert model.intercept == pytest.approx(5, abs=1e-5)
    new = spark.createDataFrame([(10.0, 20, 3, 0.0)], months.schema)
    assert forecast.predict_revenue(model, new).first().predicted_revenue_usd == pytest.approx(26, abs=1e-5)


def test_predictions_match_least_squares(spark):
    rows = registry.queries()["revenue_regression_ml"](spark, SF_SMALL).toPandas()
    x = np.column_stack([rows[forecast.FEATURES].to_numpy(float), np.ones(len(rows))])
    beta, *_ = np.linalg.lstsq(x, rows.revenue_usd.to_numpy(float), rcond=None)
    np.testing.assert_allclose(rows.predicted_revenue_usd, x @ beta, rtol=1e-4, atol=1.0)
