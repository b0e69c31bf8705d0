import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quotelens.functions.quantiles import grouped_quantiles, quantiles

values = st.lists(st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_nan=False)),
                  min_size=1, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values)
def test_quantiles_equal_numpy_linear(spark, xs):
    df = spark.createDataFrame([(v,) for v in xs], "x double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = quantiles(df, "x", probs)
    exp = np.percentile(np.array(xs), [p * 100 for p in probs])
    assert np.allclose(got, exp, rtol=1e-12, atol=1e-9)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values, values)
def test_grouped_quantiles_per_key(spark, a, b):
    rows = [("a", v) for v in a] + [("b", v) for v in b]
    df = spark.createDataFrame(rows, "k string, x double")
    got = grouped_quantiles(df, "k", "x", [0.25, 0.75])
    for k, xs in (("a", a), ("b", b)):
        assert np.allclose(got[k], np.percentile(np.array(xs), [25, 75]), rtol=1e-12, atol=1e-9)
