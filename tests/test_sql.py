"""Functions in SQL text against the DataFrame forms."""

import math

import numpy as np
import pytest

from sonomere.functions import sql
from sonomere.functions.spectral import Windowing


@pytest.fixture(scope="module")
def samples(spark):
    sql.register(spark)
    rng = np.random.default_rng(1)
    rows = [(c, i, float(v)) for c, n in (("a", 2000), ("b", 31), ("c", 7)) for i, v in enumerate(rng.normal(size=n))]
    np.random.default_rng(2).shuffle(rows)
    df = spark.createDataFrame([(c, int(i), float(v)) for c, i, v in rows], "c string, frame bigint, x double")
    df.createOrReplaceTempView("samples")
    ordered = {}
    for c, i, v in sorted((c, int(i), float(v)) for c, i, v in rows):
        ordered.setdefault(c, []).append(v)
    return {c: np.array(v) for c, v in ordered.items()}


def test_spectrogram(spark, samples):
    found = spark.sql("SELECT * FROM spectrogram(TABLE(samples), keys => 'c', size => 16, overlap => 5, nfft => 20, fs => 8.0D)")
    assert found.columns == ["c", "window_idx", "k", "p"] and dict(found.dtypes)["c"] == "string"
    windowing = Windowing(16, 5, 20, 8.0)
    rows = {(r.c, r.window_idx, r.k): r.p for r in found.collect()}
    wanted = {
        (c, w, k): p for c, x in samples.items() if len(x) >= 16
        for w, spectrum in enumerate(windowing.periodograms(x[None])[0]) for k, p in enumerate(spectrum)
    }
    assert rows.keys() == wanted.keys()
    assert np.allclose([rows[k] for k in wanted], list(wanted.values()), rtol=1e-12)


def test_segment_in_a_query(spark, samples):
    found = spark.sql("""SELECT c, count(*) AS n, sum(aggregate(samples, 0D, (a, v) -> a + v)) AS total
        FROM segment(TABLE(SELECT c, frame AS at, x * 2 AS y FROM samples), 'c', 10, 0, ordered => 'at', value => 'y')
        GROUP BY c""").collect()
    assert {r.c: r.n for r in found} == {"a": 200, "b": 3}
    assert all(math.isclose(r.total, 2 * samples[r.c][: 10 * r.n].sum()) for r in found)


@pytest.mark.parametrize("call, error", [
    ("segment(TABLE(samples), keys => 'nope', size => 4, overlap => 0)", "no column nope"),
    ("segment(TABLE(samples), keys => 'c', size => 4, overlap => 4)", "Incorrect overlap"),
    ("segment(TABLE(samples), keys => 'c', size => 'x', overlap => 0)", "constant whole number"),
    ("spectrogram(TABLE(samples), keys => 'c', size => 9, overlap => 0, nfft => 8, fs => 1D)", "for FFT"),
])
def test_wrong_calls_fail_when_they_are_analysed(spark, samples, call, error):
    with pytest.raises(Exception, match=error):
        spark.sql(f"SELECT * FROM {call}")


def test_scalars(spark, samples):
    row = spark.sql("""SELECT to_db(100D) a, to_db(0D) b, to_db(-1D) c, to_db(NULL) d, from_db(20D) e,
        calibrated(1D, -20D) f, bin_frequency(3, 64, 128D) g, third_octave(1000D) h, third_octave(0D) i""").first()
    assert row.a == 20 and row.b == -math.inf and math.isnan(row.c) and row.d is None
    assert (row.e, row.f, row.g, row.h, row.i) == (100, 10, 6, 30, None)
    plan = spark.sql("SELECT to_db(x) FROM samples")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
