import os
import sys
import tempfile

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barograph.params import SeriesSpec  # noqa: E402
from barograph.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="barograph-test-")


@pytest.fixture
def series(spark):
    """Build a long frame from {(station, sensor): values}; None is a missing value."""

    def build(values, **spec):
        frames = []
        for (station, sensor), x in values.items():
            x = np.array([np.nan if v is None else v for v in x], dtype=float)
            frames.append(
                pd.DataFrame(
                    {
                        "station": station,
                        "sensor": sensor,
                        "ts": pd.date_range("2025-01-01", periods=len(x), freq="1min"),
                        "seq": np.arange(len(x)),
                        "value": x,
                    }
                )
            )
        pdf = pd.concat(frames).sample(frac=1.0, random_state=7)
        rows = [
            (r.station, r.sensor, r.ts.to_pydatetime(), int(r.seq), None if r.value != r.value else float(r.value))
            for r in pdf.itertuples()
        ]
        schema = "station long, sensor string, ts timestamp_ntz, seq long, value double"
        return spark.createDataFrame(rows, schema), SeriesSpec(**spec)

    return build


def ordered(df, by=("station", "sensor", "pos")):
    """Rows of a frame as pandas, in series order."""
    pdf = df.toPandas()
    return pdf.sort_values([c for c in by if c in pdf.columns]).reset_index(drop=True)


def same(a, b, tolerance=1e-9):
    a, b = np.asarray(a, float), np.asarray(b, float)
    assert a.shape == b.shape
    assert (np.isnan(a) == np.isnan(b)).all()
    assert np.allclose(a, b, rtol=tolerance, atol=tolerance, equal_nan=True)
