import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__  # noqa: E402,F401  (ships the package inside task closures)
from wattgrid.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Series from a dict ``{series_id: values}`` on a regular grid."""
    import pandas as pd

    def build(series: dict, start="2024-01-01", freq="h", column="y"):
        frames = [
            pd.DataFrame({"series_id": k, "ts": pd.date_range(start, periods=len(v), freq=freq), column: v}) for k, v in series.items()
        ]
        pdf = pd.concat(frames, ignore_index=True)
        rows = [(r[0], r[1].to_pydatetime(), None if pd.isna(r[2]) else float(r[2])) for r in pdf.itertuples(index=False)]
        return spark.createDataFrame(rows, f"series_id string, ts timestamp_ntz, {column} double")

    return build
