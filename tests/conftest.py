import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelspark.session import local_session  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="panelspark-tests")
    yield s
    s.stop()


def raw_rows(spark, rows, iso=False):
    """Raw-table DataFrame from (date, series_id, category, value, frequency[, source]) tuples."""
    from panelspark.schemas import RAW_ISO_DATES, RAW_STRING_DATES

    out = []
    for r in rows:
        date, sid, cat, value, freq = r[:5]
        source = r[5] if len(r) > 5 else "SNB"
        out.append((date, source, sid, f"{sid} name", cat, value, "percent", freq, None))
    return spark.createDataFrame(out, RAW_ISO_DATES if iso else RAW_STRING_DATES)
