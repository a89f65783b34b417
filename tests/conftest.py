import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

UTC = dt.timezone.utc


@pytest.fixture(scope="session")
def spark():
    from barforge.session import build_session, checkpoint_dir
    s = build_session("local[4]", app="barforge-tests", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="barforge-test-ckpt-", dir="/tmp"))
    checkpoint_dir(s)
    yield s
    s.stop()


def ts(*a):
    return dt.datetime(*a, tzinfo=UTC)


def daily_bars(n, start=dt.datetime(2024, 1, 1, tzinfo=UTC), ticker="AAPL", cls="stocks_us", iv="1d"):
    """N consecutive days; open = low = i, high = close = adj_close = i+1, volume = 100+i."""
    rows = []
    for i in range(n):
        rows.append((cls, iv, ticker, start + dt.timedelta(days=i), float(i), float(i + 1), float(i),
                     float(i + 1), float(i + 1), 100 + i))
    return rows


BAR_DDL = ("asset_class string, interval string, ticker string, ts timestamp, open double, high double, "
           "low double, close double, adj_close double, volume bigint")
