"""Summary per service and tumbling/hopping windows, batch form."""

import datetime as dt

from loglens.operators.summary import service_success_summary
from loglens.operators.windowed import hopping_success_rate, windowed_success_rate

from .conftest import events_df


def _ev(t, code, service="s"):
    return {"service": service, "timestamp": float(t), "message": f"HTTP Status Code: {code}"}


def test_summary(spark):
    df = events_df(spark, [[_ev(10.5, 200), _ev(20, 302), _ev(30, 404), _ev(40, 500, "t")],
                           [{"service": "s", "timestamp": 5.0, "message": "no code"}]])
    rows = {r.service: r for r in service_success_summary(df, window_duration="10s").collect()}
    assert (rows["s"].total, rows["s"].successes) == (3, 2)
    assert rows["s"].window_start == dt.datetime(1970, 1, 1, 0, 0, 10, 500000)
    assert rows["t"].success_rate == 0.0


def test_tumbling_and_hopping(spark):
    df = events_df(spark, [[_ev(1, 200), _ev(9.9, 500), _ev(10, 201), _ev(25, 404)]])
    rows = [(r.window_start.second, r.total, r.successes) for r in windowed_success_rate(df).collect()]
    assert rows == [(0, 2, 1), (10, 1, 1), (20, 1, 0)]
    hop = [(r.window_start.second, r.total) for r in hopping_success_rate(df, "20 seconds", "10 seconds").collect()]
    assert hop == [(50, 2), (0, 3), (10, 2), (20, 1)] or sorted(hop) == sorted([(50, 2), (0, 3), (10, 2), (20, 1)])
