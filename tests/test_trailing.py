"""Logins within a trailing hour, against comparing all logins with each other."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from wagerlens.plans import fraud

SESSIONS = "ip string, player_id string, session_timestamp timestamp"
START = datetime(2024, 1, 1)


def plain(rows, minutes):
    hour, out = timedelta(minutes=minutes), {}
    for ip, _, t in rows:
        if ip is None or t is None:
            continue
        near = [(p, u) for other, p, u in rows if other == ip and u is not None and t - hour < u <= t]
        out[ip, t] = (len(near), len({p for p, _ in near if p is not None}))
    return out


def found(spark, rows, minutes):
    df = spark.createDataFrame(rows, SESSIONS).repartition(3)
    got = {(r.ip, r.login_time): (r.logins, r.distinct_players) for r in fraud.trailing_hour(df, minutes).collect()}
    peaks = {r.ip: r for r in fraud.busiest_hours(df, minutes).collect()}
    assert set(peaks) == {ip for ip, _ in got}
    for ip, r in peaks.items():
        own = {t: v for (i, t), v in got.items() if i == ip}
        assert r.peak_logins == max(n for n, _ in own.values())
        assert r.peak_players == max(n for _, n in own.values())
        assert r.peak_logins_at == min(t for t, (n, _) in own.items() if n == r.peak_logins)
        assert r.peak_players_at == min(t for t, (_, n) in own.items() if n == r.peak_players)
    return got


@pytest.mark.parametrize("minutes", [60, 7])
def test_hot_address_ties_and_nulls(spark, minutes):
    rng = random.Random(minutes)
    rows = []
    for i in range(900):
        # One address has a third of all logins, one player of it half of those.
        ip = "10.0.0.1" if i % 3 == 0 else f"10.0.1.{rng.randint(0, 20)}"
        player = "p1" if i % 6 == 0 else rng.choice([None, "p2", "p3", f"p{rng.randint(4, 60)}"])
        seconds = rng.choice([rng.randint(0, 40_000), 60 * rng.randint(0, 300), 3600 * rng.randint(0, 9)])
        rows.append((ip, player, START + timedelta(seconds=seconds, microseconds=rng.choice([0, 0, 1]))))
    rows += [(None, "p1", START), ("10.0.0.1", "p1", None), *rows[:5]]
    assert found(spark, rows, minutes) == plain(rows, minutes)


def test_borders_of_the_hour(spark):
    at = lambda minutes: START + timedelta(minutes=minutes)
    rows = [("a", "p", at(5)), ("a", "q", at(59)), ("a", "r", at(64)), ("a", "p", at(65)), ("a", "p", at(200))]
    got = found(spark, rows, 60)
    assert got["a", at(64)] == (3, 3)  # a burst from 0:05 to 1:04, cut by every hour that starts at 0:00 or 0:10
    assert got["a", at(65)] == (3, 3)  # the login of an hour ago is out, its player is in again
    assert got["a", at(200)] == (1, 1)
    assert found(spark, [], 60) == {}
