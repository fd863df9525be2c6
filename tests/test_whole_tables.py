"""Queries against plain versions over whole tables: no users, orders or nations are left out."""

from pathlib import Path

import numpy as np
import pandas as pd
import pytest

from punctual.plans import catalogue

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


def frame(name, data=DATA):
    return pd.read_parquet(data / f"{name}.parquet")


def test_clockface_has_all_users(spark):
    rows = frame("events")
    rows["us"] = rows["ts"].astype("datetime64[us]").astype("int64")
    want = {}
    for user, own in rows.sort_values(["us", "event_id"]).groupby("user_id"):
        gaps = own["us"].diff().dropna() / 1e6
        cycle = int(gaps.median() / 60 + 0.5) if len(gaps) else 0
        if cycle > 0:
            minutes = own["us"] // 60_000_000
            offset = (minutes - minutes.iloc[0]) % cycle
            want[user] = (len(own), cycle, int(offset.combine(cycle - offset, min).max()))
    got = {r.user_id: (r.n, r.cycle, r.drift) for r in catalogue.QUERIES["q25_clockface"](spark, str(DATA)).collect()}
    assert got == want
    assert any(user % 5 for user in got)


def test_snapshots_are_of_all_orders(spark):
    orders, lines = frame("orders"), frame("lineitem")
    labels = orders.groupby(pd.to_datetime(orders["o_orderdate"]).dt.date)["o_orderkey"].max().sort_index()
    days = (pd.to_datetime(lines["l_shipdate"]) - pd.Timedelta(days=400)).dt.date.unique()
    want = {}
    for day in days:
        past = labels[labels.index <= day]
        want[day] = (int(past.iloc[-1] if len(past) else labels.iloc[0]), not len(past))
    got = {r.day: (r.label, r.label_borrowed) for r in catalogue.QUERIES["q09_as_of_snapshot"](spark, str(DATA)).collect()}
    assert got == want


def test_every_nation_is_a_centre(spark):
    data = DATA.parent / "sf0.01"  # ten suppliers are all near the first centres
    k, s = frame("nation", data)["n_nationkey"].sort_values().to_numpy()[None, :], frame("supplier", data)["s_suppkey"].to_numpy()[:, None]
    lat, lon = np.radians(-34.4 + (s % 71) * 0.011), np.radians(150.3 + (s % 53) * 0.013)
    clat, clon = np.radians(-34.5 + k * 0.05), np.radians(150.2 + k * 0.07)
    d = 2 * 6371008.8 * np.arcsin(np.sqrt(np.sin((clat - lat) / 2) ** 2 + np.cos(lat) * np.cos(clat) * np.sin((clon - lon) / 2) ** 2))
    want = {int(i): (int(k[0, j]), pytest.approx(x, abs=2e-3)) for i, j, x in zip(s[:, 0], d.argmin(axis=1), d.min(axis=1), strict=True)}
    got = {r.s_suppkey: (r.centre, r.distance_m) for r in catalogue.QUERIES["q20_nearest_centre"](spark, str(data)).collect()}
    assert got == want
    assert max(centre for centre, _ in got.values()) >= 12
