"""HTTP sources: feed polls that never raise, bundles that do, and a router's tables."""

from __future__ import annotations

import gzip
import json
import sys
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TIMEOUT_S, ROUTE_TIMEOUT_S = 8, 120


@dataclass
class Poll:
    """One fetch attempt and what came of it."""

    feed: str
    fetched_at: datetime
    received_at: datetime
    status: int | None = None
    server_date: datetime | None = None
    body: bytes = b""
    error: str | None = None

    def audit(self) -> dict:
        """The attempt as an audit row; skew is the middle of the round trip against the server's date."""
        skew = None if self.server_date is None else ((self.fetched_at + (self.received_at - self.fetched_at) / 2) - self.server_date).total_seconds()
        iso = lambda t: None if t is None else t.isoformat()
        return {"feed": self.feed, "fetched_at_utc": iso(self.fetched_at), "received_at_utc": iso(self.received_at), "rtt_s": (self.received_at - self.fetched_at).total_seconds(), "server_date_utc": iso(self.server_date), "skew_s": skew, "status_code": self.status, "body_bytes": len(self.body), "error": self.error}


def server_date(text: str | None) -> datetime | None:
    try:
        return parsedate_to_datetime(text).astimezone(UTC) if text else None
    except (TypeError, ValueError):
        return None


def fetch_feed(feed: str, url: str, headers: dict[str, str] | None = None) -> Poll:
    """Poll once; every failure is a Poll with an error."""
    began = datetime.now(UTC)
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers or {}), timeout=TIMEOUT_S) as r:
            return Poll(feed, began, datetime.now(UTC), r.status, server_date(r.headers.get("Date")), r.read())
    except urllib.error.HTTPError as e:
        return Poll(feed, began, datetime.now(UTC), e.code, server_date(e.headers.get("Date")), error=f"HTTP {e.code}")
    except Exception as e:  # noqa: BLE001 - a poll never raises
        return Poll(feed, began, datetime.now(UTC), error=f"{type(e).__name__}: {e}")


def payload(poll: Poll) -> bytes | None:
    """The compressed object to store; an empty body has none."""
    return gzip.compress(poll.body, mtime=0) if poll.body else None


#: Seconds into the minute at which each feed is polled; polls in flight at once.
OFFSETS, AT_ONCE = {"vehiclepos": (0, 10, 20, 30, 40, 50), "tripupdates": (5,)}, 2
CRASHED = "crashed"


def collect_minute(urls: dict[str, str], store: Callable[[Poll, bytes], None], audit: Callable[[list[dict]], None], offsets: dict[str, tuple[float, ...]] | None = None, headers: dict[str, str] | None = None) -> list[dict]:
    """One minute's polls of all feeds at their offsets, and their audit rows, which are written whatever happens.

    At most two polls are in flight; a body is stored outside that bound, so a
    slow store delays no poll. Where storing fails, the row's error says
    ``crashed``.
    """
    permits, rows, began = threading.Semaphore(AT_ONCE), [], time.monotonic()

    def poll(feed: str, at: float) -> dict:
        time.sleep(max(0.0, began + at - time.monotonic()))
        with permits:
            got = fetch_feed(feed, urls[feed], headers)
        row = got.audit()
        try:
            content = payload(got)
            if content is not None:
                store(got, content)
        except Exception:  # noqa: BLE001 - the attempt is audited all the same
            row["error"] = CRASHED
        return row

    due = sorted((at, feed) for feed, own in (offsets or OFFSETS).items() if feed in urls for at in own)
    try:
        with ThreadPoolExecutor(max(1, len(due))) as pool:
            rows = list(pool.map(lambda x: poll(x[1], x[0]), due))
    finally:
        audit(rows)
    return rows


def fetch_bundle(url: str, headers: dict[str, str] | None = None) -> bytes:
    """The bundle; anything but success raises."""
    with urllib.request.urlopen(urllib.request.Request(url, headers=headers or {}), timeout=ROUTE_TIMEOUT_S) as r:
        if r.status != 200:
            raise OSError(f"HTTP {r.status} from {url}")
        return r.read()


def route_tables(origins: DataFrame, base: str) -> DataFrame:
    """(stop_id, mesh_block_codes, body): one table request for each origin.

    ``origins``: stop_id, stop_lon, stop_lat, mesh_block_codes, lons and lats,
    the last three in the same order. A refused request has a body that says so.
    """

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            bodies = []
            for r in frame.itertuples():
                places = ";".join(f"{x:.6f},{y:.6f}" for x, y in [(r.stop_lon, r.stop_lat), *zip(r.lons, r.lats, strict=True)])
                many = ";".join(map(str, range(1, len(r.lons) + 1)))
                try:
                    with urllib.request.urlopen(f"{base}/table/v1/foot/{places}?sources=0&destinations={many}&annotations=distance,duration", timeout=ROUTE_TIMEOUT_S) as answer:
                        bodies.append(answer.read().decode())
                except Exception as e:  # noqa: BLE001 - left for the next run
                    bodies.append(json.dumps({"code": type(e).__name__}))
            yield pd.DataFrame({"stop_id": frame["stop_id"], "mesh_block_codes": frame["mesh_block_codes"], "body": bodies})

    return origins.mapInPandas(ask, "stop_id string, mesh_block_codes array<string>, body string")
