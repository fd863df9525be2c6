"""The health report of a day: what was collected and what was curated, as one record and as text."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from punctual.functions.timeline import hours_in_day
from punctual.plans import checks, merge
from punctual.session import ensure
from punctual.sources import files

#: The record's shape; a reader that knows another one is told so.
VERSION = 1
AUDIT = "feed string, fetched_at_utc string, received_at_utc string, rtt_s double, server_date_utc string, skew_s double, status_code int, body_bytes bigint, error string"
RUN = "job string, partition string, started_at_utc string, finished_at_utc string, " + ", ".join(f"{c} bigint" for c in checks.SUMMED) + ", peak_rss_mb bigint, error string"
CHECK = "checked_at_utc string, zip_sha256 string, zip_filename string, changed boolean, valid_from string"


def collection(rows: DataFrame) -> dict:
    """What the polls of a day came to, from its typed audit rows."""
    one = lambda df: df.first().asDict()
    window = one(checks.collection_window(rows))
    counts, failures = checks.failure_summary(rows)
    gaps = checks.coverage_gaps(rows)
    return {
        "start": window["start"],
        "end": window["end"],
        "minutes": window["minutes"] or 1440,
        "feeds": {r.feed: {"expected": r.expected, "actual": r.actual} for r in checks.feed_counts(rows).collect()},
        "status": {f"{r.feed} {r.status}": r.n for r in checks.status_counts(rows).collect()},
        "failures": {r.category: r.n for r in counts.collect() if r.category != "ok"},
        "examples": [r.asDict() for r in failures.collect()],
        "timing": one(checks.timing_stats(rows)),
        "payload": {r.feed: {"minimum": r.minimum, "median": r.median, "maximum": r.maximum} for r in checks.payload_stats(rows).collect()},
        "short_minutes": gaps.count(),
        "worst_minutes": {r.minute: r["count"] for r in checks.worst_gaps(gaps).collect()},
    }


def curation(records: DataFrame, day: date, found: DataFrame) -> dict:
    """What the jobs of a day came to."""
    parts = checks.summarize_curation(records, day, found)
    return {name: part if isinstance(part, int) else part.first().asDict() for name, part in parts.items()}


def health(spark: SparkSession, root: str, day: date) -> dict:
    """The record of a local day, from the merged audit rows if they were written, or else the live ones."""
    ensure(spark)
    days = [date.fromordinal(day.toordinal() - 1), day]  # a local day meets two UTC days
    live = merge.collector_run(files.read_audit(spark, f"{root}/collector_run", days, AUDIT), day)
    rows = files.read_day(spark, f"{root}/fact_collector_run/collection_date={day.isoformat()}", live)
    after = [*days, date.fromordinal(day.toordinal() + 1)]
    records = files.read_audit(spark, f"{root}/curation_run", after, RUN)
    found = files.read_audit(spark, f"{root}/schedule_check", [day], CHECK)
    return {"version": VERSION, "day": day.isoformat(), "hours": hours_in_day(day), "collection": collection(rows), "curation": curation(records, day, found)}


def _share(actual: int, expected: int) -> str:
    return f"{actual} of {expected}" + (f" ({100 * actual / expected:.1f} %)" if expected else "")


def render(record: dict) -> str:
    """The record as text for people."""
    if record.get("version") != VERSION:
        return f"unknown report version {record.get('version')}: read with care\n{record}"
    c, jobs = record["collection"], record["curation"]
    lines = [f"{record['day']}, {record['hours']} hours", f"collected {c['start']} to {c['end']}, {c['minutes']} minutes"]
    lines += [f"  {feed}: {_share(x['actual'], x['expected'])} polls" for feed, x in sorted(c["feeds"].items())]
    lines += [f"  {n} {what}" for what, n in sorted(c["failures"].items())] or ["  no failures"]
    lines += [f"  e.g. {x['fetched_at_utc']} {x['feed']}: {x['error'] or x['status_code']}" for x in c["examples"]]
    t = c["timing"]
    lines += [f"  {name}: {t[f'{x}_min']} / {t[f'{x}_median']} / {t[f'{x}_max']} s" for name, x in (("round trip", "rtt_s"), ("skew", "skew_s"))]
    lines += [f"  {feed}: {x['minimum']} / {x['median']} / {x['maximum']} bytes" for feed, x in sorted(c["payload"].items())]
    lines += [f"  {c['short_minutes']} minutes short" + (f", worst {', '.join(f'{m} ({n})' for m, n in c['worst_minutes'].items())}" if c["worst_minutes"] else "")]
    for job in ("compactor", "merger"):
        x = jobs[job]
        lines.append(f"{job}: {_share(x['runs_seen'], x['runs_expected'])} partitions, {x['errors']} errors, {x['rows_out']} rows, {x['peak_rss_mb']} MB")
        lines += [f"  missing {p}" for p in x["missing_partitions"]]
    s = jobs["schedule"]
    return "\n".join([*lines, f"timetable: {_share(s['checks_seen'], s['checks_expected'])} checks, {'changed' if s['changed'] else 'unchanged'}"])
