"""Small random networks of ferries for the views: a few lines, sailings and piers, with times at and around every limit.

Nothing is expected by hand: the same rows go to the views and to their SQL.
"""

import random
from datetime import date, datetime, timedelta

WEEK = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
SCHEMAS = {
    "calendar_exclusion_seed": "start_date date, end_date date, exclusion_type string, reason string, source string",
    "dim_route_all": "route_id string, agency_id string, route_short_name string, route_long_name string, route_type string, valid_from string",
    "dim_trip_all": "trip_id string, route_id string, service_id string, direction_id string, trip_headsign string, shape_id string, valid_from string",
    "dim_calendar_all": f"service_id string, {', '.join(f'{d} string' for d in WEEK)}, start_date string, end_date string, valid_from string",
    "dim_calendar_dates_all": "service_id string, date string, exception_type string, valid_from string",
    "dim_scheduled_stop_time_all": "trip_id string, stop_id string, stop_sequence int, arrival_time string, departure_time string, timepoint string, pickup_type string, valid_from string",
    "dim_stop_all": "stop_id string, stop_lat double, stop_lon double, valid_from string",
    "fact_trip": "service_date date, trip_id string, route_id string, final_status string, canceled_polls int, first_canceled_at_utc timestamp, had_vehicle boolean",
    "fact_trip_stop": "service_date date, trip_id string, stop_sequence int, final_predicted_arrival_utc timestamp, final_predicted_departure_utc timestamp, schedule_relationship string, lost_tracking boolean, is_reliable boolean, stop_id string, last_update_at_utc timestamp",
    "stop_geography_all": "stop_id string, stop_lat double, stop_lon double, sa2_code string, sa2_name string, gccsa_name string, irsd_score double, irsd_state_decile short, distance_to_nearest_centre_m double, vintage date",
    "stop_meshblock_all": "stop_id string, mesh_block_code string, straight_line_distance_m double, network_distance_m double, routing_status string, person_count int, vintage date",
}
#: Delays, headways and tails at the limits of the rules and beside them.
DELAYS = (-21_601, -61, -60, -59, -58, 0, 30, 359, 360, 361, 21_600, 21_601)
STEPS = (5, 8, 10, 15, 20, 30, 60)
DAYS = [date(2026, 9, 16) + timedelta(days=i) for i in range(6)] + [date(2026, 10, 3), date(2026, 10, 4), date(2027, 4, 3), date(2027, 4, 4)]


def clock(s):
    return f"{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}"


def rows(seed):
    rng = random.Random(seed)
    labels = ["2026-09-18T010000Z", "2026-09-19T141500Z"]
    timed = [*labels, "2026-09-21T000000Z"]
    piers, lines = [f"pier{i}" for i in range(6)], [f"line{i}" for i in range(5)]
    out = {name: [] for name in SCHEMAS}
    out["calendar_exclusion_seed"] = [(date(2026, 9, 14), date(2026, 9, 16), "school_holiday", "a", "x"), (date(2026, 9, 18), date(2026, 9, 18), "public_holiday", "b", "x"), (date(2026, 10, 5), date(2027, 4, 30), "school_holiday", "c", "x")]
    for v in labels:
        for i, line in enumerate(lines):
            if rng.random() < 0.9:
                out["dim_route_all"].append((line, rng.choice(["1", "7083", "7084"]) if i == 4 else "1", f"{line}-{v[8:10]}", "", "712" if i == 3 else "700", v))
        for s in range(4):
            out["dim_calendar_all"].append((f"svc{s}", *(rng.choice("01") for _ in WEEK), "20260901", rng.choice(["20260919", "20270501"]), v))
            out["dim_calendar_dates_all"].append((f"svc{s}", rng.choice(DAYS).strftime("%Y%m%d"), rng.choice("12"), v))
    sailings = {}
    for k in range(24):
        line, start, step = rng.choice(lines), rng.choice([6, 8, 9, 17, 23, 25, 26]) * 3600 + rng.randrange(4) * 900, rng.choice(STEPS) * 60
        calls = [(rng.choice(piers), i + 1, start + i * step) for i in range(rng.randint(1, 4))]
        sailings[f"s{k}"] = (line, calls)
        for v in labels:
            if rng.random() < 0.85:
                out["dim_trip_all"].append((f"s{k}", line, rng.choice([f"svc{s}" for s in range(4)] + [None]), str(k % 2), "", "", v))
        for v in timed:
            if rng.random() < 0.9:
                out["dim_scheduled_stop_time_all"] += [(f"s{k}", p, n, clock(s - rng.choice([0, 0, 60]) if n > 1 else s), clock(s), rng.choice("01"), rng.choice(["0", "1", None]), v) for p, n, s in calls]
    for day in DAYS:
        for k, (line, calls) in sailings.items():
            if rng.random() < 0.3:
                continue
            midnight = datetime(day.year, day.month, day.day) - timedelta(hours=10)
            status, cut = rng.choice(["SCHEDULED", "SCHEDULED", "CANCELED", "ADDED", None]), midnight + timedelta(seconds=calls[0][2] + rng.choice([-600, 0, 601]))
            out["fact_trip"].append((day, k, line, status, rng.choice([0, 1, 9, None]), cut if status == "CANCELED" else None, rng.random() < 0.5))
            for p, n, s in calls:
                for pier in [p] * (rng.random() < 0.8) + ["elsewhere"] * (rng.random() < 0.15):
                    at = midnight + timedelta(seconds=s + rng.choice(DELAYS)) if rng.random() < 0.9 else None
                    fresh = at - timedelta(seconds=rng.choice([0, 60, 61])) if at else None
                    out["fact_trip_stop"].append((day, k, n, at if rng.random() < 0.9 else None, at, rng.choice(["SCHEDULED"] * 5 + ["SKIPPED", "NO_DATA"]), rng.random() < 0.1, rng.random() < 0.8, pier, fresh))
    for i, p in enumerate(piers):
        for v in labels:
            out["dim_stop_all"].append((p, -33.0 - i * 0.01 - (0.0003 if rng.random() < 0.3 else 0.0), 151.0 + i * 0.01, v))
        for v in (date(2026, 1, 1), date(2026, 9, 1)):
            if rng.random() < 0.8:
                out["stop_geography_all"].append((p, -33.0 - i * 0.01, 151.0 + i * 0.01, rng.choice(["a", "b", None]), "an area", "harbour", rng.choice([None, 900.0, 1000.0, 1100.5]), rng.choice([None, 1, 2, 5, 10]), 100.0 * i, v))
            for j in range(4):
                if rng.random() < 0.8:
                    out["stop_meshblock_all"].append((p, f"m{j}", rng.choice([400.0, 799.0, 800.0, 801.0]), rng.choice([None, 400.0, 401.0, 800.0, 801.0]), rng.choice(["routed", "unroutable", None]), rng.choice([0, 10, 25, None]), v))
    return out


def tables(spark, seed):
    return {name: spark.createDataFrame(own, SCHEMAS[name]) for name, own in rows(seed).items()}
