"""Daily counts with state: late and repeated events, any batching, a state that does not grow."""

import random
from datetime import datetime, timedelta

import pytest

from evidex.streaming.daily import read_files_as_stream
from evidex.streaming.windows import count_stream, daily_totals

EVENT = "event_id bigint, ts timestamp, kind string"
START = datetime(2024, 1, 1, 0, 0, 0)


def write(spark, folder, rows):
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(folder)


def events(days, per_day=12):
    return [(d * 1000 + i, START + timedelta(days=d, hours=2 * i, microseconds=i), "ab"[i % 2]) for d in days for i in range(per_day)]


def wanted(rows):
    once = {r[0]: r for r in rows if r[0] is not None}
    out = {}
    for _, ts, kind in once.values():
        key = (kind, ts.date() if ts else None)
        out[key] = out.get(key, 0.0) + 1.0
    return out


def totals(spark, folder):
    return {(r.kpi_id, r.ts): r.value for r in daily_totals(spark, folder).collect()}


@pytest.mark.parametrize("per_batch", [1, 64])
def test_order_and_batching_do_not_matter(spark, tmp_path, per_batch):
    rows = events(range(6))
    files = [events([d]) for d in range(6)]
    random.Random(per_batch).shuffle(files)
    # Every file brings old events again, some of them long closed, and rows without a key or a time.
    for n, file in enumerate(files):
        file += [rows[n * 7], rows[-1 - n], file[0], (None, START, "a")]
    files[2].append((77, None, "a"))
    for file in files:
        write(spark, str(tmp_path / "in"), file)
    stream = read_files_as_stream(spark, str(tmp_path / "in"), "*.parquet", per_batch)
    count_stream(stream, str(tmp_path / "out"), "ts", "kind", "event_id", "1 day")
    assert totals(spark, str(tmp_path / "out")) == wanted(rows + [(77, None, "a")])


def test_later_runs_add_what_is_new_and_forget_what_is_closed(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows, held = [], []
    for day in range(5):
        fresh = events([day], 40)
        fresh = [(i, ts - timedelta(hours=i % 1000), kind) for i, ts, kind in fresh]
        rows += fresh
        # Events of the first day that come late, some for the first time, some again.
        late = [(9000 + day, START + timedelta(hours=day), "b"), rows[0]]
        rows += late
        write(spark, folder, fresh + late)
        query = count_stream(read_files_as_stream(spark, folder, "*.parquet"), out, "ts", "kind", "event_id", "6 hours")
        held.append(sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"]))
        assert totals(spark, out) == wanted(rows)
    # Keys are forgotten: the state does not grow with the days.
    assert held[-1] <= held[1] + 5 and held[-1] < len(rows) / 2


def test_a_run_without_new_events_changes_nothing(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, folder, events([0, 1]))
    for _ in range(2):
        count_stream(read_files_as_stream(spark, folder, "*.parquet"), out, "ts", "kind", "event_id")
    assert totals(spark, out) == wanted(events([0, 1]))
