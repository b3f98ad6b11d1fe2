from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

from aerofuse.streaming import closing, ingest
from tests.test_streaming import SCHEMA, START, arrive


def test_each_closed_day_once_and_late_rows_beside(spark, tmp_path):
    folder, draw, given = str(tmp_path / "in"), random.Random(3), []
    for k, day in enumerate((0, 3, 1, 9, 2, 8, 30, 5)):  # some batches come long after others
        rows = [(draw.choice(["s", "t", None]), "pm25", START + timedelta(days=day, hours=draw.randint(0, 40)), draw.choice([1.0, 2.5, None]))
                for _ in range(25)]
        rows += [("s", "pm25", None, 7.0)] if k == 2 else []
        arrive(spark, folder, f"f{k}", rows)
        given.append(rows)
        stream = ingest.read_arrivals(spark, f"{folder}/*", SCHEMA, files_per_batch=1)
        closing.close_days(stream, f"{tmp_path}/out", f"{tmp_path}/state", "value", "12 hours").awaitTermination()
    late = [(r["station"], r["time"], r["value"]) for r in closing.late_rows(spark, f"{tmp_path}/out").collect()]
    closed = {(r["station"], r["start"]): (r["mean"], r["n"]) for r in closing.closed_days(spark, f"{tmp_path}/out").collect()}
    assert closing.closed_days(spark, f"{tmp_path}/out").count() == len(closed)
    # By hand: the watermark trails the newest time of the batches before.
    mark, expected_late, sums, done = datetime.min, [], defaultdict(list), set()
    for rows in given:
        for station, _, time, value in rows:
            end = time and datetime(time.year, time.month, time.day) + timedelta(days=1)
            if time is None or end <= mark:
                expected_late.append((station, time, value))
            else:
                sums[(station, end - timedelta(days=1))].append(value)
        mark = max([mark, *(r[2] - timedelta(hours=12) for r in rows if r[2])])
        done |= {k for k in sums if k[1] + timedelta(days=1) <= mark}
    assert Counter(map(str, late)) == Counter(map(str, expected_late)) and len(late) > 50
    assert set(closed) == done and len(done) > 5
    for k, (mean, n) in closed.items():
        values = [v for v in sums[k] if v is not None]
        assert n == len(values) and (mean is None if not values else abs(mean - sum(values) / n) < 1e-9)
