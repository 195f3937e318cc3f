import json

import numpy as np
import pytest

from eocube.operators import items as ops
from eocube.streaming import near_dup

SCHEMA = "id long, place string, event_time timestamp, updated string"


def row(i, place, minute, updated):
    return {"id": i, "place": place, "event_time": None if minute is None else f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00", "updated": updated}


@pytest.fixture
def feed(spark, tmp_path):
    """Rows of one micro-batch after the other; all that has come out by then."""
    (tmp_path / "in").mkdir()

    def run(*batches, **how):
        for rows in batches:
            n = len(list((tmp_path / "in").iterdir()))
            (tmp_path / "in" / f"{n}.json").write_text("\n".join(map(json.dumps, rows)))
            stream = spark.readStream.schema(SCHEMA).json(str(tmp_path / "in"))
            out = near_dup.near_duplicates(stream, ["place"], **how)
            out.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"), format="parquet").awaitTermination()
        return spark.read.parquet(str(tmp_path / "out")).collect()

    return run


def test_late_repeated_and_empty_values(feed):
    first = [row(1, "a", 0, "1"), row(2, "a", 40, "2"), row(2, "a", 40, "2"), row(3, "a", 61, None), row(4, None, 5, None), row(5, "a", None, "9")]
    second = [row(6, "a", 20, "2"), row(7, "b", 300, "1")]  # within the lateness; then time goes on
    third = [row(8, "a", 30, "9"), row(9, "b", 330, "0"), row(10, "c", 1400, "1")]  # too late for its group
    got = feed(first, second, third, minutes=60, late="120 minutes")
    assert sorted((r.id, r.group_start.minute + 60 * r.group_start.hour) for r in got) == [(2, 0), (2, 0), (3, 61), (4, 5), (6, 0), (7, 300)]
    assert {r.id: r.event_time.minute for r in got}[6] == 20


def test_as_the_table(spark, feed):
    """Out of order within the lateness, over four batches."""
    rng = np.random.default_rng(8)
    rows = [row(i, f"p{rng.integers(6)}", int(rng.integers(0, 900)), str(rng.integers(4))) for i in range(400)]
    rows.sort(key=lambda r: (int(r["event_time"][11:13]) * 60 + int(r["event_time"][14:16])) + float(rng.uniform(0, 60)))
    got = feed(*(rows[k : k + 100] for k in range(0, 400, 100)), [row(-1, "end", 1439, "0")], late="60 minutes")
    table = spark.createDataFrame([(r["id"], r["place"], r["event_time"], r["updated"]) for r in rows], "id long, place string, event_time string, updated string").selectExpr("id", "place", "cast(event_time as timestamp) event_time", "updated")
    want = ops.near_duplicates(table, ["place"], time="event_time").collect()
    assert sorted((r.id, r.group_start) for r in got) == sorted((r.id, r.group_start) for r in want)


def test_groups_end_only_when_time_has_passed():
    rows = [{"_t": t, "_u": u} for t, u in ((5, 1), (0, 2), (10, 2), (11, None), (30, 1))]
    out, rest = near_dup.close_groups(rows, 10, 20)
    assert [(f, r["_t"]) for f, r in out] == [(0, 0), (0, 10)] and [r["_t"] for r in rest] == [11, 30]
    out, rest = near_dup.close_groups(rest, 10, 40)
    assert [(f, r["_t"], r["_u"]) for f, r in out] == [(11, 11, None), (30, 30, 1)] and not rest
