"""last_update_by_unit where the seconds' fractions decide the hour."""

import duckdb

from seqloom import plans

EVENTS = """
select * from (values
 (1, timestamp '2024-01-30 23:59:25.261702'), (2, timestamp '2024-01-30 22:59:25.9'), (3, timestamp '2024-01-30 22:59:25.261702'), (4, timestamp '2024-01-30 22:59:26'),
 (4, timestamp '2024-01-01 00:00:00'), (5, timestamp '1969-12-31 23:59:25.75'), (6, null)) e(user_id, ts)"""


def test_hours_of_fractions(spark, tmp_path):
    con = duckdb.connect()
    con.sql(f"create table events as {EVENTS}")
    con.sql(f"copy events to '{tmp_path}/events.parquet' (format parquet)")
    got = plans.QUERIES["last_update_by_unit"](spark, str(tmp_path)).select("unit", "last_update", "hours_ago").collect()
    want = con.sql(plans.ORACLES["last_update_by_unit"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(want) and (2, 1) in {(r.unit, r.hours_ago) for r in got}
