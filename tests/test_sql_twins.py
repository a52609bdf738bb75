"""Queries against their SQL on rows that stand at the edge of a rule."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry

from .check_queries import rows_of


@pytest.fixture(scope="module")
def edge(tmp_path_factory):
    """128 events: IDs beyond the decoder's limits, weights 0 and 1, muons in the production plane, quotients on rounding ties."""
    folder = tmp_path_factory.mktemp("edge")
    ids = [*range(61), 13736, 26162, 29612, 33083, 796885, *range(999_995, 1_000_005), *range(4_999_995, 5_000_005)]
    ids += range(6_000_000, 6_000_000 + 128 - len(ids))
    value = {15: 0.0, 30: 1.0, 45: 0.0}
    rows = ", ".join(f"({i}, {"'error'" if i % 5 == 2 else "'view'"}, {value.get(i, 0.01 + 0.02 * (i * 37 % 4001)):.2f})" for i in ids)
    duckdb.sql(
        f"copy (select v.i::bigint as event_id, timestamp '2024-01-01' as ts, 1::bigint as user_id, v.t as event_type, v.x::double as value, '{{}}' as props "
        f"from (values {rows}) v(i, t, x)) to '{folder}/events.parquet'"
    )
    return str(folder)


@pytest.mark.parametrize("name", [
    "P21_T02_alternative_weights",
    "S05_P23_hepmc_listing",
    "S06_Q21_detector_leaves",
    "S01_S03_P22_event_text_parse",
    "Q23_composed_output",
    "P34_harmonic_coordinates",
    "J07_P24_P25_nominal_weights",
])
def test_edge_rows_agree(spark, edge, name):
    df = entry.queries()[name](spark, edge)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    con = duckdb.connect()
    con.sql(f"create view events as select * from '{edge}/events.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    assert got == rows_of([c[0] for c in cur.description], cur.fetchall())
