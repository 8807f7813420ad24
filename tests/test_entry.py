"""Driver contract: entry runs, every query has a callable, oracle keys are queries."""

import __spark_entry__ as E
from lakehold.plans import catalog


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "avg_energy_cost_per_hour" in df.columns


def test_registered_queries_have_oracles():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 45
    # every query of the table operators has a value oracle
    assert set(catalog.QUERIES) - set(o) == set()


def test_small_queries_run(spark):
    q = E.queries()
    for name in ["scd2_apply", "nearest_region", "health_report", "column_gate", "json_array_explode"]:
        assert q[name](spark, E.SMOKE_DIR).count() > 0


def test_station_documents_keep_field_names(spark):
    import json

    from lakehold.plans import catalog

    doc = json.loads(catalog.station_documents(spark, E.SMOKE_DIR).where("raw_text like '%UUID%'").first().raw_text)
    assert {"ID", "UUID", "AddressInfo", "StatusType", "DateLastStatusUpdate"} <= set(doc)
    rows = catalog.silver_stations(spark, E.SMOKE_DIR)
    assert rows.where("station_id IS NOT NULL").count() > 100
