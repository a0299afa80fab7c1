"""The registered queries on the smallest tables, against their SQL."""

import os

import pytest

import __spark_entry__ as contract
from checks.compare import database, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generated tables")


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "operaciones" in df.columns


def test_every_statement_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", [
    "zone_price_by_city_type", "dedup_keep_last", "clean_chain", "nearest_centroid", "star_extract",
    "zones_lloyd_2iter", "keyed_upsert", "zone_hull", "road_rule_match", "impute_clamp"])
def test_query_equals_its_sql(spark, name):
    want = database(FOLDER).execute(contract.oracle_sql()[name]).df()
    got = contract.queries()[name](spark, FOLDER).toPandas()
    assert difference(got, want) is None


def test_cleaning_outputs_read_one_written_frame(spark):
    from checks.queries import _cleaned
    cleaned = _cleaned(spark, FOLDER)
    for out in (cleaned.kept, cleaned.rejects):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Aggregate" not in plan and "Join" not in plan
    assert sum(r["filas"] for r in cleaned.counters.collect()) == cleaned.checked.count()
