"""Versions and manifests: merges into buckets, cascades, broken jobs, the extract in parts."""

import os

import pytest
from pyspark.sql import functions as F

from zonalis.config import City, Deal
from zonalis.operators import model, upsert
from zonalis.operators.trees import Forest
from zonalis.plans import etl, extract, zone_setup
from zonalis.sources import versions
from tests.conftest import rows

DDL = ("id_propiedad string, ciudad string, cluster_zona int, precio_venta double, status string, "
       "fecha_carga timestamp_ntz, fecha_actualizacion timestamp_ntz")


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "analytics")
    data = [(str(i), "A" if i % 2 else "B", i % 4, float(i), "x") for i in range(2000)]
    df = spark.createDataFrame(data, DDL.split(", fecha_carga")[0]).withColumns(
        {c: F.lit("2020-01-01").cast("timestamp_ntz") for c in ("fecha_carga", "fecha_actualizacion")})
    versions.write_buckets(df, path, "id_propiedad", 64)
    return path


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_merge_writes_only_touched_buckets(spark, stored):
    before = {v: size(f"{stored}/data/{v}") for v in os.listdir(f"{stored}/data")}
    incoming = spark.createDataFrame([("7", "A", 2, 70.0, "y"), ("9000", "B", 1, 1.0, "y")],
                                     DDL.split(", fecha_carga")[0])
    version, touched, actions = etl.merge_into(spark, stored, incoming, "2024-01-01")
    assert 1 <= len(touched) <= 2 and {r["accion"] for r in actions.collect()} == {"actualizado", "insertado", "sin_cambio"}
    assert size(f"{stored}/data/{version}") < 0.1 * sum(before.values())
    assert all(size(f"{stored}/data/{v}") == n for v, n in before.items())
    got = {r["id_propiedad"]: r for r in versions.read(spark, stored).collect()}
    assert len(got) == 2001
    assert (got["7"]["precio_venta"], got["7"]["status"], got["7"]["ciudad"], got["7"]["fecha_carga"].year) == (70.0, "y", "A", 2020)
    assert (got["9000"]["fecha_carga"].year, got["8"]["status"]) == (2024, "x")
    assert etl.merge_into(spark, stored, incoming.limit(0), "2024-01-01")[:2] == (version, ())


def test_a_crash_before_the_switch_leaves_the_old_version(spark, stored, monkeypatch):
    incoming = spark.createDataFrame([("7", "A", 2, 70.0, "y")], DDL.split(", fecha_carga")[0])

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "publish", dies)
        with pytest.raises(RuntimeError):
            etl.merge_into(spark, stored, incoming, "2024-01-01")
    assert len(os.listdir(f"{stored}/data")) == 2
    assert versions.read(spark, stored).filter("status = 'y'").count() == 0
    # A manifest that was begun and not finished is none.
    os.makedirs(f"{stored}/manifest/version=9-late/_temporary/0")
    assert versions.read(spark, stored).count() == 2000
    etl.merge_into(spark, stored, incoming, "2024-01-02")
    assert versions.read(spark, stored).filter("status = 'y'").count() == 1


def test_old_versions_leave_with_their_files(spark, stored):
    one = spark.createDataFrame([("7", "A", 2, 70.0, "y")], DDL.split(", fecha_carga")[0])
    for day in (1, 2, 3):
        etl.merge_into(spark, stored, one.withColumn("status", F.lit(str(day))), f"2024-01-0{day}")
    want = rows(versions.read(spark, stored))
    assert len(versions.remove_old(spark, stored, keep=1)) == 3
    assert rows(versions.read(spark, stored)) == want
    assert len(os.listdir(f"{stored}/data")) == 2  # the last one, and the first one that it links


def test_cascade_rewrites_only_buckets_that_refer(spark, stored):
    def zones(data):
        return spark.createDataFrame(data, "cluster_id int, ciudad string, centroide_lat double, centroide_lng double")

    old = zones([(i, c, float(i), 0.0) for i in range(4) for c in "AB"])
    new = zones([(i, c, float(i) + (0.5 if (i, c) == (2, "B") else 0), 0.0) for i in range(3) for c in "AB"])
    changes = upsert.zone_changes(old, new)
    assert rows(changes) == [("A", 3, "eliminada"), ("B", 2, "movida"), ("B", 3, "eliminada")]
    none = zone_setup.cascade(spark, stored, changes.filter("ciudad = 'C'"))
    assert none == () and len(versions.complete_versions(spark, stored)) == 1
    # Only odd numbers are in A and only even ones in B, so zone 3 of B has no property.
    assert zone_setup.cascade(spark, stored, changes.filter("ciudad = 'B' AND cluster_id = 3")) == ()
    touched = zone_setup.cascade(spark, stored, changes)
    assert 0 < len(touched) <= 64
    got = versions.read(spark, stored)
    assert got.count() == 2000
    assert {tuple(r) for r in got.select("ciudad", "cluster_zona").distinct().collect()} == {
        ("A", 1), ("A", None), ("B", 0), ("B", None)}
    one = spark.createDataFrame([(1, "A", "movida")], "cluster_id int, ciudad string, cambio string")
    rare = versions.read(spark, stored).filter("id_propiedad = '1' OR cluster_zona IS NULL OR ciudad = 'B'")
    versions.write_buckets(rare, stored, "id_propiedad", 64)
    assert len(zone_setup.cascade(spark, stored, one)) == 1


def test_models_keep_their_version_when_a_save_is_broken(spark, tmp_path, monkeypatch):
    import numpy as np

    def one(base):
        forest = Forest(base, np.zeros((2, 3), np.int16), np.full((2, 3), np.inf), np.ones((2, 4)), np.ones(2))
        return {"Casa": model.PriceModel("Casa", ("a", "b"), "precio_venta", 60, forest)}

    path = str(tmp_path / "m")
    model.save_models(spark, one(1.0), path)
    with monkeypatch.context() as m:
        m.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            model.save_models(spark, one(2.0), path)
    back = model.load_models(spark, path)["Casa"]
    assert back.forest.base == 1.0 and back.forest.predict(np.zeros((1, 2)))[0] == 3.0
    model.save_models(spark, one(3.0), path)
    assert model.load_models(spark, path)["Casa"].forest.base == 3.0
    with pytest.raises(FileNotFoundError):
        model.load_models(spark, str(tmp_path / "none"))


def test_extract_in_parts(spark, tmp_path):
    cities = [City(c, 1, 1, (0.0, 1.0), (0.0, 1.0)) for c in "AB"]
    deals = [Deal(1, 8, "Venta", "x"), Deal(2, 7, "Alquiler", "y")]
    asked, broken = [], {("A", "Venta")}

    def read(city, deal):
        asked.append((city.name, deal.label))
        if (city.name, deal.label) in broken:
            raise OSError("no route\nto host")
        rows = spark.range(3).select(F.lit(city.name).alias("ciudad"), F.lit(deal.label).alias("t"), "id")
        # An error while rows are computed, not only when they are asked for.
        return rows.withColumn("id", F.raise_error(F.lit("bad row")).cast("long")) if (city.name, deal.label) == (
            "B", "Alquiler") and len(asked) <= 4 else rows

    path = str(tmp_path / "x")
    got = extract.extract_parts(spark, read, path, cities, deals, parallelism=1)
    assert {tuple(r) for r in got.data.select("ciudad", "t").distinct().collect()} == {("A", "Alquiler"), ("B", "Venta")}
    errors = {(r[0], r[1]): r[2] for r in got.errors.collect()}
    assert set(errors) == {("A", "Venta"), ("B", "Alquiler")} and errors["A", "Venta"] == "no route"
    broken.clear()
    asked[:] = asked[:4]
    again = extract.extract_parts(spark, read, path, cities, deals, again=True)
    assert sorted(asked[4:]) == [("A", "Venta"), ("B", "Alquiler")]
    assert again.data.count() == 12 and again.errors.count() == 0
    none = extract.extract_parts(spark, lambda c, d: 1 / 0, str(tmp_path / "y"), cities, deals)
    assert none.data is None and none.errors.count() == 4


def test_stages_leave_by_age(spark):
    import datetime as dt

    from zonalis.sources.session import staged
    old = staged(spark.range(3), "old-stage").inputFiles()[0].split("/")[-2]
    assert versions.remove_stages(spark, dt.timedelta(days=1)) == []
    fs, place = versions.file_system(spark, f"{versions.shared_folder(spark)}/stage/{old}")
    fs.setTimes(place, 1000, 1000)
    assert versions.remove_stages(spark, dt.timedelta(days=1)) == [old]
    assert old not in versions.listed(spark, f"{versions.shared_folder(spark)}/stage")


def test_parts_of_listings_join_the_tables_once(spark, monkeypatch):
    cities = [City(c, 1, 1, (0.0, 1.0), (0.0, 1.0)) for c in "AB"]
    deals = [Deal(1, 8, "Venta", "x"), Deal(2, 7, "Alquiler", "y")]
    calls = []

    def listings(tables, of, types, years):
        calls.append((len(of), len(types)))
        if len(calls) == 1:
            raise OSError("no route")
        return spark.createDataFrame([(c.name, d.label, i) for c in of for d in types for i in range(3)],
                                     "ciudad string, tipo_transaccion string, id int")

    monkeypatch.setattr(extract.crm, "extract_listings", listings)
    read = extract.listing_part({}, (2000,), cities, deals)
    with pytest.raises(OSError):
        read(cities[0], deals[0])
    for c in cities:
        for d in deals:
            assert rows(read(c, d)) == [(c.name, d.label, i) for i in range(3)]
    assert calls == [(2, 2)] * 2
    assert read(City("C", 1, 1, (0.0, 1.0), (0.0, 1.0)), deals[0]).count() == 3 and calls[-1] == (1, 1)
