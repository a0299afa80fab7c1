import datetime as dt

from pyspark.sql import functions as F

from zonalis.operators import upsert as up
from zonalis.sources import sinks
from tests.conftest import rows

DDL = "id_propiedad string, ciudad string, precio_venta double, status string"


def test_merge(spark):
    target = spark.createDataFrame([("1", "A", 1.0, "x"), ("2", "A", 2.0, "x")], DDL)
    incoming = spark.createDataFrame([("2", "B", None, "y"), ("3", "B", 3.0, "y")], DDL)
    got = rows(up.merge(target, incoming))
    assert got == [("1", "A", 1.0, "x", "sin_cambio"), ("2", "A", None, "y", "actualizado"),
                   ("3", "B", 3.0, "y", "insertado")]
    counts = {r[0]: r[1] for r in up.action_counts(up.merge(target, incoming)).collect()}
    assert counts == {"sin_cambio": 1, "actualizado": 1, "insertado": 1}


def test_upsert_twice_changes_nothing(spark):
    target = spark.createDataFrame([("1", "A", 1.0, "x")], DDL)
    incoming = spark.createDataFrame([("1", "B", 5.0, "y"), ("2", "B", 3.0, "y")], DDL)
    once = up.upsert(target, incoming)
    assert rows(up.upsert(once, incoming)) == rows(once)


def test_merge_keeps_load_times(spark):
    old, now = dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 1)
    target = spark.createDataFrame([("1", "A", 1.0, "x", old, old), ("2", "A", 1.0, "x", old, old)],
                                   DDL + ", fecha_carga timestamp_ntz, fecha_actualizacion timestamp_ntz")
    incoming = spark.createDataFrame([("1", "A", 2.0, "x"), ("3", "A", 2.0, "x")], DDL)
    got = rows(up.upsert(target, incoming, as_of="2024-01-01"),
               "id_propiedad", "fecha_carga", "fecha_actualizacion")
    assert got == [("1", old, now), ("2", old, old), ("3", now, now)]


def test_bucketed_target_is_not_shuffled(spark):
    target = spark.createDataFrame([(str(i), "A", 1.0, "x") for i in range(50)], DDL)
    sinks.save_bucketed(target, "bucketed_target", "id_propiedad", 4)
    incoming = spark.createDataFrame([("7", "A", 9.0, "y"), ("99", "A", 9.0, "y")], DDL)
    merged = up.merge(spark.table("bucketed_target"), incoming)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # only the incoming side
    assert merged.count() == 51


def test_replace_by_city(spark):
    old = spark.createDataFrame([("A", 0), ("A", 1), ("B", 0)], "ciudad string, cluster_id int")
    new = spark.createDataFrame([("A", 7)], "ciudad string, cluster_id int")
    assert rows(up.replace_by(old, new)) == [("A", 7), ("B", 0)]


def test_references(spark):
    child = spark.createDataFrame([(1, "A", 0), (2, "A", 9), (3, "B", 0), (4, "A", None), (5, None, 0)],
                                  "id int, ciudad string, cluster_zona int")
    parent = spark.createDataFrame([("A", 0), ("A", 0)], "ciudad string, cluster_id int")
    assert rows(up.reference_violations(child, parent), "id") == [(2,), (3,)]
    fixed = rows(up.set_null_without_parent(child, parent), "id", "cluster_zona")
    assert fixed == [(1, 0), (2, None), (3, None), (4, None), (5, None)]


def test_write_zones_leaves_other_cities(spark, tmp_path):
    path = str(tmp_path / "zones")
    sinks.write_zones(spark.createDataFrame([("A", 0), ("B", 0)], "ciudad string, cluster_id int"), path)
    sinks.write_zones(spark.createDataFrame([("A", 5), ("A", 6)], "ciudad string, cluster_id int"), path)
    assert rows(spark.read.parquet(path).select("ciudad", "cluster_id")) == [("A", 5), ("A", 6), ("B", 0)]


def test_versions_and_reports(spark, tmp_path):
    df = spark.createDataFrame([("a, b", 1)], "motivos string, n int")
    sinks.write_csv_report(df, str(tmp_path / "csv"))
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "csv"))) == [("a, b", "1")]
    path = sinks.write_version(df, str(tmp_path / "t"), "1")
    assert rows(spark.read.parquet(path)) == [("a, b", 1)]
    try:
        sinks.write_version(df, str(tmp_path / "t"), "1")
    except Exception as e:
        assert "PATH_ALREADY_EXISTS" in str(e)
    else:
        raise AssertionError("a version was overwritten")


def test_training_set_sink(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", "Venta", 5.0), ("2", "Venta", None), ("3", "Alquiler", 2.0), ("4", "Permuta", 2.0)],
        "id_propiedad string, tipo_transaccion string, precio_cierre double").withColumn(
        "sold_date", F.lit(None).cast("timestamp_ntz"))
    counts = sinks.write_training_set(df, str(tmp_path / "train"))
    assert counts == {"Venta": 1, "Alquiler": 1}
    from zonalis.sources.tables import read_training_set
    back = read_training_set(spark, str(tmp_path / "train"), "Alquiler")
    assert rows(back, "id_propiedad", "precio_alquiler_mes", "precio_venta") == [("3", 2.0, None)]
