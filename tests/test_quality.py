import datetime as dt

import pytest
from pyspark.sql import functions as F

from zonalis import config
from zonalis.operators import quality as q
from zonalis.operators import reports
from zonalis.plans.cleaning import CleaningRules, clean
from tests.conftest import rows

DAY = [dt.datetime(2024, 1, d) for d in range(1, 29)]


def test_flag_last_is_total_and_keeps_one(spark):
    data = [("a", DAY[0], 1.0, "x"), ("a", DAY[2], 1.0, "x"), ("a", DAY[2], 2.0, "x"),
            ("a", None, 9.0, "x"), ("b", None, None, "y"), ("c", DAY[1], 1.0, "p"), ("c", DAY[1], 1.0, "q")]
    want = None
    for n in (1, 4, 17):
        df = spark.createDataFrame(data, "id string, d timestamp_ntz, p double, s string").repartition(n)
        got = rows(q.flag_last(df, "id", ["d", "p"]).filter("es_ultimo").drop("es_ultimo"))
        want = want or got
        assert got == want
    assert want == [("a", DAY[2], 2.0, "x"), ("b", None, None, "y"), ("c", DAY[1], 1.0, "q")]
    assert rows(q.keep_last(df, "id", ["d", "p"])) == want


def test_flag_last_of_hot_and_null_keys(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 != 0, F.col("id") % 500).alias("k"),
        (F.col("id") * 7 % 101).alias("v"), F.col("id").alias("w"))
    flagged = q.flag_last(df, "k", ["v"])
    assert flagged.count() == 3000
    assert rows(flagged.filter("es_ultimo").drop("es_ultimo")) == rows(q.keep_last(df, "k", ["v"]))


def test_identical_rows_keep_exactly_one(spark):
    df = spark.createDataFrame([(1, 2)] * 50, "k int, v int")
    flagged = q.flag_last(df, "k", ["v"])
    assert flagged.count() == 50 and flagged.filter("es_ultimo").count() == 1


def test_map_category(spark):
    df = spark.createDataFrame([("Dúplex",), ("???",), (None,), ("Quinta",)], "subtipo_original string")
    got = q.map_category(df, "subtipo_original", "t", config.SUBTYPE_TO_TYPE, config.DEFAULT_TYPE)
    assert rows(got, "t") == [("Departamento",), ("Otro",), ("Otro",), ("Otro",)]


def areas(spark, data):
    return q.with_type_areas(spark.createDataFrame(
        data, "tipo_propiedad string, construction_area_m double, land_m2 double, total_area double"))


def test_type_areas_and_invalid_area(spark):
    df = areas(spark, [("Casa", 10.0, 5.0, 1.0), ("Departamento", 10.0, 0.0, 1.0),
                       ("Departamento", 0.0, 3.0, 1.0), ("Terreno", 9.0, 9.0, 30.0),
                       ("Terreno", 9.0, 9.0, -1.0), ("Oficina", 9.0, 9.0, 9.0),
                       ("Casa", None, 5.0, 1.0)])
    got = [tuple(r) for r in df.select("m2_construidos", "m2_terreno", q.invalid_area()).collect()]
    assert got == [(10.0, 5.0, False), (10.0, None, False), (0.0, 3.0, True), (0.0, 30.0, False),
                   (0.0, -1.0, True), (None, None, False), (None, 5.0, False)]


def test_missing_fields_give_one_reason_each(spark):
    df = spark.createDataFrame(
        [("Casa", 10.0, None, 9.0, 0, 2), ("Terreno", None, None, None, None, None),
         ("Oficina", None, None, None, None, None), ("Departamento", 5.0, None, None, 1, 1)],
        "tipo_propiedad string, construction_area_m double, land_m2 double, total_area double, "
        "dormitorios int, banos int")
    got = [sorted(r[0]) for r in df.select(q.missing_field_reasons()).collect()]
    assert got == [["dormitorios nulo o 0", "m2_terreno nulo o 0"], ["m2_total nulo o 0"], [], []]


def outliers(spark, values, **options):
    df = spark.createDataFrame([("a", v) for v in values], "k string, v double")
    return [r["v"] for r in q.flag_outliers(df, "v", ["k"], **options).filter("es_atipico").collect()]


def test_outliers(spark):
    near = [10.0, 11.0, 9.0, 10.0] * 5
    assert outliers(spark, near + [1000.0]) == [1000.0]
    assert outliers(spark, near + [1000.0], at_most=1) == [1000.0]
    assert outliers(spark, near + [None]) == []
    assert outliers(spark, [1.0, 2.0, 900.0], sigmas=0.5) == []        # fewer than four values
    assert outliers(spark, [5.0] * 9) == []                            # no spread
    assert outliers(spark, [0.0, 0.0, 0.0, 4.0], sigmas=1.5) == []     # 4 = 1 + 1.5 * 2, on the bound
    assert outliers(spark, [0.0, 0.0, 0.0, 4.0], sigmas=1.49) == [4.0]


def test_outliers_only_among_survivors(spark):
    df = spark.createDataFrame([("a", 10.0, True)] * 5 + [("a", 11.0, True)] * 5 + [("a", 500.0, False)],
                               "k string, v double, ok boolean")
    marked = q.flag_outliers(df, "v", ["k"], among=F.col("ok"))
    assert rows(marked.filter("es_atipico"), "v") == [(500.0,)]


def test_price_floor(spark):
    df = spark.createDataFrame(
        [("Venta", "Casa", 49999.0), ("Venta", "Casa", 50000.0), ("Venta", "Casa", None),
         ("Alquiler", "Terreno", 1.0), ("Alquiler", "Casa", 499.0), (None, "Casa", 1.0)],
        "tipo_transaccion string, tipo_propiedad string, precio_publicacion double")
    marked = q.flag_below_floor(df, config.PRICE_FLOORS)
    assert [r["bajo_minimo"] for r in marked.collect()] == [True, False, False, False, True, False]
    reasons = {r[0] for r in marked.filter("bajo_minimo").select(q.floor_reason()).collect()}
    assert reasons == set(config.REASON_FLOOR.values())


def test_load_violations(spark):
    df = spark.createDataFrame(
        [("1", "Casa", "Venta", "X"), ("1", "Casa", "Venta", "Y"), ("2", None, "Venta", "X"),
         (None, "Casa", "Venta", None), ("3", "Casa", "Venta", "X"), ("3", None, "Venta", "X")],
        "id_propiedad string, tipo_propiedad string, tipo_transaccion string, ciudad string")
    got = rows(q.load_violations(df).select("id_propiedad", "ciudad", "violaciones"))
    assert got == [
        ("1", "X", ["id_propiedad repetido"]), ("1", "Y", []), ("2", "X", ["tipo_propiedad nulo"]),
        ("3", "X", ["tipo_propiedad nulo"]), ("3", "X", []),
        (None, None, ["id_propiedad nulo", "ciudad nulo"])]


def test_reject_reports(spark):
    df = spark.createDataFrame(
        [("1", "m", "s", "t", "Venta", "b"), ("1", "m", "s", "t", "Venta", "a"),
         ("1", "m", "s", "t", "Venta", "a"), ("2", None, "s", "t", "Venta", "a"),
         ("3", "m", "s", "t", "Venta", "b"), ("4", "m", "s", "t", "Venta", "b")],
        "id_propiedad string, mlsid string, subtipo_original string, tipo_propiedad string, "
        "tipo_transaccion string, motivo string")
    detail = rows(reports.reject_detail(df), "id_propiedad", "motivos")
    assert detail == [("1", "a, b"), ("3", "b"), ("4", "b")]
    assert len(rows(reports.reject_detail(df, drop_null_keys=False))) == 4
    assert [tuple(r) for r in reports.reject_summary(df).collect()] == [("b", 3), ("a", 2)]
    assert [tuple(r) for r in reports.value_counts(df, "motivo").collect()] == [("a", 3), ("b", 3)]


RAW = ("id_propiedad string, mlsid string, segmento string, subtipo_original string, "
       "tipo_transaccion string, construction_area_m double, land_m2 double, total_area double, "
       "dormitorios int, banos int, precio_publicacion double, precio_cierre double, "
       "latitude double, longitude double, sold_date timestamp_ntz")


def listing(i, subtype="Casa", deal="Venta", built=100.0, land=200.0, total=300.0, beds=3, baths=2,
            price=90000.0, closing=88000.0, lat=-17.5, lng=-63.1, sold=DAY[0]):
    return (str(i), f"M{i}", "s", subtype, deal, built, land, total, beds, baths, price, closing,
            lat, lng, sold)


def raw_rows():
    normal = [listing(i, closing=88000.0 + i, built=100.0 + i % 3) for i in range(30)]
    return normal + [
        listing(0, sold=None),                         # duplicate of 0
        listing(100, lat=None), listing(101, lng=float("nan")),
        listing(102, built=0.0),                       # invalid area
        listing(103, beds=0, land=None),               # two missing fields
        listing(104, closing=9e9),                     # price outlier
        listing(105, built=9e6),                       # area outlier, after the price step
        listing(106, price=10.0),                      # below the floor
        listing(107, subtype="Oficina", built=None, beds=None),
        listing(108, deal="Permuta"),                  # unknown transaction
        listing(109, subtype="Terreno", deal="Alquiler", price=1.0),  # no floor for rented land
    ]


def test_clean_chain(spark):
    result = clean(spark.createDataFrame(raw_rows(), RAW))
    steps = {r["id_propiedad"]: r["paso"] for r in
             result.checked.filter("paso <> 'duplicado'").collect()}
    assert steps["100"] == steps["101"] == "sin_coordenadas"
    assert steps["102"] == "m2_invalido" and steps["103"] == "campos_requeridos"
    assert steps["104"] == "atipico_precio" and steps["105"] == "atipico_m2"
    assert steps["106"] == "precio_minimo" and steps["108"] == "otra_transaccion"
    assert steps["107"] == steps["109"] == "conservado" and steps["0"] == "conservado"
    reasons = rows(result.rejects, "id_propiedad", "motivo")
    assert reasons == sorted([
        ("0", "duplicado"), ("102", config.REASON_AREA), ("103", "dormitorios nulo o 0"),
        ("103", "m2_terreno nulo o 0"), ("104", config.REASON_PRICE_OUTLIER),
        ("105", config.REASON_AREA_OUTLIER), ("106", config.REASON_FLOOR["Venta"])])
    counters = {r["paso"]: r["filas"] for r in result.counters.collect()}
    assert sum(counters.values()) == len(raw_rows())
    assert counters["conservado"] == result.kept.count() == 32


def test_clean_does_not_depend_on_partitions(spark):
    frame = spark.createDataFrame(raw_rows(), RAW)
    results = [rows(clean(frame.repartition(n)).checked, "id_propiedad", "paso", "motivos")
               for n in (1, 4, 17)]
    assert results[0] == results[1] == results[2]


def test_clean_of_nothing(spark):
    result = clean(spark.createDataFrame([], RAW), CleaningRules())
    assert result.kept.count() == 0 and result.rejects.count() == 0


@pytest.mark.parametrize("n_types,n_deals", [(7, 2)])
def test_group_bound_of_rules(n_types, n_deals):
    assert CleaningRules().groups == n_types * n_deals


def test_flag_last_splits_heavy_keys_only(spark):
    data = [("a", i % 7, "x" * (i % 3)) for i in range(60)] + [(None, i % 5, "n") for i in range(40)] + [
        ("b", 1, "p"), ("b", 1, "q"), ("c", None, None)]
    df = spark.createDataFrame(data, "k string, v int, t string").repartition(3)
    split, whole = q.flag_last(df, "k", ["v"], hot_rows=10), q.flag_last(df, "k", ["v"])
    assert rows(split) == rows(whole) and split.filter("es_ultimo").count() == 4
    assert split.count() == len(data)


def test_clean_writes_its_rows_once(spark, monkeypatch):
    from checks import fixtures as fx
    from zonalis.plans import cleaning
    names = []
    monkeypatch.setattr(cleaning, "staged", lambda df, name, real=cleaning.staged: names.append(name) or real(df, name))
    done = cleaning.clean(fx.listings(spark, "/root/testdata/sf0.001"))
    assert names == ["cleaning"]
    assert sum(r.filas for r in done.counters.collect()) == done.checked.count() > 0


def test_line_items_are_dealt_to_shuffle_tasks(spark):
    from checks import fixtures as fx
    plan = fx.tables(spark, "/root/testdata/sf0.001", "lineitem")["lineitem"]._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan


def test_staging_leaves_no_shuffle_files(spark, monkeypatch):
    """Shuffles of a written frame go with the write, and the session's setting is as before."""
    from zonalis.sources import session
    seen = []
    writer = type(spark.range(1).write)
    real = writer.parquet
    monkeypatch.setattr(writer, "parquet", lambda self, *a, **k: seen.append(spark.conf.get(session.SHUFFLES_GO)) or real(self, *a, **k))
    before = spark.conf.get(session.SHUFFLES_GO)
    assert session.staged(spark.range(9).repartition(3, "id"), "probe").count() == 9
    assert seen == ["true"] and spark.conf.get(session.SHUFFLES_GO) == before
