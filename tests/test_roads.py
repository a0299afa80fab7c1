from pyspark.sql import functions as F

from zonalis import config
from zonalis.config import RoadCategory, RoadRule
from zonalis.operators import roads
from zonalis.plans.road_setup import classify_roads
from zonalis.sources.sinks import write_segments
from tests.conftest import rows

RULES = (
    RoadCategory("uno", "Uno", "#1", 5, (RoadRule("Avenida Irala"),
                                         RoadRule("Anillo", exact=False))),
    RoadCategory("dos", "Dos", "#2", 3, (RoadRule("AVENIDA IRALA"),
                                         RoadRule("Plaza", True, (0.0, 1.0), (0.0, 1.0)))),
)
NEAR, FAR = [(0.0, 0.0), (1.0, 1.0)], [(5.0, 5.0), (6.0, 6.0)]
DATA = [
    (1, "Avenida Irala ; Otra", NEAR), (2, "Avenida Irala Norte", FAR), (3, "Tercer Anillo Externo", FAR),
    (4, "Plaza", [(0.5, 0.5), (0.6, 0.6)]), (5, "plaza", FAR), (6, None, FAR), (7, "otra, avenida irala", NEAR),
    (8, "Anillo, Avenida Irala", [(2.0, 2.0), (3.0, 3.0)]),
]
DDL = "segment_id int, name {}, geom array<struct<lng:double,lat:double>>"


def test_all_matches(spark):
    segments = roads.with_names(spark.createDataFrame(DATA, DDL.format("string")))
    got = rows(roads.match_rules(segments, RULES), "segment_id", "regla")
    assert got == [(1, 0), (1, 2), (3, 1), (4, 3), (7, 0), (7, 2), (8, 0), (8, 1), (8, 2)]


def test_one_class_per_geometry(spark):
    result = classify_roads(spark.createDataFrame(DATA, DDL.format("string")), RULES)
    # 1 and 7 share their geometry, so do 2, 3, 5 and 6.
    assert rows(result.classified, "segment_id", "regla", "nombre_via") == [
        (1, 0, "Avenida Irala"), (3, 1, "Anillo"), (4, 3, "Plaza"), (8, 0, "Avenida Irala")]
    assert rows(result.summary) == [("Dos", 1), ("Uno", 3)]
    assert rows(result.hits, "regla", "nombre_via", "segmentos") == [
        (0, "Avenida Irala", 3), (1, "Anillo", 2), (2, "AVENIDA IRALA", 3), (3, "Plaza", 1)]


def test_rules_without_segments(spark):
    none = (RoadCategory("tres", "Tres", "#3", 1, (RoadRule("Nowhere"),)),)
    result = classify_roads(spark.createDataFrame(DATA, DDL.format("string")), none)
    assert rows(result.hits) == [(0, "tres", "Tres", "Nowhere", 0)] and result.summary.count() == 0


def test_list_names_are_not_split(spark):
    data = [(i, [n] if n else None, g) for i, n, g in DATA]
    segments = roads.with_names(spark.createDataFrame(data, DDL.format("array<string>")))
    assert rows(roads.match_rules(segments, RULES), "segment_id", "regla") == [(3, 1), (4, 3), (8, 1)]


def test_name_count_and_bounds(spark, tmp_path):
    segments = roads.with_names(spark.createDataFrame(DATA, DDL.format("string")))
    assert rows(roads.count_of_name(segments, " Avenida IRALA")) == [(3,)]
    bounds = rows(roads.with_bounds(segments).filter("segment_id = 2"), "lng_min", "lng_max", "lat_min", "lat_max")
    assert bounds == [(5.0, 6.0, 5.0, 6.0)]
    write_segments(segments, str(tmp_path / "roads"))
    assert spark.read.parquet(str(tmp_path / "roads")).schema["geom"].dataType == segments.schema["geom"].dataType


def test_default_rules(spark):
    frame = roads.rule_frame(spark, config.ROAD_CATEGORIES)
    assert frame.count() == 101
    boxed = frame.filter(F.col("_lat_min").isNotNull())
    assert sorted(r["nombre_via"] for r in boxed.collect()) == [
        "Avenida Juan Pablo II", "Avenida Noel Kempff Mercado"]
    line = [(-63.16, -17.80), (-63.16, -17.80)]
    data = [(1, "Avenida Cañoto", NEAR), (2, "Avenida Juan Pablo II", line), (3, "Avenida Juan Pablo II", FAR),
            (4, "Calle Quinto Anillo", [(9.0, 9.0), (9.0, 8.0)])]
    got = rows(roads.classify(spark.createDataFrame(data, DDL.format("string"))), "segment_id", "categoria")
    assert got == [(1, "anillos_principales"), (2, "anillos_principales"), (4, "anillos_expansion")]


def test_segments_are_not_shuffled_by_the_rules(spark):
    segments = roads.with_names(spark.createDataFrame(DATA, DDL.format("string")))
    plan = roads.match_rules(segments, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "NestedLoop" not in plan
