from zonalis.llm import hyper_language as H
from zonalis.llm.queries import op6_hyper_language


def test_profiles_and_edge_cases(spark):
    rows = [(1, "the cat and the dog", "en", "s"), (2, "der hund und die katze", "de", "s"), (3, None, "en", None),
            (4, "", None, None), (5, "12 -- 7", "de", None), (None, "the dog", None, "s"), (2, "und der hund", "de", "s"),
            (7, "the " * 40000, None, None), (8, "漢", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    profiles = H.fit_prototypes(df)
    assert list(profiles) == ["de", "en"]
    got = {(r.doc_id, r.lang_pred) for r in H.predict_languages(df, profiles).collect()}
    assert {(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (None, "en"), (7, "en")} <= got
    assert {(d, p) for d, p in got if d == 8} <= {(8, "de"), (8, "en")}
    none = H.predict_languages(df, {}).collect()
    assert len(none) == len(rows) and all(r.lang_pred == "und" and r.score == 0 for r in none)
    assert H.fit_prototypes(df.limit(0)) == {} and H.predict_languages(df.limit(0), profiles).count() == 0


def test_profiles_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i, f"word{chr(97 + i % 7)} text", "abc"[i % 3]) for i in range(60)],
                               "doc_id long, text string, lang string")
    one, many = H.fit_prototypes(df.coalesce(1)), H.fit_prototypes(df.repartition(7))
    assert all((one[k] == many[k]).all() for k in one)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = op6_hyper_language(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text")
    rows = got.join(docs, "doc_id").filter("held_out and lang is not null").collect()
    assert got.count() == docs.count()
    long = [r for r in rows if len(r.text) > 40]
    assert sum(r.lang_pred == r.lang for r in long) >= 0.97 * len(long)
    assert all(0 <= r.score <= 1 for r in rows)


def test_texts_like_no_language_fall_below_the_floor(spark):
    words = "the weather was fine and children went to river with their friends in morning".split()
    rows = [(i, " ".join(words[(i * j) % len(words)] for j in range(1, 12)), "en") for i in range(200)]
    df = spark.createDataFrame([*rows, (900, "ωψ", "en"), (901, "the river", "en")], "doc_id long, text string, lang string")
    totals = H.fit_totals(df)
    kept = H.in_learned_languages(df, H.unit(totals), H.score_floor(df, totals))
    assert {r.doc_id for r in df.collect()} - {r.doc_id for r in kept.collect()} == {900}
