"""The pipeline against brute force, stage after stage."""

import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken

import corpus_pipeline
from tests.llm.test_line_chunks import brute_runs as brute_lines
from tests.llm.test_trie_join import brute as brute_groups
from zonalis.llm import bm25_leaks as L
from zonalis.llm.byte_bpe import load_ranks

FOLDER = "/root/testdata/sf0.001"


def leaked(text, items):
    """Every window scored with every item by the plain formula, then verified."""
    mean = np.mean([len(L.words_of(t)) for _, t in items])
    holders = {}
    for i, t in items:
        for w in set(L.words_of(t)):
            holders[w] = holders.get(w, 0) + 1
    words = L.words_of(text)
    stride = max(L.STRIDE, max(len(L.words_of(t)) for _, t in items))
    windows = [words[s:s + 2 * stride] for s in range(0, max(1, len(words) - stride), stride)]
    for _, t in items:
        mine = L.words_of(t)
        norm = L.K1 * (1 - L.B + L.B * len(mine) / mean)
        weight = {w: np.log(1 + (len(items) - holders[w] + 0.5) / (holders[w] + 0.5)) * mine.count(w) * (L.K1 + 1)
                  / (mine.count(w) + norm) for w in set(mine)}
        own = sum(weight.values())
        question, answer = map(L.grams_of, L.question_and_answer(t))
        for window in windows:
            score = sum(x for w, x in weight.items() if w in set(window)) / own
            if score >= L.THRESHOLD - 1e-9 and min(
                    L.share_found(question, window), L.share_found(answer, window)) >= L.OVERLAP:
                return True
    return False


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    extra = [(9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (9003, "12 34", "en", "s", 5), (None, "no id here", "en", "s", 10),
             (9004, items[0][1], "en", "s", 1)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(d, t) for d, t in rows if any(c.isalpha() for c in t or "")]
    want = [(d, t) for d, t, *_ in brute_lines(want)]
    root = {d: c for d, _, c in brute_groups(want)}
    want = [(d, t) for d, t in want if root[d] == d]
    want = [(d, t) for d, t in want if not leaked(t, items)]
    ours = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = ours
        ours = stage(spark, ours, FOLDER).cache()
        assert ours.columns == docs.columns and ours.count() <= before.count()
    got = sorted(((r.doc_id, r.text) for r in ours.collect()), key=repr)
    assert got == sorted(want, key=repr)
    assert all(r.n_chars == len(r.text) for r in ours.select("text", "n_chars").collect() if "\r" not in r.text)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(P.path("byte_bpe_50k.tiktoken")),
                            special_tokens={})
    last = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.STAGES[-1][1](spark, ours, FOLDER).collect()}
    assert last == {d: (len(lib.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for d, t in want}


def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert 0 < out.count() < spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_language_rejects_by_score_and_passes_all_without_labels(spark):
    english = "the weather was fine and the children went to the river with their friends in the morning"
    german = "das wetter war gut und die kinder gingen am morgen mit ihren freunden an den breiten fluss"
    docs = spark.createDataFrame([
        (1, english, "en"), (2, "the river and the weather", "en"), (3, german, "de"), (4, "die kinder und der fluss", "de"),
        (5, "the children and their friends", None), (6, "η βροχή έπεφτε όλη τη νύχτα στους δρόμους", None),
        (7, "12 34", None), (8, None, None)], "doc_id long, text string, lang string")
    kept = corpus_pipeline.language(spark, docs, FOLDER)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5]
    bare = docs.withColumn("lang", docs["lang"].substr(1, 0)).replace("", None, "lang")
    assert sorted(map(tuple, corpus_pipeline.language(spark, bare, FOLDER).collect())) == sorted(map(tuple, bare.collect()))


def test_near_copies_keeps_one_row_of_repeats(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    rows = [(2, "a b c d e f g", "en", "s", 13), (2, "a b c d e f g", "en", "s", 13), (1, "x y", "en", "s", 3),
            (None, "p q", "en", "s", 3), (None, "p q", "en", "s", 3), (None, None, "en", "s", 0), (5, "A B c d e f g", "en", "s", 13),
            (7, "one", "en", "s", 3), (7, "two", "en", "s", 3)]
    got = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, docs.schema), FOLDER).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(
        [(2, "a b c d e f g"), (1, "x y"), (None, "p q"), (None, None), (7, "one"), (7, "two")], key=repr)


def test_run_on_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
