"""Line dedup by content-defined chunks, in DataFrame functions only.

The lines of a text are hashed; a rolling hash over the last lines' hashes decides where a chunk ends, so boundaries
depend on the lines around them and not on their place in the text. A chunk of several lines that occurs more than once
in the corpus stays where it occurs first and is removed elsewhere.

``dedup_line_chunks`` finds only passages with boundaries inside them; ``dedup_line_passages`` cuts what its chunks leave
again at every line and so finds every repeated run of two or more lines. ``dedup_line_runs`` has the same result from
pairs of lines alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.sources.session import staged

WINDOW = 2
DIVISOR = 3
MIN_LINES = 2
BASE = 1_000_003
MODULUS = 2_147_483_647


def line_hashes(lines: Column) -> Column:
    """31-bit numbers from the MD5 of each line, which SQL engines agree on."""
    return F.transform(lines, lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long") % MODULUS)


def chunk_ends(hashes: Column, window: int = WINDOW, divisor: int = DIVISOR) -> Column:
    """Numbers (from 1) of the lines that end a chunk: the last one, and those whose rolling hash is 0 modulo ``divisor``.

    The rolling hash of line i is that of lines i - window + 1 to i; lines before the first count as 0.
    """

    def rolling(i: Column) -> Column:
        value = F.lit(0).cast("long")
        for back in range(window - 1, -1, -1):
            at = F.when(i > back, F.get(hashes, i - 1 - back)).otherwise(0)
            value = (value * BASE + at) % MODULUS
        return value

    n = F.size(hashes)
    return F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (rolling(i) % divisor == 0))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a plain reference inside a lambda is computed for each element."""
    return F.get(F.transform(F.array(value), body), 0)


def chunked(text: Column, window: int = WINDOW, divisor: int = DIVISOR, by_line: bool = False) -> Column:
    """Array of (no, n_lines, chunk) of a text; joined with line ends they give the text again. Null for a null text.

    ``no`` counts chunks, or with ``by_line`` is the number of the chunk's first line; both from 0.
    """

    def cut(lines: Column, ends: Column) -> Column:
        def one(end: Column, k: Column) -> Column:
            start = F.when(k == 0, 0).otherwise(F.get(ends, k - 1))
            return F.struct((start if by_line else k).alias("no"), (end - start).alias("n_lines"),
                            F.array_join(F.slice(lines, start + 1, end - start), "\n").alias("chunk"))

        return F.transform(ends, one)

    return _let(F.split(text, "\n", -1), lambda lines: _let(
        line_hashes(lines), lambda hashes: _let(
            chunk_ends(hashes, window, divisor), lambda ends: cut(lines, ends))))


def dedup_line_chunks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                      divisor: int = DIVISOR, min_lines: int = MIN_LINES,
                      carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``df``: the id, ``kept_text``, ``n_removed`` chunks, ``removed_lines``, and the struct
    ``carried`` of the columns named in ``carry``.

    Of equal chunks of at least ``min_lines`` lines, the one in the smallest id (then the earliest in the text) stays.
    Hashes only pick candidates; chunks are equal if their bytes are. Rows with the same id and text are one
    document, so neither takes from the other; rows with one id and different texts are separate documents. Null ids
    come first. A null text stays null, an empty one empty. If all chunks go, the text is empty.

    Three small shuffles: hashes with their counts, the texts of chunks whose hash repeats, and the numbers of removed
    chunks; texts themselves are joined to the latter once. Counting combines before the shuffle, and joins with a
    frequent chunk are split by adaptive execution.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                     F.struct(*(carry or [F.lit(None).cast("int").alias("none")])).alias("carried"),
                     F.xxhash64(text_col).alias("text_key"))
    parts = (docs.select("id", "text_key", F.explode(chunked(F.col("text"), window, divisor)).alias("c"))
             .select("id", "text_key", "c.no", "c.n_lines", "c.chunk")
             .filter(F.col("n_lines") >= min_lines)
             .withColumn("key", F.xxhash64("chunk")))
    place = F.struct(F.col("id"), F.col("text_key"), F.col("no"))
    often = (parts.groupBy("key").agg(F.min(place).alias("low"), F.max(place).alias("high"))
             .filter(~F.col("low").eqNullSafe(F.col("high"))).select("key"))
    candidates = parts.join(often, "key", "left_semi").select("id", "text_key", "no", "chunk")
    first = candidates.groupBy("chunk").agg(F.min(place).alias("first"))
    again = (candidates.join(first, "chunk").filter(~place.eqNullSafe(F.col("first")))
             .groupBy(F.col("id").alias("of_id"), F.col("text_key").alias("of_key"))
             .agg(F.collect_set("no").alias("found")))
    joined = docs.join(again, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key")), "left")
    out = joined.select("id", "text", "carried", F.coalesce("found", F.array().cast("array<int>")).alias("gone"))
    untouched = F.size("gone") == 0
    out = out.withColumn("chunks", F.when(~untouched, chunked(F.col("text"), window, divisor)))
    stays = F.filter("chunks", lambda c: ~F.array_contains(F.col("gone"), c["no"]))
    lost = F.filter("chunks", lambda c: F.array_contains(F.col("gone"), c["no"]))
    out = out.select(
        F.col("id").alias(id_col),
        F.when(untouched, F.col("text")).otherwise(
            F.array_join(F.transform(stays, lambda c: c["chunk"]), "\n")).alias("kept_text"),
        F.size("gone").cast("long").alias("n_removed"),
        F.when(untouched, 0).otherwise(F.aggregate(
            lost, F.lit(0), lambda a, c: a + c["n_lines"])).cast("long").alias("removed_lines"),
        "carried")
    return out if carry else out.drop("carried")


def line_pairs(text: Column, key) -> Column:
    """Array of (no, key) for every two adjacent lines of a text; ``no`` counts from 0. Empty for fewer than two lines."""
    def pairs(lines: Column) -> Column:
        firsts = F.slice(lines, 1, F.size(lines) - 1)
        return F.transform(firsts, lambda x, i: F.struct(i.alias("no"), key(x, F.get(lines, i + 1)).alias("key")))

    return _let(F.split(text, "\n", -1), pairs)


def dedup_line_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``df``: the id, ``kept_text``, ``n_removed`` runs, ``removed_lines``, and ``carried`` as above.

    A line goes if it lies in two or more adjacent lines that also stand, adjacent and in this order, at an earlier
    place: in a smaller id, or before and apart from them in the same text. Every such run is made of pairs of adjacent
    lines with an earlier copy, so pairs find runs of any length to their last line, and a copy of every removed line
    stays where it occurs first. Adjacent removed lines are one run. Rows, nulls and empty texts as in
    ``dedup_line_chunks``; a text of one line never goes.

    64-bit hashes only pick candidates; pairs are equal if their SHA-256 are. Texts are joined to the numbers of their
    repeated pairs once.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                     F.struct(*(carry or [F.lit(None).cast("int").alias("none")])).alias("carried"),
                     F.xxhash64(text_col).alias("text_key"))
    place = F.struct(F.col("id"), F.col("text_key"), F.col("no"))
    often = (_exploded(docs, F.xxhash64).groupBy("key").agg(F.min(place).alias("low"), F.max(place).alias("high"))
             .filter(~F.col("low").eqNullSafe(F.col("high"))).select("key"))
    return _without_pairs(docs, _again(docs, often), id_col, carry)


def _exploded(docs: DataFrame, key) -> DataFrame:
    return docs.select("id", "text_key", F.explode(line_pairs(F.col("text"), key)).alias("p")).select(
        "id", "text_key", "p.no", "p.key")


def _again(docs: DataFrame, often: DataFrame) -> DataFrame:
    """(id, text_key, no) of the pairs of lines, among those with a key in ``often``, that stand at an earlier place."""
    # Lines hold no line end, so joined pairs differ if their lines do.
    digest = lambda a, b: F.struct(F.xxhash64(a, b).alias("low"),
                                   F.unhex(F.sha2(F.concat(a, F.lit("\n"), b), 256)).alias("sha"))
    place = F.struct(F.col("id"), F.col("text_key"), F.col("no"))
    candidates = (_exploded(docs, digest).select("id", "text_key", "no", F.col("key.low").alias("key"), "key.sha")
                  .join(often, "key", "left_semi").drop("key"))
    first = candidates.groupBy("sha").agg(F.min(place).alias("first"))
    same_text = F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.text_key") == F.col("text_key"))
    return (candidates.join(first, "sha").filter(~(same_text & (F.col("no") - F.col("first.no") < 2)))
            .select("id", "text_key", "no"))


def _pair_runs(found: Column) -> Column:
    """(start, end) of the runs that adjacent or overlapping pairs of lines cover; ``found`` is sorted."""
    starts = F.filter(found, lambda x, k: (k == 0) | (F.get(found, k - 1) < x - 2))
    ends = F.filter(found, lambda x, k: (k == F.size(found) - 1) | (F.get(found, k + 1) > x + 2))
    return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), (e + 2).alias("end")))


def _outside(lines: Column, gone: Column) -> Column:
    def before(k: Column) -> Column:
        start = F.when(k == 0, 0).otherwise(F.get(gone, k - 1)["end"])
        end = F.when(k == F.size(gone), F.size(lines)).otherwise(F.get(gone, k)["start"])
        return F.slice(lines, start + 1, end - start)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), before))


def _without_pairs(docs: DataFrame, again: DataFrame, id_col: str, carry: Sequence[str]) -> DataFrame:
    """``docs`` without the lines of the pairs in ``again`` (id, text_key, no)."""
    by_text = (again.groupBy(F.col("id").alias("of_id"), F.col("text_key").alias("of_key"))
               .agg(F.sort_array(F.collect_set("no")).alias("found")))
    joined = docs.join(by_text, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key")), "left")
    touched = F.col("found").isNotNull()
    kept = _let(F.split("text", "\n", -1), lambda lines: F.array_join(_let(
        _pair_runs(F.col("found")), lambda gone: _outside(lines, gone)), "\n"))
    n_lines = F.aggregate(_pair_runs(F.col("found")), F.lit(0), lambda a, r: a + r["end"] - r["start"])
    out = joined.select(
        F.col("id").alias(id_col), F.when(touched, kept).otherwise(F.col("text")).alias("kept_text"),
        F.when(touched, F.size(_pair_runs(F.col("found")))).otherwise(0).cast("long").alias("n_removed"),
        F.when(touched, n_lines).otherwise(0).cast("long").alias("removed_lines"), "carried")
    return out if carry else out.drop("carried")


def dedup_line_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                        divisor: int = DIVISOR, carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``df``: the id, ``kept_text``, ``n_removed`` runs, ``removed_lines``, and ``carried`` as above.

    Content-defined chunks at two sizes. Chunks between rolling-hash boundaries that occur more than once are found
    first and compared by SHA-256; all but the first go. What they leave, the ends of passages and passages without two
    boundaries inside, is cut again at the finest size, two adjacent lines at every line, and compared by SHA-256. So a
    matched passage grows line by line to its ends, and the rule is that of ``dedup_line_runs``: a line goes if it lies
    in two or more adjacent lines that also stand at an earlier place, apart from them. A removed chunk has an earlier
    copy, so the first place of every pair of lines is outside all removed chunks and is still there to compare with.

    Rows of the same id and text are one document; null ids come first; a null text stays null, an empty one empty; a
    text of one line never goes. If all lines go, the text is empty.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                     F.struct(*(carry or [F.lit(None).cast("int").alias("none")])).alias("carried"),
                     F.xxhash64(text_col).alias("text_key"))
    place = F.struct(F.col("id"), F.col("text_key"), F.col("no"))

    def seen_twice(parts: DataFrame) -> DataFrame:
        return (parts.groupBy("key").agg(F.min(place).alias("low"), F.max(place).alias("high"))
                .filter(~F.col("low").eqNullSafe(F.col("high"))).select("key"))

    # Digests in place of the chunks' texts: the texts themselves are shuffled once, at the end.
    parts = (docs.select("id", "text_key", F.explode(chunked(F.col("text"), window, divisor, by_line=True)).alias("c"))
             .filter(F.col("c.n_lines") >= MIN_LINES)
             .select("id", "text_key", "c.no", "c.n_lines", F.xxhash64("c.chunk").alias("key"),
                     F.unhex(F.sha2("c.chunk", 256)).alias("sha")))
    twice = parts.join(seen_twice(parts.drop("sha")), "key", "left_semi").drop("key")
    first_chunk = twice.groupBy("sha").agg(F.min(place).alias("first"))
    copies = staged(twice.join(first_chunk, "sha").filter(~place.eqNullSafe(F.col("first")))
                    .select("id", "text_key", "no", "n_lines"), "line-chunks")
    coarse = copies.select("id", "text_key", F.explode(
        F.sequence(F.col("no"), F.col("no") + F.col("n_lines") - 2)).alias("no"))

    # The finest cut, of what the chunks leave: one hash a line beside the numbers of the pairs that are gone already.
    gone = (copies.groupBy(F.col("id").alias("of_id"), F.col("text_key").alias("of_key")).agg(F.sort_array(F.flatten(
        F.collect_set(F.sequence(F.col("no"), F.col("no") + F.col("n_lines") - 2)))).alias("gone")))
    hashes = docs.filter(F.col("text").contains("\n")).select("id", "text_key", F.transform(
        line_pairs(F.col("text"), F.xxhash64), lambda p: p["key"]).alias("keys"))
    same_document = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key"))
    fresh = F.when(F.col("gone").isNull(), F.sequence(F.lit(0), F.size("keys") - 1)).otherwise(
        F.array_except(F.sequence(F.lit(0), F.size("keys") - 1), "gone"))
    left = (hashes.join(gone, same_document, "left").select("id", "text_key", "keys", F.explode(fresh).alias("no"))
            .select("id", "text_key", "no", F.get("keys", F.col("no")).alias("key")))
    again = _again(docs, seen_twice(left))
    return _without_pairs(docs, coarse.union(again), id_col, carry)
