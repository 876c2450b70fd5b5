"""Quality rules by cross-document line frequency (operator 6), DataFrame functions only.

Lines are normalised (outer white space cut, inner runs made one space, lower case, digits made 0)
and hashed to 128 bits. For each host the distinct documents that hold a line are counted; exact
copies of a text count as one document. A line held by more than ``max(min_docs, max_share * the
host's distinct documents)`` documents is above the limit and removed. A document is rejected when
it fails the base rules or when the removed lines held more than ``max_removed`` of its words.

Null text has no words and fails the base rules; null hosts form one host. Rows with equal id and
text are one document and share a verdict. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NON_SPACE, SPACES, identity, own_names, words_of

WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Columns that ``judged`` adds; columns of the input with these names are replaced.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_common_words", "kept")


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once; a lambda would compute it for each element."""
    return F.transform(F.array(value), body)[0]


def _window_hashes(words: Column) -> Column:
    return _bound(F.transform(words, lambda w: F.xxhash64(w)), lambda hashed: F.transform(
        F.sequence(F.lit(1), F.size(hashed) - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice(hashed, i, WINDOW))))


def _covered(windows: Column) -> Column:
    """Words inside the windows whose hash occurs more than once.

    (hash, start) pairs are sorted; the starts beside an equal hash, in order, each cover the words
    up to the next one, at most a window.
    """
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    starts = _bound(pairs, lambda p: F.array_sort(F.transform(F.filter(p, lambda x, k: (
        F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(p, k - 1)["h"] == x["h"], F.lit(False)))), lambda x: x["i"])))
    return _bound(starts, lambda s: F.aggregate(
        F.transform(s, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda total, x: total + x))


def base_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NON_SPACE))
    measured = docs.withColumns({
        "__words": words_of(F.col(text_col)), "__lines": lines,
        "word_chars": F.length(F.regexp_replace(text, SPACES, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long"),
    }).withColumns({
        "n_words": F.size("__words").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__windows": F.when(F.size("__words") > WINDOW, _window_hashes(F.col("__words"))),
    })
    windows = F.col("__windows")
    measured = measured.withColumn("n_repeat_words", F.when(
        windows.isNotNull() & (F.size(F.array_distinct(windows)) < F.size(windows)),
        _covered(windows)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("base_failed", (F.col("n_words") < 20) | (
        100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).drop("__words", "__lines", "__windows")


def normalised_line(line: Column) -> Column:
    plain = F.lower(F.trim(F.regexp_replace(line, SPACES, " ")))
    return F.regexp_replace(plain, r"[0-9]", "0")


def line_rows(docs: DataFrame, host_col: str, id_col: str, text_col: str) -> DataFrame:
    """One row per line with a word: host, document, line hash and words."""
    rows = docs.select(
        F.struct(F.col(host_col)).alias("__host"), *identity(id_col, text_col),
        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("__at", "__line"))
    line = normalised_line(F.col("__line"))
    return (rows.filter(F.col("__line").rlike(NON_SPACE)).withColumn("__line", line)
            .select("__host", "__id", "__text", "__at", F.xxhash64("__line").alias("__h1"),
                    F.xxhash64("__line", F.lit(1)).alias("__h2"),
                    (F.length("__line") - F.length(F.replace("__line", F.lit(" "), F.lit(""))) + 1)
                    .alias("__n")))


def frequent_lines(lines: DataFrame, max_share: float, min_docs: int) -> DataFrame:
    """Line hashes above the limit of their host."""
    texts = lines.select("__host", "__text").distinct().groupBy("__host").agg(F.count("*").alias("__docs"))
    held = (lines.select("__host", "__h1", "__h2", "__text").distinct()
            .groupBy("__host", "__h1", "__h2").agg(F.count("*").alias("__held"))
            .filter(F.col("__held") > min_docs))
    return (held.join(texts, "__host").filter(F.col("__held") > max_share * F.col("__docs"))
            .select("__host", "__h1", "__h2"))


@own_names
def judged(docs: DataFrame, *, host_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
           max_share: float = 0.01, min_docs: int = 10, max_removed: float = 0.8,
           remove_lines: bool = False) -> DataFrame:
    """``docs`` with the base features, n_common_words and kept (``MEASURES``).

    ``remove_lines`` also takes the lines above the limit out of the text; what is left keeps its
    order and its line ends.
    """
    docs = docs.drop("n_common_words")
    lines = line_rows(docs, host_col, id_col, text_col)
    common = (lines.join(frequent_lines(lines, max_share, min_docs), ["__host", "__h1", "__h2"])
              .dropDuplicates(["__host", "__id", "__text", "__at"]))  # repeated rows count once
    found = common.groupBy("__host", "__id", "__text").agg(
        F.sum("__n").alias("n_common_words"),
        *([F.collect_set(F.struct("__h1", "__h2")).alias("__common")] if remove_lines else []))
    rows = base_features(docs, text_col).withColumns({
        "__host": F.struct(F.col(host_col)),
        **{name: column for name, column in zip(("__id", "__text"), identity(id_col, text_col))}})
    if not remove_lines:
        rows = rows.drop(text_col)
    rows = rows.join(found, ["__host", "__id", "__text"], "left").withColumn(
        "n_common_words", F.coalesce("n_common_words", F.lit(0)))
    rows = rows.withColumn("kept", ~F.col("base_failed") & (
        F.col("n_common_words") <= max_removed * F.col("n_words")))
    if remove_lines:
        kept = F.filter(F.split(F.col(text_col), "\n"), lambda x: ~x.rlike(NON_SPACE) | ~F.array_contains(
            F.col("__common"), F.struct(F.xxhash64(normalised_line(x)).alias("__h1"),
                                        F.xxhash64(normalised_line(x), F.lit(1)).alias("__h2"))))
        rows = rows.withColumn(text_col, F.when(F.col("__common").isNull(), F.col(text_col)).otherwise(
            F.array_join(kept, "\n"))).drop("__common")
    return rows.drop("__host", "__id", "__text")


def op6_line_frequency(spark, sf_dir: str) -> DataFrame:
    """Base measures and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                               "n_repeat_words", "base_failed", "kept", "n_common_words")
