"""The corpus pipeline and the registered queries on the smallest tables."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from cases import documents, empty, rows, words
from tributary.llm import registry
from tributary.llm.common import stored


def test_stages_on_awkward_documents(spark):
    docs = documents(spark)
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, ""), name)
        assert docs.columns == documents(spark).columns
        seen[name] = docs.collect()
    final = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert final and all(r["lossless"] for r in final)
    # clean documents stay through the filtering stages
    clean = {r[0] for r in rows() if len(words(r[1])) >= 60 and "\n" in r[1] and r[0] in range(31, 61, 3)}
    assert clean <= {r["doc_id"] for r in seen["near_dedup"]}
    # the copies of the first long text are gone before the mix
    copies = [r[1] for r in rows() if r[0] == 7]
    assert sum(r["text"] == copies[0] for r in seen["near_dedup"]) == 1
    assert len(seen["line_dedup"]) < len(seen["quality_rules"]) < len(rows())


def test_quality_rules_leave_clashing_columns_alone(spark):
    own = {"n_words": F.lit("own"), "N_Common_Words": F.lit(-5), "base_failed": F.col("doc_id")}
    docs = documents(spark).withColumns(own)
    got = corpus_pipeline.quality_rules(spark, docs, "")
    assert got.dtypes == docs.dtypes
    kept = got.collect()
    assert kept and all((r["kept"], r["n_words"], r["N_Common_Words"], r["base_failed"])
                        == ("k", "own", -5, r["doc_id"]) for r in kept)


def test_near_dedup_keeps_one_of_each_group(spark):
    kept = corpus_pipeline.near_dedup(spark, documents(spark), "").collect()
    base = rows()[7][1].split()
    alike = [r for r in kept if r["text"] and len(set(base) & set(r["text"].split())) > 100]
    assert Counter(r["doc_id"] for r in alike)[7] == 1 and len(alike) < 12


def test_near_dedup_tells_rows_apart(spark):
    def long(name, *changed):
        return " ".join(changed + tuple(f"{name}{i}" for i in range(80)))

    given = [(1, long("a")), (1, long("a")), (2, long("a")), (None, long("a")), (None, long("a", "x")),
             (None, long("b")), (None, long("b")), (None, long("b", "y")),
             (5, long("c")), (5, long("a", "z")), (6, long("c", "q")),
             (7, long("d")), (8, None), (9, " "), (None, long("e")),
             (-2 ** 63, long("f")), (None, long("f"))]
    docs = spark.createDataFrame([(i, t, "en", f"s{k}", *[None] * 5) for k, (i, t) in enumerate(given)],
                                 documents(spark).schema).repartition(3)
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    kept = Counter((r["doc_id"], r["text"]) for r in got.collect())
    assert max(kept.values()) == 1
    copies = {(None, long("b")), (None, long("b", "y"))} & set(kept)
    assert len(copies) == 1 and set(kept) - copies == {
        (1, long("a")), (5, long("c")), (7, long("d")), (8, None), (9, " "), (None, long("e")), (-2 ** 63, long("f"))}


def test_empty_corpus(spark):
    docs = empty(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), name)
    assert docs.count() == 0


def test_names():
    numbers = sorted(int(k[2:].split("_")[0]) for k in registry.QUERIES)
    assert numbers == list(range(1, 14)) and set(registry.ORACLES) <= set(registry.QUERIES)
