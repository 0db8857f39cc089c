from __future__ import annotations

from pyspark.sql import functions as F

from footfall.llm import ppm, samples, toxicity

SIZES = "id long, kind string, size long"


def drawn(spark, rows, most_rows, most_chars):
    df = spark.createDataFrame(rows, SIZES).repartition(4)
    return {r.id for r in samples.bounded(df, "kind", most_rows, most_chars).collect()}


def in_hash_order(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    return [r.id for r in df.orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 40)), "id").collect()]


def test_rows_and_characters_bound_a_sample(spark):
    rows = [(i, "a", 10) for i in range(3000)] + [(i, "b", 1000) for i in range(3000, 3100)]
    a, b = (in_hash_order(spark, [i for i, kind, _ in rows if kind == k]) for k in "ab")
    assert drawn(spark, rows, 50, 5000) == set(a[:50]) | set(b[:5])
    assert drawn(spark, rows, 50, 95) == set(a[:10]) | set(b[:1])
    assert drawn(spark, rows, 10_000, 10**9) == {i for i, _, _ in rows}


def test_no_text_is_too_long(spark):
    rows = [(i, "long", 10**9) for i in range(40)] + [(100, "alone", 10**12)]
    assert drawn(spark, rows, 5, 10) == {in_hash_order(spark, range(40))[0], 100}
    assert drawn(spark, [], 5, 10) == set()


def test_a_language_of_long_texts_is_learned(make_docs, spark):
    long = make_docs(*(f"zyx wvu {i} " * 3000 for i in range(30)), lang="zz")
    short = make_docs(*(f"the and of {i} " * 20 for i in range(30)), ids=list(range(100, 130)), lang="en")
    model = ppm.fit(long.unionByName(short))
    assert sorted(model) == ["en", "zz"]
    found = ppm.predict(long.unionByName(short), model)
    assert found.where("lang <> lang_pred").count() == 0


def test_a_label_of_long_texts_is_learned(make_docs, spark):
    toxic = make_docs(*(f"you vile idiot number {i} " * 1200 for i in range(40)))
    clean = make_docs(*(f"a fine day for walk {i} " * 10 for i in range(40)), ids=list(range(100, 140)))
    docs = toxic.unionByName(clean)
    labels = docs.select("doc_id", (F.col("doc_id") < 100).cast("int").alias("toxic"))
    # Labels of documents that are not at hand count for nothing.
    labels = labels.unionByName(spark.range(1000, 9000).select(F.col("id").alias("doc_id"), F.lit(0).alias("toxic")))
    found = toxicity.with_toxicity(docs, toxicity.fit(docs, labels))
    assert found.where("toxic <> (doc_id < 100)").count() == 0
