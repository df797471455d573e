"""The pipeline's stages on small tables."""

from __future__ import annotations

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, text_hash long, d long, _t long, h long"


def _words(tag, n=60):
    return " ".join(f"{tag}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n))


def _table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), 0.5, 1, 2, 3, 4) for i, t, lang in rows], SCHEMA)


def test_stages(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = docs.columns
    bad = docs.limit(1).withColumn("text", F.lit("123 !!!")).withColumn("doc_id", F.lit(99_999).cast("long")).select(*columns)
    docs = docs.unionByName(bad)
    counts = []
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "").cache()
        assert docs.columns == columns, name
        counts.append(docs.count())
        if name == "language":
            assert docs.where("doc_id = 99999").count() == 0
        if name == "near_duplicates":
            assert docs.select("doc_id").distinct().count() == docs.count()
    assert counts[0] == 200 and counts[1] < counts[0] and counts[2] == counts[1]
    packed = pipeline.STAGES[-1][1](spark, docs, "")
    assert packed.agg(F.sum("length")).first()[0] > 0


def test_stages_on_odd_rows(spark):
    """Null and repeated ids, one id with several texts, null, empty and long texts, columns named like internal ones."""
    import corpus_pipeline as pipeline

    passage, long = _words("passage", 50), _words("long", 30_000)
    rows = [
        (None, _words("a"), "en"), (None, _words("a"), "en"), (None, _words("b"), "en"), (1, _words("c"), "en"), (1, _words("d"), "en"), (2, _words("d"), None), (3, None, "en"),
        (4, "", "en"), (5, f"{_words('x', 90)} {passage}", "en"), (6, f"{_words('y', 90)} {passage} end", "en"), (7, long, "en"), (8, "123 !!!", None),
    ]
    table = _table(spark, rows)
    columns = table.columns
    lettered = pipeline.language(spark, table.withColumn("lang", F.lit(None).cast("string")), "")
    assert lettered.columns == columns and lettered.count() == 9  # nothing to learn from: all with letters stay
    kept = pipeline.language(spark, table, "")
    assert kept.columns == columns and {r.score for r in kept.collect()} == {0.5} and kept.where("doc_id = 8").count() == 0
    once = pipeline.near_duplicate(spark, table, "").cache()
    assert once.columns == columns
    left = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in once.collect())
    assert left == sorted((i if i is not None else -1, t or "") for i, t, _ in [rows[0], *rows[2:5], *rows[6:]])
    cut = pipeline.substring(spark, once, "").cache()
    assert cut.columns == columns
    by_id = {r.doc_id: r for r in cut.where("doc_id >= 3").collect()}
    assert by_id[5].text == _words("x", 90) + " " and by_id[6].text == _words("y", 90) + " end" and by_id[3].text is None and by_id[4].text == "" and by_id[7].text == long
    assert sorted(r.text for r in cut.where("doc_id = 1").collect()) == sorted((_words("c"), _words("d"))) and by_id[3].n_chars is None and by_id[5].n_chars == len(by_id[5].text)
    mixed = pipeline.mixing(spark, cut, "")
    assert mixed.columns == columns and set(mixed.select("doc_id").distinct().toPandas()["doc_id"].dropna()) <= {1, 3, 4, 5, 6, 7, 8}
    assert pipeline.packing(spark, cut, "").select("doc_id").distinct().count() == cut.select("doc_id").distinct().count()


def test_stages_on_no_rows(spark):
    import corpus_pipeline as pipeline

    for name, stage in pipeline.STAGES:
        assert stage(spark, _table(spark, []), "").count() == 0, name


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)
