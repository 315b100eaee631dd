"""The registered corpus queries against SQL, and the pipeline against plain loops."""

import os

import pytest
from oracle import connect, differences

import corpus_pipeline
from evenkeel.llm import catalog, check_sql

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(check_sql.SQL))
def test_query_matches_sql(spark, name):
    assert differences(catalog.QUERIES[name](spark, FOLDER), connect(FOLDER), check_sql.SQL[name]) == []


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = stages["exact dedup"](spark, docs, FOLDER)
    assert kept.columns == docs.columns
    bare = {}
    for i, t in texts.items():
        key = "".join(c for c in t or "" if c not in " \t\n\x0b\f\r")
        bare.setdefault(key, []).append((-len(t or ""), i))
    assert {r.doc_id for r in kept.collect()} == {min(v)[1] for v in bare.values()}
    clean = stages["benchmark decontamination"](spark, docs, FOLDER)
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = [" ".join((r.text or "").split()) for r in clean.collect()]
    assert not any(item in text for item in items for text in left) and len(left) > 0.8 * len(texts)


def test_run_keeps_good_documents(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "text", "lang", "source", "n_chars", "copy"} <= set(out.columns)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    assert out.join(labels.where("quality = 0"), "doc_id").count() <= 0.1 * out.count()


LONG = "lorem ipsum dolor sit amet " * 50_000


def test_exact_stage_with_repeated_rows(spark):
    """Equal rows leave one, an id with two texts is decided by text, null ids stay as they are."""
    rows = [(1, "a b"), (1, "a b"), (1, "a  b"), (2, "ab"), (2, "c"), (3, "c"), (4, None), (5, " "), (6, LONG)]
    rows += [(6, LONG), (7, LONG), (None, "d"), (None, "d")]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, size int, kept string")
    kept = dict(corpus_pipeline.STAGES)["exact dedup"](spark, docs, FOLDER)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or -1, (r.text or "").replace(" ", "")) for r in kept.collect())
    bare = LONG.replace(" ", "")
    assert got == [(-1, "d"), (-1, "d"), (1, "ab"), (2, "c"), (5, ""), (6, bare)]


def stored(spark, folder, rows, labels, benchmark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, size string, kept boolean"
    docs = [(i, t, None, s, len(t or ""), "x", None) for i, t, s in rows]
    spark.createDataFrame(docs, kind).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_run_over_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, stored(spark, tmp_path, [], [], [])).count() == 0


def test_run_over_odd_rows(spark, tmp_path):
    """Nulls, long and repeated texts, ties and clashing columns: one row per distinct text stays."""
    rows = [(1, None, "a"), (2, "", None), (3, "one two three", "a"), (3, "one two three", "a")]
    rows += [(4, "one  two three", "b"), (5, LONG, "b"), (6, LONG, None), (None, "no id", "a")]
    out = corpus_pipeline.run(spark, stored(spark, tmp_path, rows, [], [(1, None), (2, "")]))
    ids = {r.doc_id for r in out.collect()}
    # Without labels nothing is rejected; a text without words adds nothing to a mix.
    assert {"size", "kept", "copy"} <= set(out.columns) and ids - {1, 2} <= {4, 5} and 4 in ids
