"""The pipeline's stages against plain re-computation, and registered queries against SQL."""

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from check_queries import compare
from tradepanel.llm import best_fit, entries, line_crf, quality_rules


def test_stages_in_a_row(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "quality classifier", "n-gram Jaccard join", "best-fit packing"]
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, stage(spark, now, folder)
        if name != names[-1]:
            assert now.columns == docs.columns
        if name == names[0]:
            db = duckdb.connect()
            db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
            want = {r[0] for r in db.execute(f"SELECT doc_id FROM ({quality_rules.SQL}) WHERE kept").fetchall()}
            assert {r.doc_id for r in now.select("doc_id").collect()} == want
        if name == names[1]:
            good = line_crf.classify(before, spark.read.parquet(f"{folder}/labels.parquet")).where("predicted = 1")
            assert {r.doc_id for r in now.select("doc_id").collect()} == {r.doc_id for r in good.collect()}
        if name == names[2]:
            from test_text_operators import _classes

            rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
            want = {int(c) for _, _, c in _classes(rows)}
            assert sorted(r.doc_id for r in now.select("doc_id").collect()) == sorted(want)
    packed = now.collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in before.select("doc_id").collect()}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) for r in before.select("doc_id", "text").collect()}
    total = {}
    for r in packed:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == sizes and max(r.capacity for r in packed) <= max(best_fit.CAPACITIES)


def test_repeated_ids_stay_once(spark, folder):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "A b c d e f g"), (3, ""), (None, "a b c d e f g")]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_copies(spark, df, folder).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "3", "None"]


def test_repeated_ids_with_own_texts_stay(spark, folder):
    rows = [(1, "a b c d e f g"), (5, "A b c d e f g"), (5, "own words of this text here"), (6, "one two three four"), (6, "five six seven"),
            (7, "x y z u v w"), (7, "X y z u v w"), (8, ""), (8, "")]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id, (r.text or "").lower()) for r in corpus_pipeline.near_copies(spark, df, folder).collect())
    assert got == [
        (1, "a b c d e f g"), (5, "own words of this text here"), (6, "five six seven"), (6, "one two three four"), (7, "x y z u v w"), (8, "")
    ]


def test_every_operator_is_registered_once():
    names = list(__spark_entry__.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(entries.ORACLES))
def test_same_as_sql(spark, folder, name):
    df = entries.RUNNERS[name](spark, folder)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    result = db.sql(entries.ORACLES[name])
    order = sorted(result.columns)
    assert sorted(df.columns) == order
    right = [tuple(r[result.columns.index(c)] for c in order) for r in result.fetchall()]
    assert compare(order, [tuple(r[c] for c in order) for r in df.collect()], right) is None
