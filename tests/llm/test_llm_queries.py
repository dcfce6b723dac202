"""The registered queries against SQL, and the pipeline's stages on edge cases."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import corpus_pipeline  # noqa: E402
from oracle_compare import compare, connect  # noqa: E402

from skygalley.llm import language, registry  # noqa: E402

TABLES = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, TABLES), connect(TABLES), ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_gives_every_row(spark, name):
    df = QUERIES[name](spark, TABLES)
    if name == "op3_nearest_neighbours":
        asked = spark.read.parquet(f"{TABLES}/embeddings.parquet").where("vec_id % 100 = 0").count()
        assert df.count() == 10 * asked
    else:
        docs = spark.read.parquet(f"{TABLES}/documents.parquet")
        assert df.select("doc_id").distinct().count() == docs.count()


CLASH = "doc_id long, text string, lang string, kept_text string, n_removed long, score double, c0 int, row_id int"
PASSAGE = " ".join(f"passage{i}" for i in range(25))


def edge_docs(spark):
    en = "the thing and the other thing in the house of the king with the queen"
    rows = [
        (1, en + " one " + PASSAGE, "en"),
        (2, en + " two " + PASSAGE + " after", "en"),
        (3, en + " two " + PASSAGE + " AFTER", "en"),
        (4, None, "en"),
        (5, "", None),
        (6, "123 ...", "en"),
        (7, en, "en"),
        (7, en, "en"),
        (None, en + " three", None),
    ]
    return spark.createDataFrame([(*r, None, 5, 0.5, 1, 2) for r in rows], CLASH)


def test_stages_keep_columns(spark):
    docs = edge_docs(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, TABLES)
        assert out.columns == docs.columns, name
        assert out.schema == docs.schema or [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert stage(spark, docs.limit(0), TABLES).count() == 0


def test_stages_decide(spark, tmp_path):
    docs = edge_docs(spark)
    path = str(tmp_path / "docs")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    stage = dict(corpus_pipeline.STAGES)
    known = stage["language_id"](spark, docs, TABLES)
    assert not {4, 5, 6} & {r["doc_id"] for r in known.collect()}
    exact = sorted(str(r["doc_id"]) for r in stage["exact_dedup"](spark, docs, TABLES).collect())
    assert exact == ["1", "3", "5", "6", "7", "None"]
    near = sorted(str(r["doc_id"]) for r in stage["near_dedup"](spark, docs, TABLES).collect())
    assert "3" not in near and "1" in near
    cut = {(r["doc_id"], r["text"]) for r in stage["substring_dedup"](spark, docs, TABLES).collect()}
    assert next(t for i, t in cut if i == 2).endswith("two after")
    assert (1, docs.where("doc_id = 1").first()["text"]) in cut and (4, None) in cut


def test_pipeline_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    before = docs.count()
    known = corpus_pipeline.language_id(spark, docs, TABLES)
    assert known.count() >= 0.95 * before
    run = corpus_pipeline.run(spark, TABLES)
    assert run.where(F.col("length") > 1024).count() == 0
    assert run.select("doc_id").distinct().count() <= before


RARE = {
    "el": ["Η γρήγορη αλεπού πηδά πάνω από το σκυλί", "Το σπίτι είναι κοντά στη θάλασσα", "Σήμερα έχει καλό καιρό"],
    "fi": ["Nopea kettu hyppää laiskan koiran yli", "Talo on lähellä merta ja metsää"],
    "ja": ["速い狐は怠け者の犬を飛び越える", "家は海の近くにあります"],
}


def test_language_id_keeps_rare_languages(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text", "lang")
    learned = [r[0] for r in spark.range(900_000, 900_100).where(~language.held_out(F.col("id"))).collect()]
    labelled = [(t, k) for k, v in RARE.items() for t in v]
    rows = [(learned[i], t, k) for i, (t, k) in enumerate(labelled)]
    unlabelled = [(900_200, "நாய் வேகமாக ஓடுகிறது", None), (900_201, "123 ...", None), (900_202, None, "el")]
    docs = docs.union(spark.createDataFrame([*rows, *unlabelled], "doc_id long, text string, lang string"))
    found = language.identify(docs, language.learn(docs), carry=["lang"]).where("doc_id >= 900000").collect()
    got = {r["doc_id"]: r for r in found}
    assert all(got[i]["lang_pred"] == k and got[i]["score"] > 0.5 for i, _, k in rows)
    kept = corpus_pipeline.language_id(spark, docs, TABLES).where("doc_id >= 900000")
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _, _ in rows} | {900_200}


def test_exact_dedup_numbers_rows_once(spark, tmp_path):
    edge_docs(spark).write.parquet(str(tmp_path / "docs"))
    kept = corpus_pipeline.exact_dedup(spark, spark.read.parquet(str(tmp_path / "docs")), TABLES)
    assert "monotonically_increasing_id() AS _row_id" not in kept._jdf.queryExecution().toString()
    assert kept.count() == 6
