"""The pipeline's stages on the smallest tables and on edge rows; registered queries and their twins."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from constella.llm import bpe, decontaminate, language, near
from constella.llm.queries import ORACLE, QUERIES
from tests.llm.cases import EDGE_TEXTS, HAVE_TABLES, SF, documents
from tools.oracle_check import TABLES, digest

needs_tables = pytest.mark.skipif(not HAVE_TABLES, reason="test tables not present")


def test_stages_survive_edge_rows(spark, tmp_path):
    spark.createDataFrame([(1, "one two three")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        empty = stage(spark, documents(spark).limit(0), str(tmp_path))
        assert empty.count() == 0
        if name != "bpe":
            assert out.columns == docs.columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    assert 0 < docs.count() < len(EDGE_TEXTS)


@needs_tables
def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    scorer = language.Scorer(language.learn(language.training_rows(docs)))
    stages = dict(corpus_pipeline.STAGES)

    spoken = stages["language"](spark, docs, SF).cache()
    keep = [r.doc_id for r in docs.collect() if scorer.predict(r.text)[0] != language.UNKNOWN]
    assert sorted(r.doc_id for r in spoken.collect()) == sorted(keep)

    unique = stages["near_duplicates"](spark, spoken, SF).cache()
    idf = near.idf_table(spoken.select("text"), 0.25)
    rows = sorted((r.doc_id, r.text) for r in spoken.collect())
    weighed = [near.weigh(t, idf) for _, t in rows]
    groups, left = [], set(range(len(rows)))
    while left:
        group, border = set(), [left.pop()]
        while border:
            a = border.pop()
            group.add(a)
            close = {b for b in left if rows[a][1] == rows[b][1]
                     or near.weighted_jaccard(weighed[a], weighed[b]) >= near.SIMILARITY - 1e-6}
            left -= close
            border += close
        groups.append({rows[i][0] for i in group})
    kept = {r.doc_id for r in unique.collect()}
    assert all(len(g & kept) == 1 for g in groups) and len(kept) == len(groups)

    clean = stages["decontaminate"](spark, unique, SF).cache()
    index = decontaminate.build_index(decontaminate.windows_of(items))
    def bad(text):
        n, spans, _ = decontaminate.find(text, index)
        hit = sum(b - a for a, b in spans)
        return hit > 0 and 20 * hit >= n
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in unique.collect() if not bad(r.text))

    masked = stages["secrets"](spark, clean, SF).cache()
    assert masked.count() == clean.count()
    coded = stages["bpe"](spark, masked, SF).collect()
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert all(bytes(r.ids) == bpe.codec().encode(texts[r.doc_id]) for r in coded)
    assert len(coded) == corpus_pipeline.run(spark, SF).count()


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(columns, cur.fetchall())[0]


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
