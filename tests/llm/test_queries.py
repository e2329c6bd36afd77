import ast
import importlib
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ordertide.llm import queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted((tuple(r[n] for n in names) for r in df.collect()), key=str) == sorted(map(tuple, cur.fetchall()), key=str)


def test_stages_against_brute_force(spark, tmp):
    """Every stage's result on its predecessor's, and the run's rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns = docs.columns
    results = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert name == "source_mixing" or out.columns == columns
        out.write.parquet(f"{tmp}/{name}")
        docs = spark.read.parquet(f"{tmp}/{name}")
        results.append(docs.collect())
    start, good, lines, unlike, clean, mixed = results
    kept = {r.doc_id for r in good}
    assert not any(brute.quality(r.text)[-1] for r in good) and good
    assert all(brute.quality(r.text)[-1] or brute.quality(r.text)[2] > 0 or " | " in r.text for r in start if r.doc_id not in kept)
    assert {r.doc_id: r.text for r in lines} == brute.without_repeated_chunks([(r.doc_id, r.text) for r in good])
    groups = brute.groups([(r.doc_id, r.text) for r in lines], 5, 80)
    assert {r.doc_id for r in unlike} == {c for _, _, c in groups}
    hit = {h[0] for h in brute.hits([(r.doc_id, r.text) for r in unlike], items) if h[-1]}
    assert {r.doc_id for r in clean} == {r.doc_id for r in unlike} - hit
    texts = {r.doc_id: r.text for r in clean}
    assert mixed and all(texts[r.doc_id] == r.text and 1 <= r.copy <= 3 for r in mixed)
    assert sorted(corpus_pipeline.run(spark, SF).collect()) == sorted(mixed)


def test_entry_works_without_the_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith(("ordertide.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "ordertide.llm", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    bare = importlib.import_module("__spark_entry__")
    assert "store_metrics_5m" in bare.queries() and "pipeline" not in bare.queries()


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path

    root = Path(entry.__file__).parent
    for f in (root / "ordertide").rglob("*.py"):
        if "llm" not in f.parts:
            names = [getattr(n, "module", None) or "" for n in ast.walk(ast.parse(f.read_text())) if isinstance(n, ast.ImportFrom)]
            names += [a.name for n in ast.walk(ast.parse(f.read_text())) if isinstance(n, ast.Import) for a in n.names]
            assert not any("llm" in n or "corpus_pipeline" in n for n in names)
