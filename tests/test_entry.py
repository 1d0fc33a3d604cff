import __spark_entry__ as E
from tessera.plans import catalog, catalog_more

ALL = {**catalog.QUERIES, **catalog_more.QUERIES}
ORACLE = {**catalog.ORACLE, **catalog_more.ORACLE}

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["source", "n_chunks", "n_chars"]


def test_every_catalog_query_has_an_oracle():
    assert set(ALL) == set(ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_queries_match_their_oracles(spark):
    """Row sets, column names and values on the smallest tables."""
    import duckdb

    from tools.check_oracle import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, fn in ALL.items():
        df = fn(spark, SF)
        rel = con.execute(ORACLE[name])
        want = rows_of([d[0] for d in rel.description], rel.fetchall())
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want, name
        assert want[0], name


def test_no_round_robin_shuffle_in_any_plan(spark):
    for name in ("blank_filter", "byte_encode", "render_chat", "prepare_corpus", "vector_lookup", "masked_loss"):
        plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobinPartitioning" not in plan, name


def test_runs_without_the_optional_subpackage(tmp_path):
    """A copy without the llm folders and the pipeline still imports."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    shutil.copytree(os.path.join(root, "tessera"), tmp_path / "tessera", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; assert len(e.queries()) > 30 and not any(q.startswith('op') for q in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
