import pytest

import __spark_entry__ as E
from conftest import SF01
from oracle_check import compare, duckdb_connection


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["airport_code", "airport_name", "year", "month", "arrivals"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF01)


@pytest.mark.parametrize("name", list(E.QUERIES))
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF01, con)
    assert result["ok"], result
    assert result["exact"], result


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys

    from bench import HEADLINE

    assert set(HEADLINE) <= set(E.queries())
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_QUERIES="date_dim", BENCH_RUNS="1",
               BENCH_CPUS="2")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, cwd=root)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and set(result["queries"]) == {"date_dim"} and result["sf"] == "0.001"


def test_other_queries_stand_without_the_optional_subpackage():
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = """
import sys

class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("arrivals_mart.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name, name=name)

sys.meta_path.insert(0, Gone())
import __spark_entry__ as E
assert set(E.queries()) == set(E.QUERIES) and set(E.oracle_sql()) == set(E.QUERIES)
"""
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
