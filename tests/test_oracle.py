"""Driver gate: every query of the library equals its DuckDB SQL at sf0.01."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from bazaar.plans import bindings, oracle
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(bindings.QUERIES))
def test_query_matches_oracle(spark, con, name):
    sql = entry.oracle_sql().get(name)
    assert sql is not None, "every query has oracle SQL"
    r = compare(spark, con, name, entry.queries()[name], sql, SF)
    assert r["status"] == "ok", r


def test_sql_needs_no_jvm_and_no_jars():
    code = ("import zipfile\n"
            "def no(*a, **k): raise OSError('no archives here')\n"
            "zipfile.ZipFile = no\n"
            "import __spark_entry__ as e\n"
            "from bazaar.plans import bindings\n"
            "assert set(bindings.QUERIES) <= set(e.oracle_sql())")
    env = {k: v for k, v in os.environ.items() if k not in ("JAVA_HOME", "SPARK_HOME")}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, env=env | {"JAVA_HOME": "/nonexistent", "PATH": "/usr/bin"})


def test_one_failing_entry_hides_no_other(monkeypatch):
    want = set(oracle.oracle_sql()) - {"clean_text", "lexicon_polarity", "sentiment", "review_sentiment",
                                       "learned_lexicon", "held_out_sentiment"}

    def broken(text):
        raise FileNotFoundError("no list")

    monkeypatch.setattr(oracle, "_clean_sql", broken)
    with pytest.warns(UserWarning, match="no list"):
        assert set(oracle.oracle_sql()) == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "month", "at_time", "no_at_time", "first", "last"]
    assert df.count() > 0
