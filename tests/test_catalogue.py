"""Every registered query against its SQL oracle on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from tallyforge.plans import catalogue
from tests.compare import connect, difference
from tests.conftest import DATA

# Queries of optional subpackages are tested beside those.
QUERIES = catalogue.QUERIES
ORACLES = catalogue.ORACLES


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    result = QUERIES[name](spark, DATA).toArrow()
    assert result.num_rows > 0
    if name in ORACLES:
        assert difference(result, duck.sql(ORACLES[name]).to_arrow_table()) is None
    spark.catalog.clearCache()


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    cells = contract.entry(spark).first()
    assert cells["tp"] + cells["tn"] == pytest.approx(1.0)
    assert cells["fp"] == cells["fn"] == 0.0


def test_queries_survive_a_missing_dependency_of_the_text_operators():
    code = (
        "import sys; sys.modules['public_tokenizers'] = None; sys.modules['tokenizers'] = None\n"
        "import __spark_entry__ as c\n"
        "from tallyforge.plans import catalogue\n"
        "assert set(c.queries()) == set(catalogue.QUERIES) and set(c.oracle_sql()) == set(catalogue.ORACLES)"
    )
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
