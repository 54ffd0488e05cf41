"""Every query beside its SQL, on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest

from catalog import ORACLES, QUERIES

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import difference


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, tables, sf_dir, name):
    rows = queries()[name](spark, sf_dir).toPandas()
    assert len(rows) > 0
    assert difference(rows, tables.sql(oracle_sql()[name]).df()) is None


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_gives_both_classes(spark):
    rows = entry(spark).collect()
    assert {r["label"] for r in rows} == {0.0, 1.0}
    assert sum(r["percentage"] for r in rows) == pytest.approx(100)


def test_every_query_here_has_an_oracle():
    """The document operators have tests of their own."""
    assert set(QUERIES) == set(ORACLES)


WITHOUT = """
import sys
class Without:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r}:
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Without())
import __spark_entry__
print(len(__spark_entry__.queries()))
"""


def import_without(missing):
    root = Path(__file__).resolve().parents[1]
    return subprocess.run([sys.executable, "-c", WITHOUT.format(missing=missing)], capture_output=True, text=True, cwd=root)


@pytest.mark.parametrize("missing", ["public_tokenizers", "xxhash", "corpus_pipeline", "tabwright.llm"])
def test_other_queries_stand_alone(missing):
    """Without a library of the document operators, or without them, the entry gives the rest."""
    done = import_without(missing)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout) == len(QUERIES)


def test_lost_modules_of_this_library_are_an_error():
    done = import_without("tabwright.scratch")
    assert done.returncode != 0 and "tabwright.scratch" in done.stderr
