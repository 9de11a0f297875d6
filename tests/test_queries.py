"""Every registered query against its SQL in DuckDB, over the smallest tables."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

DATA = entry.SMALL
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"create view {name.split('.')[0]} as select * from read_parquet('{DATA}/{name}')")
    return con


def plain(v):
    return round(v, 6) + 0.0 if isinstance(v, float) else tuple(map(plain, v)) if isinstance(v, list | tuple) else v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, tables, name):
    made = entry.queries()[name](spark, DATA)
    found = tables.execute(entry.oracle_sql()[name])
    columns = sorted(made.columns)
    place = [[d[0] for d in found.description].index(c) for c in columns]
    want = [tuple(plain(r[i]) for i in place) for r in found.fetchall()]
    got = [tuple(plain(r[c]) for c in columns) for r in made.collect()]
    assert len(found.description) == len(columns)
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_entry(spark):
    assert entry.entry(spark).columns == ["i", "j", "iou", "coverage", "tier"]


HIDDEN = """
import importlib.abc, sys
class Hide(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.startswith({hidden!r}):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as e
print(sum(n.startswith("op") for n in e.queries()), "pipeline" in e.queries(), len(e.oracle_sql()) > 40)
"""


@pytest.mark.parametrize(("hidden", "ops", "pipeline"), [(("plinth.llm",), False, False), (("plinth.llm", "corpus_pipeline"), False, False), (("corpus_pipeline",), True, False)])
def test_entry_without_parts(hidden, ops, pipeline):
    done = subprocess.run([sys.executable, "-c", HIDDEN.format(hidden=hidden)], cwd=Path(entry.__file__).parent, capture_output=True, text=True, check=True)
    number, has_pipeline, _ = done.stdout.split()
    assert (int(number) > 0, has_pipeline == "True") == (ops and (Path(entry.__file__).parent / "plinth" / "llm").is_dir(), pipeline)
