import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__

BASE = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
OWN = [n for n in __spark_entry__.oracle_sql() if not n.startswith("op") and n != "pipeline"]
#: One query of each family; the driver runs all of them.
CHECKED = [n for k, n in enumerate(OWN) if k % 4 == 0 or n[0] in "JP"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{BASE}/{t}.parquet'")
    return con


def plain(rows):
    return sorted((tuple(round(float(v), 5) if isinstance(v, float) or type(v).__name__ == "Decimal" else v for v in r) for r in rows), key=repr)


@pytest.mark.skipif(not os.path.isdir(BASE), reason="needs the driver's tables")
@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, BASE)
    names = sorted(df.columns)
    rel = duck.execute(__spark_entry__.oracle_sql()[name])
    columns = [c[0] for c in rel.description]
    assert sorted(columns) == names
    at = [columns.index(c) for c in names]
    assert plain([tuple(r) for r in df.select(*names).collect()]) == plain([tuple(r[i] for i in at) for r in rel.fetchall()])


@pytest.mark.skipif(not os.path.isdir(BASE), reason="needs the driver's tables")
def test_entry(spark):
    assert __spark_entry__.entry(spark).count() >= 0


def test_imports_without_the_optional_part(tmp_path):
    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    shutil.copytree(f"{root}/quillspark", tmp_path / "quillspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)


def test_imports_without_a_library_of_the_optional_part():
    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
