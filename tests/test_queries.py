"""Every registered query against its oracle SQL, and the entry points."""

import subprocess
import sys
from pathlib import Path

import pytest
from checks.compare import differences, oracle
from checks.queries import ORACLE, QUERIES

import __spark_entry__ as entry_points


#: Queries that find nothing in the smallest tables.
LARGER = {"multi_org_tenants"}


@pytest.fixture(scope="module")
def connections():
    from conftest import SF_DIR

    return {folder: oracle(folder) for folder in (SF_DIR, SF_DIR.replace("sf0.001", "sf0.01"))}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf_dir, connections, name):
    folder = sf_dir.replace("sf0.001", "sf0.01") if name in LARGER else sf_dir
    assert differences(spark, folder, name, connections[folder]) is None


def test_entry_points(spark):
    assert entry_points.queries().keys() >= entry_points.oracle_sql().keys() >= ORACLE.keys()
    frame = entry_points.entry(spark)
    assert frame.columns == ["tenant_code", "api_year", "name", "last_version", "newest_version", "n"]
    assert not frame.isEmpty()


WITHOUT = """
import sys

class Refuse:
    def find_spec(self, name, path=None, target=None):
        if name == "{gone}" or name.startswith("{gone}."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Refuse())
import __spark_entry__ as entry
from checks.queries import ORACLE, QUERIES
assert entry.queries().keys() >= QUERIES.keys() and entry.oracle_sql().keys() >= ORACLE.keys()
print(len(entry.queries()) - len(QUERIES), "pipeline" in entry.queries())
"""


@pytest.mark.parametrize("gone", ["tidemark.llm", "corpus_pipeline"])
def test_entry_points_without_the_training_data_parts(gone):
    """Each is taken out by itself; with the subpackage there is no pipeline either."""
    root = Path(entry_points.__file__).parent
    ran = subprocess.run([sys.executable, "-c", WITHOUT.format(gone=gone)], cwd=root, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    more, pipeline = ran.stdout.split()[-2:]
    assert pipeline == "False" and (more == "0") == (gone == "tidemark.llm" or not (root / "tidemark" / "llm").exists())
