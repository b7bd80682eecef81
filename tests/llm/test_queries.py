"""The registered queries against their SQL; the entry point without this subpackage."""

import subprocess
import sys
from pathlib import Path

import pytest

from roadloom.llm.queries import ORACLES, QUERIES

ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, compare, name):
    compare(spark, QUERIES[name], ORACLES[name])


def test_all_ten():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_entry_without_subpackage(tmp_path):
    for p in ["roadloom", "__spark_entry__.py"]:
        (tmp_path / p).symlink_to(ROOT / p) if p.endswith(".py") else None
    package = tmp_path / "roadloom"
    package.mkdir()
    for p in (ROOT / "roadloom").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (package / p.name).symlink_to(p)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(n.startswith('op1') for n in q) and len(q) > 100; print('fine')"
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    got = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert got.stdout.strip().endswith("fine"), got.stderr
