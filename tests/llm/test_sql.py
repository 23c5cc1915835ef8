"""Queries beside their SQL, over the whole small tables."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2] / "tools"))
compare = pytest.importorskip("compare")

from folioweave.llm.catalogue import ORACLES, QUERIES  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not pathlib.Path(DATA).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, monkeypatch, name):
    monkeypatch.setitem(compare.QUERIES, name, QUERIES[name])
    monkeypatch.setitem(compare.ORACLES, name, ORACLES[name])
    fine, note = compare.compare(spark, compare.duck(DATA), DATA, name)
    assert fine, note
