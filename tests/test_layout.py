"""Test files differ in their base names, or pytest leaves one out."""

import pathlib
from collections import Counter


def test_base_names_differ():
    names = Counter(p.name for p in pathlib.Path(__file__).parent.rglob("test_*.py"))
    assert [n for n, times in names.items() if times > 1] == []
