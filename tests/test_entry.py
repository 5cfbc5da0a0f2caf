"""The driver contract."""

import __spark_entry__ as entry


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 45


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns and df.count() > 0


def test_nothing_else_imports_the_optional_subpackage():
    import pathlib
    import re

    root = pathlib.Path(entry.__file__).parent
    for p in (root / "foliant").rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"^\s*(from|import)\s+foliant\.llm", p.read_text("utf-8"), re.M), p
