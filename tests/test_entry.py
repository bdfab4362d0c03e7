"""The entry point with and without the corpus part."""

import importlib
import sys

import pytest

CORPUS = "shelfscan.llm"


def fresh_entry(monkeypatch, hidden: tuple[str, ...]):
    """The entry module as imported anew while the hidden modules cannot be imported."""
    for name in list(sys.modules):
        if name in ("__spark_entry__", "corpus_pipeline") or name.startswith(CORPUS):
            monkeypatch.delitem(sys.modules, name)
    for name in hidden:
        monkeypatch.setitem(sys.modules, name, None)
    return importlib.import_module("__spark_entry__")


@pytest.mark.parametrize("hidden", [(CORPUS,), ("xxhash",), (CORPUS, "corpus_pipeline")])
def test_entry_without_the_corpus_part(monkeypatch, hidden):
    entry = fresh_entry(monkeypatch, hidden)
    found = entry.queries()
    assert "ttm_sales" in found and "pipeline" not in found
    assert not [name for name in found if name.startswith("op")]
    assert set(entry.oracle_sql()) <= set(found)
    monkeypatch.undo()
    sys.modules.pop("__spark_entry__", None)


def test_entry_of_this_checkout(monkeypatch):
    entry = fresh_entry(monkeypatch, ())
    assert set(entry.oracle_sql()) <= set(entry.queries())
