"""The entry's core queries are there whether or not the training-data operators can be imported."""

import builtins
import sys

import __spark_entry__ as entry
from ledgerline.plans import catalog


def test_core_queries_without_a_library_of_the_operators(monkeypatch):
    real = builtins.__import__

    def missing(name, *args, **more):
        if name.split(".")[0] == "numpy":
            raise ImportError(name)
        return real(name, *args, **more)

    for name in [m for m in sys.modules if m.startswith("ledgerline.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", missing)
    assert entry.queries().keys() == catalog.queries().keys()
    assert entry.oracle_sql().keys() == catalog.oracle_sql().keys()
