"""The entry module without the corpus subpackage, or with one that can't be imported."""
import builtins
import sys
import types

import pytest

import __spark_entry__ as E


def check_rest():
    names = set(E.queries())
    assert len(names) > 250 and not any(n.startswith("op") or n == "pipeline" for n in names)
    assert set(E.oracle_sql()) <= names


def forget(monkeypatch):
    for name in [m for m in sys.modules if m == "strata.llm" or m.startswith("strata.llm.")]:
        monkeypatch.delitem(sys.modules, name)
    import strata

    monkeypatch.delattr(strata, "llm", raising=False)


@pytest.mark.parametrize("missing", ["strata.llm", "zstandard"])
def test_entry_works_without_a_module(monkeypatch, missing):
    """The subpackage is gone, or a package that it needs is."""
    real = builtins.__import__

    def absent(name, *a, **k):
        if name == missing or name.startswith(missing + "."):
            raise ModuleNotFoundError(f"No module named {name!r}")
        return real(name, *a, **k)

    forget(monkeypatch)
    monkeypatch.setattr(builtins, "__import__", absent)
    check_rest()


def test_entry_works_with_a_leftover_folder(monkeypatch, tmp_path):
    """A folder without modules, as deleting the sources may leave."""
    forget(monkeypatch)
    leftover = types.ModuleType("strata.llm")
    leftover.__path__ = [str(tmp_path)]
    monkeypatch.setitem(sys.modules, "strata.llm", leftover)
    check_rest()
