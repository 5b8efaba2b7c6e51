"""The driver contract, with and without the training-data subpackage."""
import os

import __spark_entry__ as entry
import pytest

from lumenflow import session
from lumenflow.queries import all_queries


def test_entry_without_the_subpackage(monkeypatch):
    monkeypatch.setattr(entry, "_optional", lambda module: None)
    assert entry.queries() == all_queries()
    assert set(entry.oracle_sql()) == set(all_queries())


def test_modules_that_do_not_import_are_left_out(tmp_path, monkeypatch):
    (tmp_path / "half_there.py").write_text("import nothing.at.all\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    assert entry._optional("lumenflow.nothing") is None and entry._optional("half_there") is None
    assert entry._optional("lumenflow.queries").all_queries is all_queries


def test_intermediates_are_removed(spark):
    with session.intermediates(spark):
        table = session.materialize(spark.range(5), "owned")
        path = table.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert table.count() == 5 and os.path.isdir(path)
    assert not os.path.exists(path)
    assert session.materialize(spark.range(5), "kept").count() == 5


def test_the_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    class Other:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})()
        sparkContext = type("S", (), {"master": "spark://host:7077", "getConf": staticmethod(lambda: Other.conf)})()
    with pytest.raises(RuntimeError):
        session.shared_dir(Other())
