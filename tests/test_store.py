"""The published star schema: what it was built from, who reads it, and what it leaves behind."""

from __future__ import annotations

import shutil

import pytest

from martlens.plans import bank, store
from martlens.plans.gold import COLUMN_COMMENTS, TABLE_COMMENTS, Gold
from martlens.plans.parameters import TABLE_PARAMETERS
from martlens.sources import files
from martlens.sources.catalog import column_comments
from tests.conftest import SMALL


@pytest.fixture
def raw_copy(tmp_path):
    target = tmp_path / "raw"
    shutil.copytree(SMALL, target, copy_function=shutil.copyfile)
    target.chmod(0o755)
    return target


def total(gold: Gold) -> float:
    return bank.net_amount_total(gold, TABLE_PARAMETERS).first()[0]


def test_changed_raw_files_are_noticed(spark, raw_copy, tmp_path):
    folder = f"{tmp_path}/store"
    with pytest.raises(store.StaleStore):
        store.open_store(spark, str(raw_copy), folder)
    before = total(store.build_store(spark, str(raw_copy), folder).gold)
    assert total(store.open_store(spark, str(raw_copy), folder).gold) == before
    spark.read.parquet(f"{SMALL}/lineitem.parquet").limit(100).write.parquet(str(tmp_path / "few"))
    (part,) = [p for p in (tmp_path / "few").iterdir() if p.name.startswith("part-")]
    (raw_copy / "lineitem.parquet").unlink()
    shutil.copyfile(part, raw_copy / "lineitem.parquet")
    with pytest.raises(store.StaleStore):
        store.open_store(spark, str(raw_copy), folder)
    assert total(store.open_gold(spark, str(raw_copy), folder)) < before


def test_a_build_without_its_last_step_is_not_opened(spark, tmp_path, monkeypatch):
    folder = f"{tmp_path}/store"

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(files, "publish_text", fail)
    with pytest.raises(OSError):
        store.build_store(spark, SMALL, folder)
    monkeypatch.undo()
    with pytest.raises(store.StaleStore):
        store.open_store(spark, SMALL, folder)


def test_a_published_version_is_built_once(spark, tmp_path, monkeypatch):
    folder = f"{tmp_path}/store"
    built = store.build_store(spark, SMALL, folder)
    monkeypatch.setattr(store, "build_store", None)
    assert store.open_gold(spark, SMALL, folder).fact_orders.count() == built.written_rows["fact_orders"] == 4599
    assert store.open_index(spark, SMALL, folder).count() == built.written_rows[store.INDEX]


def test_each_session_reads_with_its_own_settings(spark, gold):
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "3")
    own = store.open_gold(other, SMALL)
    assert own.fact_orders.sparkSession.conf.get("spark.sql.shuffle.partitions") == "3"
    assert gold.fact_orders.sparkSession.conf.get("spark.sql.shuffle.partitions") == "8"


def test_no_table_in_the_callers_catalog(spark, gold):
    assert [t.name for t in spark.catalog.listTables("default") if not t.isTemporary] == []


def test_comments_and_counts_are_published(spark):
    found = store.ready_store(spark, SMALL)
    assert found.comments == TABLE_COMMENTS
    for name in Gold.names():
        assert column_comments(found.gold.table(name)) == COLUMN_COMMENTS[name]
        assert found.gold.table(name).count() == found.written_rows[name]
