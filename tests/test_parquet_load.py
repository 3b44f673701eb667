"""Parquet loads on small hand-made areas."""

import pytest

from quayside.plans.loading import Tiers
from quayside.plans.parquet_load import ParquetLoader, wider


@pytest.fixture
def tiers(tmp_path):
    (tmp_path / "raw").mkdir()
    return Tiers.under(str(tmp_path), str(tmp_path / "raw"))


def put(tiers, name, frame):
    """The frame as one file of this name."""
    frame.toPandas().to_parquet(f"{tiers.raw}/{name}", index=False)


def counts(summary):
    return summary.first().asDict()


def test_load_and_load_again(spark, tiers, rows):
    put(tiers, "a b%20+.parquet", spark.createDataFrame([(1, "x")], "id bigint, v string"))
    put(tiers, "c.parquet", spark.createDataFrame([(2, "y")], "id bigint, v string"))
    with open(f"{tiers.raw}/note.txt", "w") as note:
        note.write("no data")
    loader = ParquetLoader(spark, tiers, "t")
    assert counts(loader.run()) == {"found": 2, "processed": 2, "skipped": 0, "failed": 0, "logged": 2}
    assert counts(loader.run()) == {"found": 2, "processed": 0, "skipped": 2, "failed": 0, "logged": 2}
    assert rows(loader.table("t"), "id", "v") == [(1, "x"), (2, "y")]
    sources = {r["_source"] for r in loader.table("t").collect()}
    assert sources == {r["source"] for r in loader.log.processed().collect()}


def test_bad_files_do_not_stop_the_others(spark, tiers, rows):
    put(tiers, "a.parquet", spark.createDataFrame([(1, "x")], "id bigint, v string"))
    put(tiers, "b.parquet", spark.createDataFrame([("one", "x")], "id string, v string"))
    with open(f"{tiers.raw}/c.parquet", "wb") as broken:
        broken.write(b"PAR1 not really")
    loader = ParquetLoader(spark, tiers, "t")
    assert counts(loader.run()) == {"found": 3, "processed": 1, "skipped": 0, "failed": 2, "logged": 1}
    assert rows(loader.table("t"), "id", "v") == [(1, "x")]
    errors = {r["source_name"]: r["error"] for r in loader.log.outcomes().where("status = 'failed'").collect()}
    assert errors["b.parquet"] == "id: string does not fit bigint"


@pytest.mark.parametrize("merge", [True, False])
def test_new_columns(spark, tiers, rows, merge):
    loader = ParquetLoader(spark, tiers, "t", merge_schema=merge)
    put(tiers, "a.parquet", spark.createDataFrame([(1,)], "id bigint"))
    loader.run()
    put(tiers, "b.parquet", spark.createDataFrame([("n", 2)], "extra string, id int"))
    assert counts(loader.run())["processed"] == int(merge)
    if merge:
        assert rows(loader.table("t"), "id", "extra") == [(1, None), (2, "n")]
    else:
        assert loader.table("t").columns == ["load_id", "id", "_source"]


def test_small_portions_take_everything(spark, tiers):
    for i in range(9):
        put(tiers, f"{i}.parquet", spark.createDataFrame([(i,)], "id bigint"))
    loader = ParquetLoader(spark, tiers, "t", files_per_load=2)
    assert counts(loader.run()) == {"found": 9, "processed": 9, "skipped": 0, "failed": 0, "logged": 9}
    assert sorted(r["id"] for r in loader.table("t").collect()) == list(range(9))
    assert len({r["load_id"] for r in loader.table("t").collect()}) > 1


def test_crash_before_the_log(spark, tiers, monkeypatch):
    put(tiers, "a.parquet", spark.createDataFrame([(1,)], "id bigint"))
    loader = ParquetLoader(spark, tiers, "t")
    with monkeypatch.context() as patch:
        patch.setattr(loader.log, "write_outcomes", lambda *_: None)
        loader.run()
    loader.run()
    assert loader.table("t").count() == 1


def test_wider():
    assert wider("int", "bigint") == "bigint"
    assert wider("double", "float") == "double"
    assert wider("string", "string") == "string"
    assert wider("bigint", "double") is None
