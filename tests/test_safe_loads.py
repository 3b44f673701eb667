"""Loads that must not lose, mix or overwrite rows, whatever names and jobs meet."""

import pytest
from pyspark.errors import StreamingQueryException

from quayside.operators.audit import commit_history
from quayside.operators.path_rewrite import write_text_objects
from quayside.plans.archive_load import ArchiveLoader
from quayside.plans.loading import LOG_FOLDER
from quayside.sources.archives import CsvFormat, column_names
from quayside.sources.text_objects import read_text_objects
from quayside.streaming.archive_stream import start_archive_stream
from test_archive_load import area, counts, statuses  # noqa: F401


def test_streams_with_other_checkpoints_add_to_a_table(spark, area, rows, tmp_path):  # noqa: F811
    area.csv("a.zip", "id\n1\n2\n")
    loader = ArchiveLoader(spark, area.tiers, table="t")
    start_archive_stream(loader, str(tmp_path / "first"), "load").awaitTermination()
    area.csv("b.zip", "id\n3\n")
    start_archive_stream(loader, str(tmp_path / "second"), "load").awaitTermination()
    assert rows(loader.table("t"), "id") == [(1,), (2,), (3,)]
    assert statuses(loader) == {"a.zip": "processed", "b.zip": "processed"}


@pytest.mark.parametrize("header", ["source,record,key", "x,x,x0", "SOURCE,Line,text"])
def test_common_column_names_load(spark, area, header):  # noqa: F811
    area.csv("a.zip", f"{header}\n1,2,3\n")
    loader = ArchiveLoader(spark, area.tiers, table="t")
    assert counts(loader.run())["processed"] == 1
    assert sorted(v for k, v in loader.table("t").first().asDict().items() if k not in ("_source", "load_id")) == [1, 2, 3]


@pytest.mark.parametrize("name", ["load_id", "_Source"])
def test_reserved_names_fail_their_file_only(spark, area, rows, name):  # noqa: F811
    area.csv("a.zip", f"id,{name}\n1,web\n")
    area.csv("b.zip", "id\n2\n")
    loader = ArchiveLoader(spark, area.tiers, table="t")
    loader.run()
    assert statuses(loader) == {"a.zip": "failed", "b.zip": "processed"}
    area.csv("c.zip", "id\n3\n")
    loader.run()
    assert rows(loader.table("t"), "id") == [(2,), (3,)]


def test_header_names_are_unique():
    assert column_names(["x", "x", "x0", "", "_C3"]) == ["x0_", "x1", "x0", "_c3_", "_C3"]


def test_a_job_replays_its_own_loads_only(spark, area, rows, monkeypatch):  # noqa: F811
    area.csv("a.zip", "имя\nЖук\n")
    typed = ArchiveLoader(spark, area.tiers, table="t")
    with monkeypatch.context() as patch:
        patch.setattr(typed.log, "write_outcomes", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            typed.run()
    other = ArchiveLoader(spark, area.tiers, CsvFormat.all_text(), table="u")
    summary = counts(other.run())
    assert summary["processed"] == 1 and summary["found"] == 1
    assert counts(typed.run())["processed"] == 1
    assert rows(typed.table("t"), "`имя`") == [("Жук",)]


def test_the_log_cannot_be_a_table(spark, area, rows):  # noqa: F811
    area.csv("Журнал_load_log.zip", "id\n1\n")
    loader = ArchiveLoader(spark, area.tiers)
    loader.run()
    target = loader.log.processed().first()["target_table"]
    assert target.startswith(LOG_FOLDER + "_") and rows(loader.table(target), "id") == [(1,)]
    with pytest.raises(ValueError):
        ArchiveLoader(spark, area.tiers, table=LOG_FOLDER)


def test_names_with_one_short_hash_stay_apart(spark, area):  # noqa: F811
    for name in ("бееддз", "вггжев"):
        area.csv(f"{name}.zip", "id\n1\n")
    loader = ArchiveLoader(spark, area.tiers)
    loader.run()
    assert len({r["target_table"] for r in loader.log.processed().collect()}) == 2


def test_legacy_bytes_are_never_refused(spark, area):  # noqa: F811
    area.put("a.zip", ("d.csv", b"name\n" + bytes(range(128, 256)) + b"\n"))
    loader = ArchiveLoader(spark, area.tiers, CsvFormat.all_text(), table="t")
    loader.run()
    value = loader.table("t").first()["name"]
    assert value == bytes(range(128, 256)).decode("windows-1251", "replace")


def test_objects_of_one_name_keep_their_folders(spark, tmp_path, rows):
    for folder in ("a", "b c", "d%20e/f"):
        place = tmp_path / "in" / folder
        place.mkdir(parents=True)
        (place / "v2.json").write_text(folder)
    objects = read_text_objects(spark, str(tmp_path / "in"), "*.json", recursive=True)
    write_text_objects(objects, str(tmp_path / "out"), ".json", str(tmp_path / "in"))
    for folder in ("a", "b c", "d%20e/f"):
        assert (tmp_path / "out" / folder / "v2.json").read_text() == folder


def test_failed_files_wait_longer_each_time(spark):
    """Due after the wait; twice as long after a second failure; never once a later try went well."""
    from datetime import datetime, timedelta

    from quayside.plans.load_log import due_again

    def at(minutes):
        return datetime.now() - timedelta(minutes=minutes)

    rows = [
        ("once", "failed", at(11), "1"), ("early", "failed", at(5), "1"), ("twice", "failed", at(40), "1"), ("twice", "failed", at(15), "2"),
        ("long", "failed", at(60), "1"), ("long", "failed", at(25), "2"), ("mended", "failed", at(60), "1"), ("mended", "processed", at(30), "2"),
        ("none", "no_csv", at(60), "1"), ("old", "failed", at(3000), "0"), *(("old", "failed", at(1500), str(k)) for k in range(1, 40)),
    ]
    log = spark.createDataFrame(
        [(s, s, "t", status, 1, when, i) for s, status, when, i in rows],
        "source string, source_name string, target_table string, status string, n_bytes bigint, loaded_at timestamp, load_id string",
    )
    assert {r["source"] for r in due_again(log, 600).collect()} == {"once", "long", "old"}
    assert {r["source"] for r in due_again(log, 0).collect()} == {"once", "early", "twice", "long", "old"}


def test_commits_tell_replays_apart(spark, area, monkeypatch, tmp_path):  # noqa: F811
    """A load that stopped and ran again is a replay, in a run and in a stream; one that stops again is still one commit."""
    loader = ArchiveLoader(spark, area.tiers, table="t")

    def stopped(*_):
        raise RuntimeError("stopped")

    area.csv("a.zip", "id\n1\n")
    loader.run()
    area.csv("b.zip", "id\n2\n3\n")
    with monkeypatch.context() as patch:
        patch.setattr(loader.log, "write_outcomes", stopped)
        for _ in range(2):
            with pytest.raises(RuntimeError, match="stopped"):
                loader.run()
    loader.run()
    area.csv("c.zip", "id\n4\n")
    with monkeypatch.context() as patch:
        patch.setattr(loader.log, "write_outcomes", stopped)
        with pytest.raises(StreamingQueryException):
            start_archive_stream(loader, str(tmp_path / "stream"), "load").awaitTermination()
    start_archive_stream(loader, str(tmp_path / "stream"), "load").awaitTermination()
    area.csv("d.zip", "id\n5\n")
    start_archive_stream(loader, str(tmp_path / "stream"), "load").awaitTermination()
    history = commit_history(loader.log.outcomes(), replayed=loader.log.replayed()).collect()
    assert [(r["operation"], r["added_records"], r["total_records"]) for r in reversed(history)] == [
        ("append", 1, 1), ("replay", 2, 3), ("replay", 1, 4), ("append", 1, 5)]
    assert {r["operation"] for r in commit_history(loader.log.outcomes()).collect()} == {"append"}
