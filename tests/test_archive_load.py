"""Archive loads on small hand-made landing areas."""

import json
import os
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from quayside.plans import archive_load, load_log
from quayside.plans.archive_load import ArchiveLoader
from quayside.plans.loading import Tiers
from quayside.sources import archives
from quayside.sources.archives import CsvFormat, open_archives, scan_archives
from quayside.sources.listing import list_files
from quayside.streaming.archive_stream import start_archive_stream


@pytest.fixture
def area(tmp_path):
    """A landing folder, a way to put archives there, and the tiers around it."""

    class Area:
        raw = tmp_path / "raw"
        tiers = Tiers.under(str(tmp_path), str(tmp_path / "raw"))

        def put(self, name, *members, compress=zipfile.ZIP_DEFLATED):
            self.raw.mkdir(exist_ok=True)
            with zipfile.ZipFile(self.raw / name, "w", compress) as archive:
                for member, content in members:
                    archive.writestr(member, content if isinstance(content, bytes) else content.encode())

        def csv(self, name, content):
            self.put(name, ("data.csv", content))

    return Area()


def statuses(loader):
    return {r["source_name"]: r["status"] for r in loader.log.outcomes().collect()}


def counts(summary):
    return summary.first().asDict()


def test_fan_in_loads_each_archive_once(spark, area, rows):
    area.csv("a.zip", "id,name\n1,x\n2,y\n")
    area.csv("b.zip", "id,name\n3,z\n")
    loader = ArchiveLoader(spark, area.tiers, table="t")
    assert counts(loader.run()) == {"found": 2, "processed": 2, "skipped": 0, "failed": 0, "logged": 2}
    assert rows(loader.table("t"), "id", "name") == [(1, "x"), (2, "y"), (3, "z")]
    assert counts(loader.run()) == {"found": 2, "processed": 0, "skipped": 2, "failed": 0, "logged": 2}
    area.csv("c.zip", "id,name\n4,w\n")
    assert counts(loader.run()) == {"found": 3, "processed": 1, "skipped": 2, "failed": 0, "logged": 3}
    assert rows(loader.table("t"), "id") == [(1,), (2,), (3,), (4,)]


def test_empty_landing_creates_nothing(spark, area):
    area.raw.mkdir()
    loader = ArchiveLoader(spark, area.tiers, table="t")
    assert counts(loader.run()) == {"found": 0, "processed": 0, "skipped": 0, "failed": 0, "logged": 0}
    assert sorted(os.listdir(area.raw.parent)) == ["raw"]


def test_every_kind_of_archive_has_its_status(spark, area, rows):
    area.csv("good.zip", "id,v\n1,a\n")
    area.put("two.zip", ("first.csv", "id,v\n2,b\n"), ("second.csv", "id,v\n99,no\n"))
    area.put("upper.zip", ("readme.txt", "x"), ("A.CSV", "id,v\n3,c\n"))
    area.put("none.zip", ("readme.txt", "x"))
    area.csv("empty.zip", "")
    area.csv("blank.zip", "\n\r\n \n")
    area.csv("header.zip", "id,v\n")
    area.csv("X.ZIP", "id,v\n98,no\n")
    (area.raw / "broken.zip").write_bytes(b"not a zip at all")
    loader = ArchiveLoader(spark, area.tiers, table="t")
    assert counts(loader.run()) == {"found": 8, "processed": 4, "skipped": 3, "failed": 1, "logged": 4}
    assert statuses(loader) == {
        "good.zip": "processed", "two.zip": "processed", "upper.zip": "processed", "header.zip": "processed",
        "none.zip": "no_csv", "empty.zip": "empty_csv", "blank.zip": "empty_csv", "broken.zip": "failed",
    }
    assert rows(loader.table("t"), "id", "v") == [(1, "a"), (2, "b"), (3, "c")]
    n_rows = {r["source_name"]: r["n_rows"] for r in loader.log.processed().collect()}
    assert n_rows == {"good.zip": 1, "two.zip": 1, "upper.zip": 1, "header.zip": 0}
    error = loader.log.outcomes().where("status = 'failed'").first()["error"]
    assert error.startswith("BadZipFile")


def test_failed_file_is_tried_again(spark, area, rows):
    area.raw.mkdir()
    (area.raw / "a.zip").write_bytes(b"half delivered")
    loader = ArchiveLoader(spark, area.tiers, table="t")
    assert counts(loader.run())["failed"] == 1
    assert counts(loader.run())["failed"] == 1
    area.csv("a.zip", "id\n1\n")
    assert counts(loader.run())["processed"] == 1
    assert rows(loader.table("t"), "id") == [(1,)]


def test_archive_damaged_part_way_gives_no_rows(spark, area, rows):
    area.csv("good.zip", "id,v\n" + "".join(f"{i},ok\n" for i in range(50)))
    area.put("bad.zip", ("d.csv", "id,v\n" + "".join(f"{i},bad\n" for i in range(2000))), compress=zipfile.ZIP_STORED)
    content = bytearray((area.raw / "bad.zip").read_bytes())
    content[len(content) // 2] ^= 1
    (area.raw / "bad.zip").write_bytes(bytes(content))
    loader = ArchiveLoader(spark, area.tiers, CsvFormat(block_bytes=512), table="t")
    assert counts(loader.run()) == {"found": 2, "processed": 1, "skipped": 0, "failed": 1, "logged": 1}
    assert loader.table("t").select("v").distinct().collect() == [("ok",)]
    assert loader.table("t").count() == 50


def test_columns_of_a_damaged_archive_are_not_taken(spark, area):
    area.csv("good.zip", "id\n1\n")
    area.put("bad.zip", ("d.csv", "id,extra\n" + "1,x\n" * 2000), compress=zipfile.ZIP_STORED)
    content = bytearray((area.raw / "bad.zip").read_bytes())
    content[len(content) // 2] ^= 1
    (area.raw / "bad.zip").write_bytes(bytes(content))
    loader = ArchiveLoader(spark, area.tiers, CsvFormat(block_bytes=512), table="t")
    assert counts(loader.run())["failed"] == 1
    assert loader.table("t").columns == ["load_id", "id", "_source"]


def test_undecodable_text_fails_that_file_only(spark, area, rows):
    area.csv("a.zip", "id,v\n1,x\n")
    area.csv("b.zip", b"id,v\n2,\xff\xfe\n")
    loader = ArchiveLoader(spark, area.tiers, table="t")
    loader.run()
    assert statuses(loader) == {"a.zip": "processed", "b.zip": "failed"}
    assert rows(loader.table("t"), "id") == [(1,)]


def test_odd_names_are_logged_once(spark, area):
    odd = ["a b.zip", "p%20q.zip", "it's.zip", "n#1.zip", "Отчёт.zip", "plus+.zip"]
    for i, name in enumerate(odd):
        area.csv(name, f"id\n{i}\n")
    loader = ArchiveLoader(spark, area.tiers, table="t")
    assert counts(loader.run())["processed"] == len(odd)
    assert sorted(statuses(loader)) == sorted(odd)
    assert counts(loader.run()) == {
        "found": len(odd), "processed": 0, "skipped": len(odd), "failed": 0, "logged": len(odd)}
    assert loader.table("t").count() == len(odd)


def test_all_text_in_windows_1251(spark, area, rows):
    area.csv("a.zip", 'Код;Имя;Цена\n01;"Жук; чёрный";5\n02;"";\n03;x;1;surplus\n04\n'.encode("cp1251"))
    loader = ArchiveLoader(spark, area.tiers, CsvFormat.all_text(sep=";"), table="t")
    loader.run()
    assert [f.dataType.simpleString() for f in loader.table("t").drop("load_id", "_source").schema] == ["string"] * 3
    assert rows(loader.table("t"), "Код", "Имя", "Цена") == [
        ("01", "Жук; чёрный", "5"), ("02", None, None), ("03", "x", "1"), ("04", None, None)]


def test_types_are_found_over_all_archives(spark, area, rows):
    area.csv("a.zip", "i,l,big,d,day,at,b,s,n\n1,1,1,1,2025-01-01,2025-01-01 10:00:00,true,1,\n")
    area.csv("b.zip", "i,l,big,d,day,at,b,s,n\n2,9999999999,99999999999999999999,1.5,2025-01-02,2025-01-02 11:30:00,FALSE,x,\n")
    loader = ArchiveLoader(spark, area.tiers, table="t")
    loader.run()
    types = {f.name: f.dataType.simpleString() for f in loader.table("t").schema}
    assert {k: types[k] for k in ("i", "l", "big", "d", "day", "at", "b", "s", "n")} == {
        "i": "int", "l": "bigint", "big": "decimal(38,0)", "d": "double", "day": "date", "at": "timestamp",
        "b": "boolean", "s": "string", "n": "string"}
    assert loader.table("t").agg(F.sum("l"), F.max("d")).first() == (10000000000, 1.5)


@pytest.mark.parametrize("sample_rows", [0.001, 5, 1000])
def test_types_do_not_depend_on_the_sample(spark, area, sample_rows, monkeypatch):
    monkeypatch.setattr(archive_load, "SAMPLE_ROWS", sample_rows)
    lines = [f"{i},{i},{i},{i},2025-01-{i % 28 + 1:02d}," for i in range(1, 301)]
    lines[250] = "251,2.5,text,99999999999,2025-01-01 10:00:00,true"
    area.csv("a.zip", "i,d,s,l,at,late\n" + "\n".join(lines[:200]))
    area.csv("b.zip", "i,d,s,l,at,late\n" + "\n".join(lines[200:]))
    loader = ArchiveLoader(spark, area.tiers, table="t")
    loader.run()
    types = {f.name: f.dataType.simpleString() for f in loader.table("t").schema}
    assert {c: types[c] for c in ("i", "d", "s", "l", "at", "late")} == {
        "i": "int", "d": "double", "s": "string", "l": "bigint", "at": "timestamp", "late": "boolean"}
    assert loader.table("t").agg(F.sum("d"), F.count("at"), F.count("late")).first() == (45150 - 251 + 2.5, 300, 1)


def test_text_in_a_numeric_column_is_reported(spark, area, rows):
    area.csv("a.zip", "id,v\n1,10\n")
    loader = ArchiveLoader(spark, area.tiers, table="t")
    loader.run()
    area.csv("b.zip", "id,v\n2,ten\n3,30\n")
    area.csv("c.zip", "id,v\n4,40\n")
    assert counts(loader.run()) == {"found": 3, "processed": 1, "skipped": 1, "failed": 1, "logged": 2}
    assert rows(loader.table("t"), "id", "v") == [(1, 10), (4, 40)]
    assert loader.log.outcomes().where("status = 'failed'").first()["error"] == "v: not int"


@pytest.mark.parametrize("merge", [True, False])
def test_another_set_of_columns(spark, area, rows, merge):
    area.csv("a.zip", "id,v\n1,10\n")
    loader = ArchiveLoader(spark, area.tiers, table="t", merge_schema=merge)
    loader.run()
    area.csv("b.zip", "v,extra,id\n20,new,2\n")
    area.csv("c.zip", "v,id\n30,3\n")
    summary = counts(loader.run())
    if merge:
        assert summary["processed"] == 2
        assert rows(loader.table("t"), "id", "v", "extra") == [(1, 10, None), (2, 20, "new"), (3, 30, None)]
    else:
        assert (summary["processed"], summary["failed"]) == (1, 1)
        assert rows(loader.table("t"), "id", "v") == [(1, 10), (3, 30)]
        assert "extra" not in loader.table("t").columns


def test_header_names_with_spaces_commas_and_repeats(spark, area, rows):
    area.csv("a.zip", '"Сумма, руб с НДС",,x,X,a.b\n1,2,3,4,5\n')
    loader = ArchiveLoader(spark, area.tiers, table="t")
    loader.run()
    assert loader.table("t").columns[1:6] == ["Сумма, руб с НДС", "_c1", "x2", "X3", "a.b"]
    assert rows(loader.table("t"), "`a.b`", "`Сумма, руб с НДС`") == [(5, 1)]


def test_without_header(spark, area, rows):
    area.csv("a.zip", "1,x\n2,y\n")
    loader = ArchiveLoader(spark, area.tiers, CsvFormat(header=False), table="t")
    loader.run()
    assert rows(loader.table("t"), "_c0", "_c1") == [(1, "x"), (2, "y")]


def test_fan_out_routes_by_name(spark, area, rows):
    for name in ["Таблица_4 июнь", "Таблица_40", "Нанесения_ввод_1", "Café-2.1", "Ж"]:
        area.csv(f"{name}.zip", "id\n1\n")
    loader = ArchiveLoader(spark, area.tiers)
    loader.run()
    targets = {r["source_name"]: r["target_table"] for r in loader.log.processed().collect()}
    assert targets["Таблица_4 июнь.zip"] == "f4_sprav_gtin"
    assert targets["Нанесения_ввод_1.zip"] == "f1_manuf_import"
    assert targets["Café-2.1.zip"] == "cafe_2"
    assert targets["Таблица_40.zip"] == "_40"
    assert re.fullmatch("tbl_[0-9a-f]{8}", targets["Ж.zip"])
    again = ArchiveLoader(spark, area.tiers)
    assert counts(again.run())["skipped"] == 5


def test_names_that_fold_to_the_same_get_a_hash(spark, area):
    area.csv("Отчёт_9.zip", "id\n1\n")
    loader = ArchiveLoader(spark, area.tiers)
    loader.run()
    area.csv("Сводка_9.zip", "id\n2\n")
    assert counts(loader.run()) == {"found": 2, "processed": 1, "skipped": 1, "failed": 0, "logged": 2}
    targets = {r["source_name"]: r["target_table"] for r in loader.log.processed().collect()}
    assert targets["Отчёт_9.zip"] == "_9"
    assert re.fullmatch("_9_[0-9a-f]{32}", targets["Сводка_9.zip"])


def test_two_new_names_that_fold_to_the_same(spark, area):
    area.csv("a-b.zip", "id\n1\n")
    area.csv("A b.zip", "id\n2\n")
    loader = ArchiveLoader(spark, area.tiers)
    loader.run()
    targets = {r["target_table"] for r in loader.log.processed().collect()}
    assert len(targets) == 2 and all(re.fullmatch("a_b_[0-9a-f]{32}", t) for t in targets)
    assert counts(loader.run())["skipped"] == 2


@pytest.mark.parametrize("step", ["data", "log"])
def test_crash_is_replayed_without_doubles(spark, area, rows, step, monkeypatch):
    area.csv("a.zip", "id\n1\n2\n")
    loader = ArchiveLoader(spark, area.tiers, table="t")

    def crash(*_):
        raise RuntimeError("lost")

    broken = "write_table" if step == "data" else "write_outcomes"
    with monkeypatch.context() as patch:
        patch.setattr(loader if step == "data" else loader.log, broken, crash)
        with pytest.raises(RuntimeError, match="lost"):
            loader.run()
    area.csv("b.zip", "id\n3\n")
    assert counts(loader.run()) == {"found": 2, "processed": 2, "skipped": 0, "failed": 0, "logged": 2}
    assert rows(loader.table("t"), "id") == [(1,), (2,), (3,)]
    assert loader.log.outcomes().count() == 2
    assert counts(loader.run())["skipped"] == 2


def test_unlogged_rows_are_not_seen(spark, area, rows, monkeypatch):
    area.csv("a.zip", "id\n1\n")
    loader = ArchiveLoader(spark, area.tiers, table="t")
    loader.run()
    area.csv("b.zip", "id\n2\n")
    with monkeypatch.context() as patch:
        patch.setattr(loader.log, "write_outcomes", lambda *_: None)
        loader.run()
    assert rows(loader.table("t"), "id") == [(1,)]
    loader.run()
    assert rows(loader.table("t"), "id") == [(1,), (2,)]


def test_same_name_in_another_folder_is_another_file(spark, area, tmp_path, rows):
    area.csv("a.zip", "id\n1\n")
    loader = ArchiveLoader(spark, area.tiers, table="t")
    loader.run()
    other = tmp_path / "other"
    other.mkdir()
    with zipfile.ZipFile(other / "a.zip", "w") as archive:
        archive.writestr("d.csv", "id\n2\n")
    tiers = Tiers(str(other), area.tiers.stage, area.tiers.warehouse)
    assert counts(ArchiveLoader(spark, tiers, table="t").run())["processed"] == 1
    assert rows(loader.table("t"), "id") == [(1,), (2,)]


def test_lines_do_not_depend_on_block_size(spark, area, rows):
    text = "id,v\r\n" + "".join(f"{i},{'ж' * (i % 7)} \x0b{end}" for i, end in enumerate(["\r\n", "\n", "\r", "\n\n"] * 25))
    area.csv("a.zip", text)
    files = list_files(spark, str(area.raw), "*.zip").withColumn("target_table", F.lit("t"))
    expected = [(n, line) for n, line in enumerate(re.split("\r\n|\r|\n", text)) if n and line.strip()]
    for size in (1, 2, 3, 7, 64, 1 << 20):
        found = scan_archives(files, CsvFormat(block_bytes=size)).select("line_no", "line").orderBy("line_no").collect()
        assert [tuple(r) for r in found] == expected


def test_utf8_mark_is_not_part_of_the_header(spark, area):
    area.csv("a.zip", "﻿id,v\n1,x\n")
    files = list_files(spark, str(area.raw), "*.zip").withColumn("target_table", F.lit("t"))
    row = open_archives(files, CsvFormat()).where("kind = 'file'").first()
    assert json.loads(row["header"]) == ["id", "v"]
    assert row["member_bytes"] == len("﻿id,v\n1,x\n".encode())


def test_big_archive_is_read_back_in_several_tasks(spark, area):
    """The lines of one archive are spread again once they are in the stage tier."""
    area.csv("a.zip", "id,v\n" + "".join(f"{i},{i * 7919 % 10007}\n" for i in range(200_000)))
    loader = ArchiveLoader(spark, area.tiers, table="t")
    loader.run()
    staged = spark.read.parquet(f"{area.tiers.stage}/*/kind=line")
    assert staged.count() == 200_000
    assert loader.table("t").agg(F.count("*"), F.sum("id")).first() == (200_000, 199_999 * 100_000)


def test_stream_loads_new_archives_only(spark, area, rows, tmp_path):
    area.csv("a.zip", "id\n1\n")
    area.csv("b.zip", "id\n2\n")
    loader = ArchiveLoader(spark, area.tiers, table="t")
    checkpoint = str(tmp_path / "checkpoint")
    start_archive_stream(loader, checkpoint, "s1", files_per_batch=1).awaitTermination()
    assert rows(loader.table("t"), "id") == [(1,), (2,)]
    assert len({r["load_id"] for r in loader.log.outcomes().collect()}) == 2
    area.csv("c.zip", "id\n3\n")
    start_archive_stream(loader, checkpoint, "s1").awaitTermination()
    assert rows(loader.table("t"), "id") == [(1,), (2,), (3,)]
    assert counts(loader.run())["skipped"] == 3


def test_stream_and_batch_share_the_log(spark, area, rows, tmp_path):
    area.csv("a.zip", "id\n1\n")
    loader = ArchiveLoader(spark, area.tiers, table="t")
    loader.run()
    start_archive_stream(loader, str(tmp_path / "checkpoint"), "s2").awaitTermination()
    assert rows(loader.table("t"), "id") == [(1,)]


def test_loader_summary_adds_up(spark, area):
    for i in range(3):
        area.csv(f"{i}.zip", f"id\n{i}\n")
    area.put("none.zip", ("a.txt", ""))
    loader = ArchiveLoader(spark, area.tiers, table="t")
    for _ in range(2):
        row = loader.run().first()
        assert row["found"] == row["processed"] + row["skipped"] + row["failed"]
    assert loader.log.rows().where("phase = 'intent'").count() == 5
    assert load_log.PROCESSED in statuses(loader).values()


def test_task_count_follows_files_and_bytes(spark):
    def files(n, size):
        return spark.range(n).select(F.lit(size).cast("bigint").alias("n_bytes"))

    assert archives.tasks_for(files(3, 10)) == 3
    assert archives.tasks_for(files(1000, 10)) == 2 * spark.sparkContext.defaultParallelism
    assert archives.tasks_for(files(100, 128 << 20)) == 100
    assert archives.tasks_for(files(0, 0)) == 1
