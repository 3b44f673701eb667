"""The load job with its command line."""

import uuid
import zipfile

import pytest

import load


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "raw").mkdir()
    for name, content in {"Таблица_4.zip": "k;v\n1;ж\n", "Other-1.zip": "k;v\n2;x\n"}.items():
        with zipfile.ZipFile(tmp_path / "raw" / name, "w") as archive:
            archive.writestr("d.csv", content.encode("cp1251"))
    return tmp_path


def tiers(landing):
    return ["--raw", str(landing / "raw"), "--stage", str(landing / "stage"), "--warehouse", str(landing / "warehouse")]


def test_table_per_file_is_registered(spark, landing):
    namespace = f"bronze_{uuid.uuid4().hex[:8]}"
    arguments = ["archives", *tiers(landing), "--all-text", "--sep", ";", "--register", namespace]
    assert load.main(arguments) == {"found": 2, "processed": 2, "skipped": 0, "failed": 0, "logged": 2}
    assert spark.table(f"{namespace}.f4_sprav_gtin").select("k", "v").collect() == [("1", "ж")]
    assert load.main(arguments)["skipped"] == 2
    assert spark.table(f"{namespace}.other_1").select("k", "v").collect() == [("2", "x")]


def test_names_show_logged_loads_only(spark, landing, monkeypatch):
    options = load.parse(["archives", *tiers(landing), "--table", "t", "--encoding", "cp1251", "--sep", ";"])
    loader = load.make_loader(spark, options)
    loader.run()
    with zipfile.ZipFile(landing / "raw" / "late.zip", "w") as archive:
        archive.writestr("d.csv", "k;v;w\n3;z;1\n")
    namespace = f"bronze_{uuid.uuid4().hex[:8]}"
    with monkeypatch.context() as patch:
        patch.setattr(loader.log, "write_outcomes", lambda *_: None)
        loader.run()
    assert spark.table(loader.register(namespace, "t")).count() == 2
    loader.run()
    rows = spark.table(loader.register(namespace, "t")).select("k", "w").orderBy("k").collect()
    assert rows == [(1, None), (2, None), (3, 1)]


def test_settings_from_the_environment(monkeypatch):
    for key, value in {"ZIP_DIR": "/z", "CSV_SEP": ";", "CSV_HEADER": "false", "INFER_SCHEMA": "FALSE",
                       "CSV_ENCODING": "cp1251", "TABLE_NAME": "t"}.items():
        monkeypatch.setenv(key, value)
    options = load.parse(["archives", "--stage", "/s", "--warehouse", "/w"])
    assert (options.raw, options.sep, options.header, options.infer_schema, options.encoding, options.table) == (
        "/z", ";", False, False, "cp1251", "t")
