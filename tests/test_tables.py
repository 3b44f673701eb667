"""Tables, scans, audit and rewriting on small fixtures."""

import datetime as dt
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quayside.operators import audit, path_rewrite, tables
from quayside.operators.top_k import any_row, month_range, top_k_aggregate
from quayside.plans import load_log
from quayside.session import SESSION_DEFAULTS, scratch_path, scratch_root, session_settings
from quayside.sources.columnar import data_files, read_parquet
from quayside.sources.delimited import read_all_text, read_delimited
from quayside.sources.listing import list_files, path_exists
from quayside.sources.storage import open_store
from quayside.sources.text_objects import containing, read_text_objects


@pytest.fixture
def namespace(spark):
    name = f"n_{uuid.uuid4().hex[:8]}"
    tables.ensure_namespace(spark, name, scratch_path(spark, name))
    return name


@pytest.fixture
def berths(spark):
    rows = [(100 + 7 * k, f"mooring {k}", k / 4, k % 3 == 0) for k in range(5)]
    return spark.createDataFrame(rows, ["berth", "label", "depth", "is_free"])


def test_first_load_writes_its_rows_once(spark, namespace, berths):
    tables.create_or_append(berths, f"{namespace}.berths")
    assert spark.table(f"{namespace}.berths").count() == 5
    tables.create_or_append(berths, f"{namespace}.berths")
    assert spark.table(f"{namespace}.berths").count() == 10


def test_create_refuses_an_existing_table(spark, namespace, berths):
    tables.create_table(berths, f"{namespace}.berths")
    with pytest.raises(AnalysisException):
        tables.create_table(berths, f"{namespace}.berths")


def test_append_matches_by_name_and_refuses_other_types(spark, namespace):
    tables.ensure_table(spark, f"{namespace}.t", "id BIGINT, v STRING")
    tables.append_rows(spark.createDataFrame([("x", 1)], "v string, id bigint"), f"{namespace}.t")
    assert tuple(spark.table(f"{namespace}.t").first()) == (1, "x")
    with pytest.raises(AnalysisException):
        tables.append_rows(spark.createDataFrame([("x", "1")], "v string, id string"), f"{namespace}.t")


def test_create_or_replace_changes_the_columns(spark, namespace, berths):
    tables.create_or_replace(berths, f"{namespace}.t")
    tables.create_or_replace(spark.range(3), f"{namespace}.t")
    assert spark.table(f"{namespace}.t").columns == ["id"]


def test_bucketed_table_joins_without_a_shuffle_of_it(spark, namespace):
    for name in ("a", "b"):
        tables.create_bucketed(spark, f"{namespace}.{name}", "id BIGINT", "id", 8)
        tables.insert_bucketed(spark.range(100), f"{namespace}.{name}", "id", 8)
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        joined = spark.table(f"{namespace}.a").join(spark.table(f"{namespace}.b"), "id")
        assert joined.count() == 100
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    assert list_files(spark, tables.table_location(spark, f"{namespace}.a").first()["location"]).where(
        F.col("source_name").endswith(".parquet")).count() == 8


def test_commit_test(spark, namespace):
    name = f"{namespace}.ctest"
    tables.drop_table(spark, name)
    tables.create_bucketed(spark, name, "id BIGINT", "id", 8)
    tables.insert_select(spark, name, "SELECT id FROM range(0, 10)")
    assert spark.table(name).count() == 10
    tables.drop_table(spark, name)
    assert not tables.table_exists(spark, name)


def test_connect_test(spark):
    path = scratch_path(spark, "connect")
    spark.range(3).write.mode("overwrite").parquet(path)
    assert read_parquet(spark, path).count() == 3


def test_register_checks_all_locations_first(spark, namespace, berths, tmp_path):
    berths.write.parquet(str(tmp_path / "berths"))
    with pytest.raises(FileNotFoundError):
        tables.register_tables(spark, namespace, {"berths": str(tmp_path / "berths"), "no": str(tmp_path / "no")})
    assert tables.list_tables(spark, namespace).count() == 0
    tables.register_tables(spark, namespace, {"berths": str(tmp_path / "berths")})
    assert spark.table(f"{namespace}.berths").count() == 5


def test_odd_column_names(spark, namespace):
    frame = spark.createDataFrame([(1, 2)], ["Наименование, руб с НДС", "a.b c"])
    tables.create_or_append(frame, f"{namespace}.odd")
    tables.create_or_append(frame.select("`a.b c`", "`Наименование, руб с НДС`"), f"{namespace}.odd2")
    assert spark.table(f"{namespace}.odd").columns == frame.columns


def test_top_k_ties_go_to_the_smaller_key(spark):
    frame = spark.createDataFrame([(k, 1) for k in range(50)], "k int, v int")
    found = top_k_aggregate(frame, ["k"], [F.sum("v").alias("s")], "s", 3)
    assert [r["k"] for r in found.collect()] == [0, 1, 2]


@pytest.mark.parametrize("month", [1, 12])
def test_month_range_reaches_the_scan(spark, tmp_path, month):
    days = [dt.datetime(2024, 12, 31, 23), dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 31, 23, 59, 59),
            dt.datetime(2025, 2, 1), dt.datetime(2025, 12, 1), dt.datetime(2025, 12, 31, 23), dt.datetime(2026, 1, 1)]
    spark.createDataFrame([(d,) for d in days], "d timestamp_ntz").write.parquet(str(tmp_path / "d"))
    found = spark.read.parquet(str(tmp_path / "d")).where(month_range("d", 2025, month))
    assert sorted(r["d"] for r in found.collect()) == [d for d in days if (d.year, d.month) == (2025, month)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d" in plan and "LessThan(d" in plan


def test_any_row(spark):
    assert any_row(spark.range(5), "id = 3").first()["found"] is True
    assert any_row(spark.range(5), "id = 9").first()["found"] is False


def test_typed_and_text_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('ИНН;имя\n007;Ёж\n12;""\n;x;y\n'.encode("cp1251"))
    typed = read_delimited(spark, str(tmp_path / "a.csv"), sep=";", encoding="windows-1251")
    assert typed.columns == ["ИНН", "имя"]
    assert [tuple(r) for r in typed.collect()] == [(7, "Ёж"), (12, None), (None, "x")]
    text = read_all_text(spark, str(tmp_path / "a.csv"), sep=";")
    assert [tuple(r) for r in text.collect()] == [("007", "Ёж"), ("12", None), (None, "x")]
    declared = read_delimited(spark, str(tmp_path / "a.csv"), sep=";", encoding="cp1251", schema="k bigint, v string")
    assert [tuple(r) for r in declared.collect()] == [(7, "Ёж"), (12, None), (None, "x")]


def test_listing(spark, tmp_path):
    for name in ("b.zip", "a.zip", "x.ZIP", "c.txt", "sub/d.zip"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"12345")
    flat = list_files(spark, str(tmp_path), "*.zip").orderBy("source").collect()
    assert [(r["source_name"], r["n_bytes"]) for r in flat] == [("a.zip", 5), ("b.zip", 5)]
    assert list_files(spark, str(tmp_path), "*.zip", recursive=True).count() == 3
    assert path_exists(spark, str(tmp_path / "sub")) and not path_exists(spark, str(tmp_path / "metadata"))


def test_data_files(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "t"))
    files = data_files(read_parquet(spark, str(tmp_path / "t"))).collect()
    assert sum(f["record_count"] for f in files) == 10
    sizes = {f.name: f.stat().st_size for f in (tmp_path / "t").glob("*.parquet")}
    assert len(sizes) == 3
    assert {f["file_path"].rsplit("/", 1)[1]: f["file_size_in_bytes"] for f in files} == sizes


def test_rewrite_objects_into_a_new_place(spark, tmp_path):
    (tmp_path / "old").mkdir()
    bodies = {"a.json": '{"p": "s3://old.host/x",\n"q": "old.host"}', "b.json": '{"p": "oldXhost"}', "c.txt": "old.host"}
    for name, body in bodies.items():
        (tmp_path / "old" / name).write_text(body)
    objects = read_text_objects(spark, str(tmp_path / "old"), "*.json")
    assert containing(objects, "old.host").count() == 1
    assert path_rewrite.residual(objects, "body", "old.host").first()["residual"] == 1
    fixed = path_rewrite.rewrite_paths(objects, "body", "old.host", "$new\\host")
    path_rewrite.write_text_objects(fixed, str(tmp_path / "new"), ".json")
    again = read_text_objects(spark, str(tmp_path / "new"))
    assert path_rewrite.residual(again, "body", "old.host").first()["residual"] == 0
    assert (tmp_path / "new" / "a.json").read_text() == bodies["a.json"].replace("old.host", "$new\\host")
    assert (tmp_path / "new" / "b.json").read_text() == bodies["b.json"]
    assert (tmp_path / "old" / "a.json").read_text() == bodies["a.json"]


def test_replacement_across_pieces():
    text = b"abababa--ab-aab" * 3
    for old in ("ab", "aba", "a", "abababa--", "zz"):
        for size in range(1, 20):
            replacement = path_rewrite.Replacement(old, "<ab>")
            made = b"".join(replacement(text[k : k + size] for k in range(0, len(text), size)))
            assert made == text.replace(old.encode(), b"<ab>")
            assert replacement.found == text.count(old.encode())
    assert b"".join(path_rewrite.Replacement("a", "b")(iter(()))) == b""
    with pytest.raises(ValueError, match="nothing to replace"):
        path_rewrite.Replacement("", "b")


def test_rewrite_objects_in_pieces(spark, tmp_path):
    bodies = {
        "one/a 1%.json": b"x" * 70 + b"old.host" * 5, "two/a 1%.json": b"\xff\xfeold.hos", "two/deep/b.json.gz": b"old.hold.host", "c.json": b"",
    }
    for name, body in bodies.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    listed = list_files(spark, root, recursive=True)
    done = path_rewrite.rewrite_objects(listed, root, out, "old.host", "new", piece_bytes=3).collect()
    assert {r["source"].rsplit("/in/", 1)[1]: r["n_replaced"] for r in done} == {n: b.count(b"old.host") for n, b in bodies.items()}
    for name, body in bodies.items():
        assert (tmp_path / "out" / name).read_bytes() == body.replace(b"old.host", b"new")
        assert (tmp_path / "in" / name).read_bytes() == body
    found = path_rewrite.count_in_objects(listed, "old.host", piece_bytes=3).collect()
    assert sorted(r["n_found"] for r in found) == [0, 0, 1, 5]
    left = path_rewrite.count_in_objects(list_files(spark, out, recursive=True), "old.host", piece_bytes=3)
    assert left.where("n_found > 0").isEmpty()
    assert path_rewrite.rewrite_objects(listed.where("false"), root, out, "a", "b").isEmpty()
    with pytest.raises(Exception, match="not below"):
        path_rewrite.rewrite_objects(listed, str(tmp_path / "other"), out, "a", "b")


def test_commit_history(spark):
    at = [dt.datetime(2025, 1, d) for d in (1, 2, 3)]
    log = spark.createDataFrame(
        [("t", "L1", "a", "processed", 5, at[0]), ("t", "L1", "b", "processed", 6, at[0]),
         ("t", "L2", "c", "failed", 0, at[1]), ("t", "L3", "d", "processed", 7, at[2]),
         ("u", "L2", "e", "processed", 1, at[1])],
        "target_table string, load_id string, source string, status string, n_rows bigint, loaded_at timestamp")
    found = [(r["target_table"], r["load_id"], r["added_files"], r["total_records"])
             for r in audit.commit_history(log).collect()]
    assert found == [("t", "L3", 1, 18), ("u", "L2", 1, 1), ("t", "L1", 2, 11)]


def test_pending_and_loaded_are_complements(spark):
    files = spark.createDataFrame([("a", "t"), ("b", "t"), ("a", "u")], "source string, target_table string")
    log = spark.createDataFrame([("a", "t", "processed"), ("b", "t", "failed")],
                                "source string, target_table string, status string")
    pending = {tuple(r) for r in load_log.pending_files(files, log).collect()}
    loaded = {tuple(r) for r in load_log.already_loaded_files(files, log).collect()}
    assert (pending, loaded) == ({("b", "t"), ("a", "u")}, {("a", "t")})


def test_store_of_a_path():
    store, path = open_store("file:/tmp/a b%20c#d.zip")
    assert (store.type_name, path) == ("local", "/tmp/a b%20c#d.zip")
    assert open_store("/tmp/x")[1] == "/tmp/x"
    options = {"fs.s3a.endpoint": "localhost:1", "fs.s3a.access.key": "k", "fs.s3a.secret.key": "s",
               "fs.s3a.endpoint.region": "none", "fs.s3a.connection.ssl.enabled": "false"}
    store, path = open_store("s3a://bucket/dir/a%20b.zip", options)
    assert (store.type_name, path) == ("s3", "bucket/dir/a%20b.zip")


def test_session(spark):
    assert scratch_root(spark).startswith("file:")
    assert spark.conf.get("spark.sql.broadcastTimeout") == SESSION_DEFAULTS["spark.sql.broadcastTimeout"]
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with session_settings(spark, {key: "3"}):
        assert spark.conf.get(key) == "3"
    assert spark.conf.get(key) == before


def test_listing_is_that_of_spark(spark, tmp_path):
    """Many levels, odd and hidden names, empty folders: the same rows as Spark's own file index."""
    names = ["a.zip", "b.ZIP", "c d%20#é.zip", "_hidden.zip", ".dot.zip", "_metadata.zip", "_k=1.zip", "x.zip._COPYING_", "e.txt"]
    for folder in ("", "m=1", "m=1/d=2", "m=2/d=3/h=4", "_temporary/0", ".git", "sub folder"):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        for name in names:
            (tmp_path / folder / name).write_text(folder + name)
    (tmp_path / "empty").mkdir()
    for glob in ("*.zip", "[a-c]*", "{a,e}.*", "?.zip", "*"):
        for recursive in (False, True):
            index = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            own = index.load(str(tmp_path)).select("path", "length", "modificationTime").collect()
            expected = {tuple(r) for r in own if recursive or r.path.rsplit("/", 1)[0] == f"file:{tmp_path}"}
            found = list_files(spark, str(tmp_path), glob, recursive)
            assert {tuple(r) for r in found.select("source", "n_bytes", "modified_at").collect()} == expected
    assert list_files(spark, f"file://{tmp_path}/empty").count() == 0
    assert list_files(spark, str(tmp_path / "a.zip"), "*.zip").first()["source"] == f"file:{tmp_path}/a.zip"
    with pytest.raises(Exception, match="FileNotFoundError"):
        list_files(spark, str(tmp_path / "nothing"))


def test_listing_of_many_folders_is_dealt_to_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    for k in range(300):
        (tmp_path / f"day={k}").mkdir()
        (tmp_path / f"day={k}" / f"{k}.parquet").write_text("x")
    folders = spark.createDataFrame([(f"file:{tmp_path}/day={k}",) for k in range(300)], "source string").repartition(8)
    from quayside.sources.listing import list_folders

    tasks = list_folders(folders, None, {}).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 8 and sum(r["count"] for r in tasks) == 300
    assert list_files(spark, str(tmp_path), "*.parquet", recursive=True).count() == 300


def test_running_totals_by_blocks(spark):
    """A group of very many rows beside small ones, null values and ties of the first order column: as one window would add up."""
    from pyspark.sql import Window

    from quayside.operators.audit import running_total

    rows = spark.range(50_000).select(
        F.when(F.col("id") % 10 < 7, "big").otherwise(F.concat(F.lit("small"), F.col("id") % 90)).alias("k"),
        (F.col("id") % 1000).alias("t"), F.hash("id").alias("u"), F.col("id").alias("id"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 17).alias("v"),
    )
    found = running_total(rows, ["k"], ["t", "u", "id"], "v", "total", block_rows=3_000)
    window = F.coalesce(F.sum("v").over(Window.partitionBy("k").orderBy("t", "u", "id")), F.lit(0))
    expected = rows.withColumn("total", window)
    assert found.exceptAll(expected.select(found.columns)).isEmpty() and found.count() == 50_000
    assert running_total(rows.limit(0), ["k"], ["t", "u", "id"], "v", "total").count() == 0


def test_commit_history_of_very_many_loads(spark):
    from quayside.operators.audit import commit_history

    log = spark.range(200_000).select(
        F.lit("t").alias("target_table"), F.concat(F.lit("L"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("load_id"),
        F.lit("processed").alias("status"), F.timestamp_seconds(F.col("id")).alias("loaded_at"), F.lit(2).cast("long").alias("n_rows"),
    )
    history = commit_history(log, block_rows=10_000)
    totals = history.select("load_id", "total_records").agg(
        F.max("total_records").alias("most"), F.count("*").alias("n"), F.count_distinct("total_records").alias("different")
    ).first()
    assert tuple(totals) == (400_000, 200_000, 200_000)
    assert history.where(F.col("total_records") != 2 * (F.substring("load_id", 2, 9).cast("long") + 1)).isEmpty()
