"""Column expressions against plain Python."""

import hashlib
import re
import unicodedata
from pathlib import PurePosixPath

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions import charsets, column_types, measures, names


def folded(text):
    kept = (c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")
    return "".join(kept).encode("ascii", "ignore").decode()


def safe(name):
    lowered = folded(PurePosixPath(name).stem).lower()
    return re.sub("[^a-z0-9_]", "", re.sub("[ .-]", "_", lowered))


def test_fold_of_every_character(spark):
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    chars = spark.createDataFrame([(c, f"a{chr(c)}b") for c in codes], "id bigint, text string")
    wrong = [
        r["id"] for r in chars.select("id", names.fold_ascii(F.col("text")).alias("f")).collect()
        if r["f"] != folded(f"a{chr(r['id'])}b")
    ]
    assert wrong == []


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.characters(exclude_characters="/\x00", exclude_categories=["Cs"]), min_size=1), min_size=1))
def test_safe_table_name(spark, texts):
    texts = [t for t in texts if t not in (".", "..") and not t.endswith(".")]
    if texts:
        frame = spark.createDataFrame([(t,) for t in texts], "t string")
        found = frame.select("t", names.safe_table_name(F.col("t")).alias("s"), names.stem(F.col("t")).alias("stem"))
        for row in found.collect():
            if not re.search(r"[\n\r\x85  ]", row["t"]):
                assert row["stem"] == PurePosixPath(row["t"]).stem
                assert row["s"] == safe(row["t"])


def test_stem_and_suffix(spark):
    paths = ["a/b.zip", "b.tar.gz", ".hidden", "a.b/c", "x.", "http://h/p.html?q=1", ""]
    frame = spark.createDataFrame([(p,) for p in paths], "p string")
    found = frame.select(names.base_name("p"), names.stem(F.col("p")), names.suffix(F.col("p"))).collect()
    assert [tuple(r) for r in found] == [
        ("b.zip", "b", ".zip"), ("b.tar.gz", "b.tar", ".gz"), (".hidden", ".hidden", ""), ("c", "c", ""),
        ("x.", "x.", ""), ("p.html?q=1", "p", ".html?q=1"), ("", "", "")]


def test_prefix_is_not_continued_by_a_digit(spark, rows):
    stems = ["Таблица_4", "Таблица_40", "Таблица_4_5", "Таблица_45 Таблица_4", "a.b", "aXb", "Нанесения_ввод2", "т"]
    frame = spark.createDataFrame([(s,) for s in stems], "stem string")
    routes = {**names.DEFAULT_ROUTES, "a.b": "dots"}
    found = {r["stem"]: r["mapped_table"] for r in names.route_by_prefix(frame, "stem", routes).collect()}
    assert found == {
        "Таблица_4": "f4_sprav_gtin", "Таблица_40": None, "Таблица_4_5": "f4_sprav_gtin", "Таблица_45 Таблица_4": None,
        "a.b": "dots", "aXb": None, "Нанесения_ввод2": None, "т": None}


def test_prefixes_are_tried_in_order(spark):
    frame = spark.createDataFrame([("abc1",)], "stem string")
    for routes, target in (({"a": "1", "ab": "2"}, "1"), ({"ab": "2", "a": "1"}, "2")):
        assert names.route_by_prefix(frame, "stem", routes).first()["mapped_table"] == target


def test_fallback_is_the_same_in_every_run(spark):
    frame = spark.createDataFrame([("Отчёт",), ("Сводка",)], "n string")
    found = [r[0] for r in frame.select(names.table_name_or_fallback(F.col("n"))).collect()]
    assert found == ["tbl_" + hashlib.md5(n.encode()).hexdigest()[:8] for n in ("Отчёт", "Сводка")]


@pytest.mark.parametrize("encoding", ["windows-1251", "koi8-r", "cp866", "iso-8859-5"])
def test_single_byte_charsets(spark, encoding):
    raw = bytes(range(1, 256))
    frame = spark.createDataFrame([(raw.decode("iso-8859-1"),)], "t string")
    found = frame.select(charsets.decode_single_byte(F.col("t"), encoding)).first()[0]
    assert found == raw.decode(encoding, errors="replace")


def test_multi_byte_charset_is_refused():
    with pytest.raises(ValueError):
        charsets.upper_half("utf-16")


def test_sizes(spark):
    frame = spark.createDataFrame([(1048576,), (5243,), (0,), (15728640,)], "n bigint")
    found = frame.select(measures.megabytes(F.col("n")), measures.kilobytes(F.col("n"))).collect()
    assert [tuple(r) for r in found] == [(1.0, 1024.0), (0.01, 5.12), (0.0, 0.0), (15.0, 15360.0)]


def test_exact_sum_does_not_overflow(spark):
    frame = spark.range(100).select(F.lit(9 * 10**17).alias("n"))
    assert int(frame.agg(measures.exact_sum(F.col("n"))).first()[0]) == 9 * 10**19


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        (["1", "-2", "+3"], "int"),
        (["1", "3000000000"], "bigint"),
        (["1", "12345678901234567890"], "decimal(38,0)"),
        (["1", "1.5", ".5", "1e3"], "double"),
        (["NaN", "1"], "double"),
        (["2025-01-31", "2024-02-29"], "date"),
        (["2025-02-30"], "string"),
        (["2025-01-31", "2025-01-31 10:00:00"], "timestamp"),
        (["2025-01-31T10:00:00.123456"], "timestamp"),
        (["true", "False"], "boolean"),
        (["true", "1"], "string"),
        (["1", "x"], "string"),
        ([" 1"], "string"),
        ([None, None], "string"),
        ([None, "1"], "int"),
        (["9" * 39], "double"),
    ],
)
def test_narrowest_type(spark, values, expected):
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    mask = frame.agg(F.bit_or(column_types.ruled_out(F.col("v")))).first()[0]
    assert column_types.narrowest(mask) == expected
    if expected != "string":
        assert frame.where(F.col("v").isNotNull() & F.col("v").try_cast(expected).isNull()).count() == 0


VALUES = [
    "1", "-7", "+3", "007", "2147483648", "99999999999999999999", "1.5", ".5", "5.", "1e5", "1.", "NaN", "-Infinity", "1d",
    "0x1p3", "1-2", " 1", "1 ", "\t1", "", "2025-01-31", "2025-02-30", "2025-1-31", "2025-01-31 10:00:00",
    "2025-01-31T9:05", "2025-01-31 10:00:00.123456", "2025-01-31 25:00", "2025-01-31 10", "true", "TRUE", "t", "x",
    "Ж", "3000000000", "12345678901234567890123456789012345678", "-", "+", ".", "10:30", "2025-01-31 10:00:00Z",
]


@pytest.mark.parametrize("kind", column_types.CANDIDATES)
def test_what_surely_fits_does_fit(spark, kind):
    """The cheap test never passes a value that the full test refuses."""
    frame = spark.createDataFrame([(v,) for v in VALUES], "v string")
    tested = frame.select(
        "v", F.coalesce(column_types.surely_fits(F.col("v"), kind), F.lit(False)).alias("sure"),
        column_types.does_not_fit(column_types.ruled_out(F.col("v")), kind).alias("refused"),
        F.col("v").try_cast(kind).isNotNull().alias("casts"),
    ).collect()
    assert [r["v"] for r in tested if r["sure"] and r["refused"]] == []
    assert [r["v"] for r in tested if not r["refused"] and not r["casts"]] == []
    assert any(r["sure"] for r in tested)


def test_masks_with_and_without_expectation(spark):
    rows = [("a", "1", "x", None), ("a", "2", "y", None), ("b", "3", "z", "true"), ("c", "4.5", "w", None)]
    frame = spark.createDataFrame(rows, "k string, n string, s string, late string")
    columns = [F.col(c) for c in ("n", "s", "late")]
    full = {(r["k"], r["position"]): r["mask"] for r in column_types.column_masks(frame, "k", columns).collect()}
    assert column_types.narrowest(full["a", 0] | full["b", 0]) == "int"
    assert column_types.narrowest(full["c", 0]) == "double"
    some = {(r["k"], r["position"]): r["mask"] for r in
            column_types.column_masks(frame, "k", columns, ["int", "string", None]).collect()}
    assert some == {("c", 0): full["c", 0], ("b", 2): full["b", 2]}
