"""What filters do to each other: every order of them, from one tensor of counts per part."""

from __future__ import annotations

from functools import cache
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import attach, spark_schema
from quayside.session import materialize

#: The filters' letters, in the order of the tensor's axes.
FILTERS = "ABCDE"
MEASURES = ("docs", "good", "toxic")
#: What an axis is contracted with; its places are pass and fail.
_PASS, _FAIL, _ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])

RESULT = spark_schema([
    ("part", T.StringType()), ("filter_order", T.StringType()), ("step", T.IntegerType()),
    *[(name, T.LongType()) for name in
      ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")],
])


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails; a null text is an empty one."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n_words, n_different = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = (
        n_words < 200, 100 * n_different < 50 * n_words, 100 * capitals.cast("long") > 3 * F.char_length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    )
    return sum((F.when(fail, 1 << bit).otherwise(0) for bit, fail in enumerate(fails)), F.lit(0))


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails (bits of all five filters), good and toxic of each document; texts are not shuffled, only their hashes.

    A document of which several labels tell takes the highest. Copies are found by SHA-256; a text that a third
    of all documents have is one hash, which ``attach`` broadcasts. A null doc_id is neither larger nor smaller than
    another, so its text is no copy and makes none, and it has no labels.
    """
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic")
    )
    own = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), text_failures(F.col("text")).alias("own"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest"),
    )
    rows = own.join(known, "doc_id", "left").select(
        "doc_id", "part", "own", "digest", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    )
    rows = materialize(rows, "audited")
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    shared = materialize(groups.where(F.col("first") < F.col("last")).select("digest", "first", "n"), "copied")
    joined = attach(rows, shared, ["digest"], "n", rows.count(), "left")
    copy = F.when(F.col("doc_id") > F.col("first"), 1 << FILTERS.index("E")).otherwise(0)
    return joined.select("part", (F.col("own") + copy).alias("fails"), "good", "toxic")


def counted(failed: DataFrame) -> DataFrame:
    """Rows of the tensors: part, fails and the measures; at most 32 of a part, added up before they are shuffled."""
    return failed.groupBy("part", "fails").agg(
        F.count("*").alias("docs"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )


def contractions(tensor: np.ndarray) -> pd.DataFrame:
    """All steps of all orders, for one part: ``tensor`` has the measures, then a pass and fail axis per filter."""
    axes = list(range(1, len(FILTERS) + 1))

    @cache
    def select(passed: str = "", failed: str = "") -> np.ndarray:
        vectors = [_PASS if f in passed else _FAIL if f in failed else _ALL for f in FILTERS]
        return np.einsum(tensor, [0, *axes], *[x for pair in zip(vectors, ([a] for a in axes)) for x in pair], [0])

    rows = []
    for order in map("".join, permutations(FILTERS)):
        for step, name in enumerate(order):
            earlier = "".join(sorted(order[:step]))
            removed = select(earlier, name)
            rows.append({
                "filter_order": order, "step": step + 1, "kept": select("".join(sorted(earlier + name)))[0], "removed": removed[0],
                "redundant": (select("", name) - removed)[0], "unique_fails": select(FILTERS.replace(name, ""), name)[0],
                "good_lost": removed[1], "toxic_lost": removed[2],
            })
    steps = pd.DataFrame(rows)
    letter = [order[step - 1] for order, step in zip(steps["filter_order"], steps["step"])]
    return steps.assign(shapley=steps.groupby(letter)["removed"].transform("sum"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (``lang``), order of the five filters and step; see ``RESULT``.

    Counts are made for whole tables first; what then goes to a task is a part's tensor of 3 x 32 numbers. Null and
    empty texts fail A alone (and E after the first). Null languages are the part ''. Repeated rows count each, and
    are no copies of their own id. No documents, no rows. Other columns are not read.
    """
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        tensor = np.zeros((len(MEASURES), 2 ** len(FILTERS)), np.int64)
        tensor[:, rows["fails"]] = rows[list(MEASURES)].to_numpy().T
        # The lowest bit is the first filter's, so its axis is the last of the reshaped ones.
        tensor = tensor.reshape(len(MEASURES), *[2] * len(FILTERS)).transpose(0, *range(len(FILTERS), 0, -1))
        return contractions(tensor).assign(part=rows["part"].iloc[0])[RESULT.names]

    return counted(failures(docs, labels)).groupBy("part").applyInPandas(run, RESULT)


#: The same in DuckDB's SQL.
SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
known AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS fails
  FROM texts LEFT JOIN known USING (doc_id)),
counts AS (
  SELECT part, fails, count(*) AS docs, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failed GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, step, bits[step] AS own, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)),
found AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, own,
         sum(CASE WHEN fails & (earlier | own) = 0 THEN docs ELSE 0 END) AS kept,
         sum(CASE WHEN fails & earlier = 0 AND fails & own > 0 THEN docs ELSE 0 END) AS removed,
         sum(CASE WHEN fails & earlier > 0 AND fails & own > 0 THEN docs ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = own THEN docs ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails & earlier = 0 AND fails & own > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails & earlier = 0 AND fails & own > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM found"""
