"""Ranked lexical search: exact inner products by ball trees over sparse document vectors."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.llm.common import arrow_batch, bytes_of, slices, spark_schema
from quayside.session import materialize

#: ASCII to lower case, and to spaces what is no part of a term; bytes of other characters stay.
_PLAIN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


@dataclass(frozen=True)
class Search:
    """How items are held against documents."""

    top: int = 10
    #: Items of one pass over the documents; a pass ends before that where its terms reach ``terms``.
    items: int = 256
    terms: int = 1 << 16
    #: Documents of a tree, and of a leaf at most.
    tree: int = 4096
    leaf: int = 24


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a text in their order."""
    return (text or b"").translate(_PLAIN).split()


@dataclass
class Queries:
    """A block of items as postings: the items of a term (``item`` from ``start[t]`` on) and how often it is in them."""

    names: list
    vocabulary: dict[bytes, int]
    start: np.ndarray
    item: np.ndarray
    times: np.ndarray


def queries_of(block: list[tuple[object, Counter]]) -> Queries:
    vocabulary: dict[bytes, int] = {}
    postings = [(vocabulary.setdefault(t, len(vocabulary)), i, n) for i, (_, own) in enumerate(block) for t, n in own.items()]
    term, item, times = np.array(sorted(postings), np.int64).reshape(-1, 3).T
    return Queries([name for name, _ in block], vocabulary, np.searchsorted(term, np.arange(len(vocabulary) + 1)), item, times)


def item_blocks(items: DataFrame, plan: Search) -> Iterator[Queries]:
    """All items in blocks of bounded size; they come through the driver one partition at a time."""
    block: list[tuple[object, Counter]] = []
    size = 0
    for row in items.select("item_id", "text").toLocalIterator():
        own = Counter(terms_of(row["text"].encode() if row["text"] else None))
        if not own:
            continue
        if block and (len(block) >= plan.items or size + len(own) > plan.terms):
            yield queries_of(block)
            block, size = [], 0
        block.append((row["item_id"], own))
        size += len(own)
    if block:
        yield queries_of(block)


def document_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms with repeats) and, of the terms that are asked for, their numbers and counts; no row without a term."""
    kind = docs.schema["doc_id"].dataType
    counts = T.ArrayType(T.IntegerType(), False)
    schema = spark_schema([("doc_id", kind), ("n", T.LongType()), ("terms", counts), ("tf", counts)])
    arrow = to_arrow_schema(schema)
    # At most Search.terms words of one block of items.
    asked = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = asked.value
        for batch in batches:
            for part in slices(batch):
                rows: dict[str, list] = {"n": [], "terms": [], "tf": []}
                at = []
                for i, text in enumerate(bytes_of(part)):
                    words = terms_of(text)
                    if not words:
                        continue
                    own = Counter(filter(known.__contains__, words))
                    at.append(i)
                    rows["n"].append(len(words))
                    rows["terms"].append([known[t] for t in own])
                    rows["tf"].append(list(own.values()))
                yield arrow_batch(arrow, {"doc_id": part.column("doc_id").take(pa.array(at, pa.int64()))} | rows)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


class BallTree:
    """Sparse vectors (``cols`` and ``vals`` from ``start[i]`` on) below balls: a centroid and a radius each.

    ``bounds[node]`` is, for each item, at least the inner product with any vector of the node: that with the
    centroid plus radius times the item's length, each rounded upwards by more than doubles can lose.
    """

    def __init__(self, start: np.ndarray, cols: np.ndarray, vals: np.ndarray, asked: Queries, weight: np.ndarray, leaf: int):
        self.start, self.cols, self.vals = start, cols, vals
        self.asked, self.weight = asked, weight
        self.lengths = np.sqrt(np.bincount(asked.item, self._own(weight).astype(np.float64) ** 2, len(asked.names)))
        self.squares = np.add.reduceat(vals.astype(np.float64) ** 2, start[:-1])
        self.members: list[np.ndarray] = []
        self.children: list[tuple[int, int] | None] = []
        self.bounds: list[np.ndarray] = []
        self.scores: dict[int, np.ndarray] = {}
        self._grow(np.arange(len(start) - 1), leaf)

    def _own(self, weight: np.ndarray) -> np.ndarray:
        """What each posting adds per unit of a document's value: the term's weight, once for each time in the item."""
        return np.repeat(weight, np.diff(self.asked.start)) * self.asked.times

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' values, and which of the rows each belongs to."""
        sizes = self.start[rows + 1] - self.start[rows]
        owner = np.repeat(np.arange(len(rows)), sizes)
        first = np.cumsum(sizes) - sizes
        return np.arange(len(owner)) - np.repeat(first - self.start[rows], sizes), owner

    def _times(self, rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
        at, owner = self._entries(rows)
        return np.bincount(owner, self.vals[at] * vector[self.cols[at]], len(rows))

    def _node(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of a node, and how far its rows are from the centroid (squared)."""
        at, _ = self._entries(rows)
        centre = np.bincount(self.cols[at], self.vals[at], len(self.weight)) / len(rows)
        own = float(centre @ centre)
        far = self.squares[rows] - 2 * self._times(rows, centre) + own
        # Errors of the three terms are below 1e-12 of them: as much is added to the radius, and to the bound.
        radius = math.sqrt(max(float(far.max()), 0.0) + 1e-9 * (float(self.squares[rows].max()) + own))
        product = np.bincount(
            self.asked.item, self._own(self.weight).astype(np.float64) * np.repeat(centre, np.diff(self.asked.start)), len(self.lengths)
        )
        return product + self.lengths * radius + 1e-9 * self.lengths * (math.sqrt(own) + radius) + 1, far

    def _grow(self, rows: np.ndarray, leaf: int) -> int:
        bounds, far = self._node(rows)
        node = len(self.members)
        self.members.append(rows)
        self.bounds.append(bounds)
        self.children.append(None)
        if len(rows) > leaf:
            # Two far rows draw the others to themselves; the middle of the projections parts them evenly.
            a = rows[int(far.argmax())]
            towards = self._times(rows, self._dense(a))
            away = self.squares[rows] - 2 * towards
            b = rows[int(away.argmax())]
            side = towards - self._times(rows, self._dense(b))
            order = np.argsort(side, kind="stable")
            half = len(rows) // 2
            self.children[node] = self._grow(rows[order[:half]], leaf), self._grow(rows[order[half:]], leaf)
        return node

    def _dense(self, row: int) -> np.ndarray:
        vector = np.zeros(len(self.weight))
        vector[self.cols[self.start[row] : self.start[row + 1]]] = self.vals[self.start[row] : self.start[row + 1]]
        return vector

    def leaf_scores(self, node: int) -> np.ndarray:
        """Scores of a leaf's rows for all items, in 64-bit integers; kept, as the items meet in the leaves they share."""
        if node not in self.scores:
            rows = self.members[node]
            at, owner = self._entries(rows)
            term, value = self.cols[at], self.vals[at]
            sizes = np.diff(self.asked.start)[term]
            first = np.cumsum(sizes) - sizes
            posting = np.arange(int(sizes.sum())) - np.repeat(first - self.asked.start[term], sizes)
            found = np.zeros((len(self.lengths), len(rows)), np.int64)
            added = np.repeat(value * self.weight[term], sizes) * self.asked.times[posting]
            np.add.at(found, (self.asked.item[posting], np.repeat(owner, sizes)), added)
            self.scores[node] = found
        return self.scores[node]

    def search(self, item: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and scores of the leaves that may hold a score of ``least``, best bound first; a larger ``least`` may be sent."""
        heap = [(-self.bounds[0][item], 0)]
        while heap and -heap[0][0] >= least:
            node = heapq.heappop(heap)[1]
            if self.children[node] is None:
                raised = yield self.members[node], self.leaf_scores(node)[item]
                least = max(least, raised or 0)
            else:
                for child in self.children[node]:
                    if (bound := self.bounds[child][item]) >= least:
                        heapq.heappush(heap, (-bound, child))


class Best:
    """The highest scores of an item so far, equal ones by ascending id; null ids come last."""

    def __init__(self, top: int):
        self.top = top
        self.rows: list[tuple] = []
        #: Score that a row must reach.
        self.least = 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        for i in np.flatnonzero(scores >= self.least).tolist():
            self.rows.append((-int(scores[i]), ids[i] is None, ids[i] if ids[i] is not None else 0))
        self.rows = heapq.nsmallest(self.top, self.rows)
        if len(self.rows) == self.top:
            self.least = max(1, -self.rows[-1][0])


def best_in_trees(projected: DataFrame, asked: Queries, weight: np.ndarray, n_docs: int, length: int, plan: Search) -> DataFrame:
    """item (place in the block), doc_id and score: of each task's documents the highest per item.

    A task holds one tree of ``plan.tree`` documents at a time; the thresholds it has reached go on to its next tree.
    """
    schema = spark_schema([("item", T.IntegerType()), ("doc_id", projected.schema["doc_id"].dataType), ("score", T.LongType())])
    arrow = to_arrow_schema(schema)
    shared = projected.sparkSession.sparkContext.broadcast((asked, weight))

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, plan.tree):
                held.append(batch.slice(at, plan.tree))
                if sum(b.num_rows for b in held) >= plan.tree:
                    yield pa.Table.from_batches(held)
                    held = []
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, weights = shared.value
        best = [Best(plan.top) for _ in own.names]
        for rows in trees(batches):
            rows = rows.combine_chunks()
            ids = rows.column("doc_id").to_pylist()
            terms, tf = (rows.column(c).chunk(0) if rows.num_rows else None for c in ("terms", "tf"))
            if terms is None:
                continue
            sizes = np.diff(terms.offsets.to_numpy())
            cols = terms.flatten().to_numpy().astype(np.int64)
            times = tf.flatten().to_numpy().astype(np.int64)
            m = 25 + 75 * rows.column("n").to_numpy() * n_docs // length
            vals = 1_000_000_000 * times // (1000 * times + 8 * np.repeat(m, sizes))
            tree = BallTree(np.concatenate([[0], np.cumsum(sizes)]), cols, vals, own, weights, plan.leaf)
            for item, found in enumerate(best):
                visits = tree.search(item, found.least)
                step = next(visits, None)
                while step is not None:
                    members, scores = step
                    found.add(scores, [ids[i] for i in members.tolist()])
                    try:
                        step = visits.send(found.least)
                    except StopIteration:
                        step = None
        rows = [(i, None if null else key, -score) for i, found in enumerate(best) for score, null, key in found.rows]
        yield arrow_batch(arrow, {name: [r[k] for r in rows] for k, name in enumerate(arrow.names)})

    some = projected.where(F.size("terms") > 0)
    return some.mapInArrow(run, schema)


def _search_block(docs: DataFrame, asked: Queries, plan: Search) -> DataFrame:
    projected = materialize(document_terms(docs, asked.vocabulary), "terms")
    n_docs, length = projected.agg(F.count("*"), F.sum("n")).first()
    # A row per term of the block.
    held = projected.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    df = {row["term"]: row["df"] for row in held}
    weight = np.array(
        [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(asked.vocabulary))], np.int64
    )
    found = best_in_trees(projected, asked, weight, n_docs, length or 1, plan)
    found = materialize(found, "found")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= plan.top)
    name = F.element_at(F.array(*[F.lit(n) for n in asked.names]), F.col("item") + 1).alias("item_id")
    return ranked.select(name, "rank", "doc_id", "score")


def ranked_documents(docs: DataFrame, items: DataFrame, plan: Search = Search()) -> DataFrame:
    """item_id, rank, doc_id and score: the documents of the highest scores for each item.

    Items are a query set: all of them are held, in blocks, against all documents. A block's terms are what documents
    are projected on, which changes no inner product with it; whole texts are read and counted. Each task builds ball
    trees over its documents and searches them best bound first; its best rows per item are what is shuffled.

    Null and empty texts have no terms: as documents they are not counted, as items they have no rows. Rows of one
    doc_id are documents each, of one item_id items each, ranked apart. Equal scores go by ascending doc_id, null
    last. No documents or no items, no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    schema = spark_schema([("item_id", kind), ("rank", T.IntegerType()), ("doc_id", docs.schema["doc_id"].dataType), ("score", T.LongType())])
    found = [materialize(_search_block(docs, asked, plan).to(schema), "ranked") for asked in item_blocks(items, plan)]
    return reduce(DataFrame.unionByName, found, spark.createDataFrame([], schema))


#: The same in DuckDB's SQL.
SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY doc_id),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS length FROM lengths),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), totals),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * (1000000000 * tf // (1000 * tf + 8 * (25 + 75 * n * n_docs // length)))) AS BIGINT) AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10"""
