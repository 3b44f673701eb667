"""Near-duplicate documents: MinHash, banding, verification on full shingle sets, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.llm.common import Bits, arrow_batch, attach, bytes_of, runs, salted, slices, spark_schema, tidy
from quayside.llm.components import components, lowest_in_tile
from quayside.session import materialize

_KNOWN_WORDS = 300_000
_PIECE = 512


@dataclass(frozen=True)
class MinHash:
    """Shingles of ``shingle`` words; bands x rows universal hash minima; links from ``percent`` % on.

    With 32 bands of 4 minima two sets at the threshold of 80 % fail to meet in any band with probability 5e-8.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    seed: int = 1
    #: Members of a bucket that one task compares with as many others.
    tile: int = 512

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Odd factors and offsets of the multiply-add-shift family."""
        rng = np.random.default_rng(self.seed)
        n = self.bands * self.rows
        return rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)

    def least_alike(self) -> int:
        """Equal minima that a pair at the threshold falls short of less than once in 1e9: six deviations below."""
        n, p = self.bands * self.rows, self.percent / 100
        return int(n * p - 6 * (n * p * (1 - p)) ** 0.5)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sorted hashes of the different shingles of a text."""

    def __init__(self, width: int):
        self.factors = [np.uint64(xxhash.xxh3_64_intdigest(bytes([k])) | 1) for k in range(width)]
        self.width = width
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()
        known = self.known
        if len(known) > _KNOWN_WORDS:
            known.clear()
        for word in words:
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word)
        hashed = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if not len(words):
            return hashed
        width = min(self.width, len(words))
        total = np.full(len(words) - width + 1, np.uint64(width))
        with np.errstate(over="ignore"):
            for k in range(width):
                total += hashed[k : len(hashed) - width + 1 + k] * self.factors[k]
        return np.unique(_mix(total))


def minima(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lowest value of each hash over all shingles."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), _PIECE):
            values = shingles[at : at + _PIECE, None] * factors + offsets
            np.minimum(low, values.min(axis=0), out=low)
    return low


def signatures(docs: DataFrame, plan: MinHash) -> DataFrame:
    """doc_id, n_shingles, two halves of the set's hash, band keys, and a byte of each minimum."""
    schema = spark_schema([
        ("doc_id", docs.schema["doc_id"].dataType), ("n_shingles", T.LongType()), ("h1", T.LongType()), ("h2", T.LongType()),
        ("bands", T.ArrayType(T.LongType(), False)), ("minima", T.BinaryType()),
    ])
    arrow = to_arrow_schema(schema)
    factors, offsets = plan.hashes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(plan.shingle)
        salts = _mix(np.arange(1, plan.bands + 1, dtype=np.uint64))
        weights = _mix(np.arange(101, 101 + plan.rows, dtype=np.uint64)) | np.uint64(1)
        for batch in batches:
            for part in slices(batch):
                rows: dict[str, list] = {c: [] for c in arrow.names[1:]}
                for text in bytes_of(part):
                    found = shingler(text)
                    h1, h2 = _halves(found.tobytes())
                    low = minima(found, factors, offsets)
                    with np.errstate(over="ignore"):
                        keys = _mix((_mix(low).reshape(plan.bands, plan.rows) * weights).sum(axis=1) + salts)
                    rows["n_shingles"].append(len(found))
                    rows["h1"].append(h1)
                    rows["h2"].append(h2)
                    rows["bands"].append(keys.view(np.int64) if len(found) else [])
                    rows["minima"].append((_mix(low) & np.uint64(255)).astype(np.uint8).tobytes())
                yield arrow_batch(arrow, {"doc_id": part.column("doc_id")} | rows)

    return docs.select("doc_id", "text").mapInArrow(tidy(run), schema)


def _halves(shingles: bytes) -> tuple[int, int]:
    """The set's hash."""
    whole = xxhash.xxh3_128_digest(shingles)
    return int.from_bytes(whole[:8], "little", signed=True), int.from_bytes(whole[8:], "little", signed=True)


def shingle_sets(docs: DataFrame, plan: MinHash, wanted: Bits) -> DataFrame:
    """doc_id, two halves of the set's hash and shingles (sorted 64-bit hashes as bytes) of the rows whose doc_id is wanted.

    Texts stay where they are; each set leaves its task once.
    """
    schema = spark_schema([
        ("doc_id", docs.schema["doc_id"].dataType), ("h1", T.LongType()), ("h2", T.LongType()), ("shingles", T.BinaryType()),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(plan.shingle)
        for batch in batches:
            batch = batch.filter(pa.array(wanted.has(batch.column("number").to_numpy())))
            for part in slices(batch) if batch.num_rows else ():
                sets = [shingler(text).tobytes() for text in bytes_of(part)]
                h1, h2 = zip(*map(_halves, sets))
                yield arrow_batch(arrow, {"doc_id": part.column("doc_id"), "h1": h1, "h2": h2, "shingles": sets})

    return docs.select("doc_id", "text", F.xxhash64("doc_id").alias("number")).mapInArrow(tidy(run), schema)


def _meeting(classes: DataFrame, keys: Bits) -> DataFrame:
    """Classes with a band key that may be one of the given ones, and these as ``keys``."""
    schema = T.StructType([*classes.schema.fields, T.StructField("keys", T.ArrayType(T.LongType(), False))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bands = batch.column("bands")
            sizes = np.diff(bands.offsets.to_numpy())
            every = bands.flatten().to_numpy()
            found = keys.has(every)
            row = np.repeat(np.arange(len(sizes)), sizes)[found]
            own = np.bincount(row, minlength=len(sizes))
            some = np.flatnonzero(own)
            kept = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(own[some])]).astype(np.int32), every[found])
            few = batch.take(pa.array(some))
            yield arrow_batch(arrow, {c: few.column(c).cast(arrow.field(c).type) for c in few.schema.names} | {"keys": kept.cast(arrow.field("keys").type)})

    return classes.mapInArrow(tidy(run), schema)


def _spread(pairs: DataFrame, bulk: DataFrame, side: str, value: str, name: str) -> DataFrame:
    """Add the bulky ``value`` of ``bulk`` (one row per id) to pairs by their ``side``.

    An id in very many pairs gets its row repeated, once for each 1,024 of its pairs, so that they part
    into as many join keys; bulky rows are never broadcast.
    """
    uses = pairs.groupBy(side).agg(F.count("*").alias("uses"))
    uses = materialize(uses.select(side, "uses", F.floor(F.col("uses") / 1024).alias("salts")), "uses")
    salted = attach(pairs, uses, [side], "uses", pairs.count()).withColumn("salt", F.pmod(F.xxhash64("a", "b"), F.col("salts") + 1))
    copies = bulk.join(uses, bulk["id"] == uses[side]).select(
        side, F.col(value).alias(name), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts"))).alias("salt")
    )
    return salted.join(copies, [side, "salt"]).drop("salt", "salts", "uses")


def verified(pairs: DataFrame, minima_of: DataFrame, sets: DataFrame, plan: MinHash) -> DataFrame:
    """Pairs (a, b) whose minima agree often enough and whose full sets reach the threshold."""
    close = _spread(_spread(pairs, minima_of, "a", "minima", "x"), minima_of, "b", "minima", "y")
    least, percent = plan.least_alike(), plan.percent

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in "xy")
                yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least))

    kind = pairs.schema["a"].dataType
    schema = spark_schema([("a", kind), ("b", kind)])
    close = materialize(close.select("a", "b", "x", "y").mapInArrow(alike, schema), "alike")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    full = _spread(_spread(close, sets, "a", "shingles", "x"), sets, "b", "shingles", "y")
    return full.select("a", "b", "x", "y").mapInArrow(reach, schema)


_TILE = ["key", "low", "high"]


def _tiles(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_TILE).sortWithinPartitions(*_TILE)


def _sides(tile: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of a tile's left and right members, and whether they are the same."""
    part, low, high = tile.column("part").to_numpy(), tile.column("low")[0].as_py(), tile.column("high")[0].as_py()
    return np.flatnonzero(part == low), np.flatnonzero(part == high), low == high


def _undecided(members: DataFrame, opened: DataFrame, named: DataFrame, plan: MinHash) -> DataFrame:
    """Members of open buckets, by tile, that have a pair in another component whose minima agree enough.

    A bucket of n members is dealt to tiles of ``plan.tile`` members against as many, so a task holds two of
    these at a time. A pair that meets in several buckets counts in that of its first common band.
    """
    rows = attach(members, opened, ["key"], "n", members.count()).join(named, "id")
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit(plan.seed)), F.col("parts")))
    tiles = dealt.select(
        "key", "id", "component", "minima", "bands", "part",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"),
    )
    tiles = tiles.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    least = plan.least_alike()
    kind = members.schema["id"].dataType
    place = [("key", T.LongType()), ("low", T.LongType()), ("high", T.LongType()), ("part", T.LongType())]
    schema = spark_schema([*place, ("id", kind), ("component", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in runs(batches, _TILE):
            component = tile.column("component").to_numpy()
            values = np.frombuffer(b"".join(tile.column("minima").to_pylist()), np.uint8).reshape(len(component), -1)
            bands = np.stack(tile.column("bands").to_pylist())
            earlier = bands[:, : int((bands == tile.column("key")[0].as_py()).any(axis=0).argmax())]
            left, right, _ = _sides(tile)
            some = np.zeros(len(component), bool)
            for i in left.tolist():
                near = right[component[right] != component[i]]
                near = near[(values[near] == values[i]).sum(axis=1) >= least]
                near = near[~(earlier[near] == earlier[i]).any(axis=1)]
                some[near] = True
                some[i] |= len(near) > 0
            yield from tile.select(schema.names).filter(pa.array(some)).to_batches()

    return _tiles(tiles).mapInArrow(tidy(run), schema)


def common_shingles(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, columns: int = 4096) -> np.ndarray:
    """Size of the intersection of each left set with each other right one, by products of 0/1 matrices.

    Shingles that one set alone has are left out, so a set's count with itself is of no use.
    """
    every, at, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = uses > 1
    number = np.cumsum(shared) - 1
    owner, at = owner[shared[at]], number[at[shared[at]]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    both = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, int(shared.sum()), columns):
        a, b = np.searchsorted(at, [first, first + columns])
        held = np.zeros((len(sets), columns), np.float32)
        held[owner[a:b], at[a:b] - first] = 1
        both += held[left] @ held[right].T
    return both.astype(np.int64)


def _links_in_tiles(undecided: DataFrame, sets: DataFrame, plan: MinHash) -> DataFrame:
    """Links (a, b) that join the components of a tile's members, found on their full sets; at most one per member."""
    percent = plan.percent
    kind = undecided.schema["id"].dataType
    schema = spark_schema([("a", kind), ("b", kind)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in runs(batches, _TILE):
            ids, component = tile.column("id").to_numpy(), tile.column("component").to_numpy()
            own = [np.frombuffer(s.as_buffer(), np.uint64) for s in tile.column("shingles")]
            size = np.array([len(s) for s in own])
            left, right, _ = _sides(tile)
            both = common_shingles(own, left, right)
            linked = 100 * both >= percent * (size[left][:, None] + size[right] - both)
            linked &= component[left][:, None] != component[right]
            name = lowest_in_tile(ids, left, right, linked)
            yield arrow_batch(arrow, {"a": name[name != ids], "b": ids[name != ids]})

    return _tiles(undecided.join(sets, "id")).mapInArrow(tidy(run), schema)


def _shared_ids(some: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) between classes that share a doc_id: from one of its classes to each other one."""
    pair = F.struct("h1", "h2")
    several = some.groupBy("doc_id").agg(F.min(pair).alias("low"), F.max(pair).alias("high")).where(F.col("low") != F.col("high"))
    several = materialize(several.select("doc_id"), "several")
    if several.isEmpty():
        return several.select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    rows = some.select("doc_id", "h1", "h2").join(several, "doc_id", "left_semi").distinct()
    copies = materialize(rows.groupBy("h1", "h2").agg(F.count("*").alias("n")), "shared-classes")
    keys = materialize(copies.join(classes.select("h1", "h2", "id"), ["h1", "h2"]), "shared-numbers")
    rows = materialize(rows, "shared-rows")
    held = materialize(attach(rows, keys, ["h1", "h2"], "n", rows.count()).select("doc_id", "id"), "shared-ids")
    first = materialize(held.groupBy("doc_id").agg(F.min("id").alias("a"), F.count("*").alias("m")), "shared-firsts")
    edges = attach(held, first, ["doc_id"], "m", held.count()).where(F.col("a") != F.col("id"))
    return edges.select("a", F.col("id").alias("b"))


def near_duplicates(docs: DataFrame, plan: MinHash = MinHash()) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id it reaches by links) and kept (it is that one), per row.

    Texts of one shingle set are one class and go on under its number, so copies cost no pairs. Classes that
    share a doc_id are linked by it.
    Classes that share a band key meet in a bucket. First all members are verified against the bucket's
    first. Then whatever members of a bucket are still in different components are compared in tiles, where
    an edge per member stands for all links found. So no link between components is lost that banding finds,
    and nothing that is shuffled grows with the square of a group. Links on full sets alone join components.

    Null, empty and blank texts have an empty set: no links, a component of their own. A text of fewer words
    than a shingle is one shingle. Rows of one doc_id are one vertex; a null doc_id has no links, a
    null component and kept false. Other columns are not read. No rows, no rows.
    """
    signed = materialize(signatures(docs, plan), "signatures")
    some = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = some.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("bands").alias("bands"), F.first("minima").alias("minima")
    )
    classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()), "classes")

    banded = classes.select("id", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))
    buckets = materialize(buckets.where(F.col("first") < F.col("last")).select("key", "n", "first"), "buckets")
    # What is alone in all of its buckets is left behind before anything is joined.
    met = materialize(_meeting(classes, Bits(buckets, F.col("key"), buckets.count())), "met")
    members = salted(met.select("id", F.explode("keys").alias("key")), buckets, ["key"], "id").select("key", "id")
    members = materialize(members, "members")
    linked = members.select("id").distinct()
    wanted = materialize(met.drop("keys").join(linked, "id", "left_semi"), "wanted")
    minima_of = wanted.select("id", "minima", "bands")
    ids = wanted.select("doc_id", "h1", "h2", "id")
    # Rows of one doc_id may be of several classes; rows of one class have the same set, of which one goes on.
    sets = shingle_sets(docs, plan, Bits(ids, F.xxhash64("doc_id"), ids.count())).dropDuplicates(["doc_id", "h1", "h2"])
    sets = materialize(sets.join(ids, ["doc_id", "h1", "h2"]).select("id", "shingles"), "sets")

    # Round one: every member against its bucket's first; that is all there is to a bucket of two.
    shared = attach(members, buckets, ["key"], "n", members.count())
    pairs = shared.where(F.col("id") != F.col("first")).select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    links = verified(materialize(pairs, "candidates"), minima_of, sets, plan)
    found = materialize(components(links, "a", "b"), "components")
    # Round two: what larger buckets still hold apart. Each id has one row per band at most, so the joins are even.
    named = linked.join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
    named = materialize(named.join(minima_of, "id"), "named")
    larger = attach(members, buckets.where(F.col("n") > 2), ["key"], "n", members.count()).join(named, "id")
    state = larger.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    opened = state.where(F.col("low") < F.col("high")).select("key", "n", F.ceil(F.col("n") / plan.tile).alias("parts"))
    undecided = materialize(_undecided(members, materialize(opened, "open"), named, plan), "undecided")
    more = _links_in_tiles(undecided, sets, plan)
    joined = found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more)
    joined = joined.unionByName(_shared_ids(some, classes))
    found = materialize(components(joined, "a", "b"), "components")

    named = classes.select("h1", "h2", "doc_id", "id", "copies").join(found, "id", "left").select(
        "h1", "h2", "doc_id", "copies", F.coalesce("component", "id").alias("component")
    )
    named = materialize(named, "class-components")
    lowest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("size"))
    named = attach(named, materialize(lowest, "lowest"), ["component"], "size", named.count())
    named = materialize(named.select("h1", "h2", "copies", "component_id"), "named")
    rows = signed.select("doc_id", "n_shingles", "h1", "h2")
    inside = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    joined = attach(rows.where(inside), named, ["h1", "h2"], "copies", rows.count())
    joined = joined.select("doc_id", "n_shingles", "component_id")
    alone = rows.where(~inside).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return joined.unionByName(alone).withColumn("kept", kept)


def _parted(docs: DataFrame, ids: Bits, inside: bool) -> DataFrame:
    """The documents whose doc_id may be in a set, or those whose is not."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("row"), F.xxhash64(docs["doc_id"]).alias("number"))
    schema = T.StructType([rows.schema["row"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["row"]).filter(pa.array(ids.has(batch.column("number").to_numpy()) == inside))

    return rows.mapInArrow(tidy(run), schema).select("row.*")


def deduplicated(docs: DataFrame, plan: MinHash = MinHash()) -> DataFrame:
    """The documents that stay: one of each component, and every one without links. Repeated rows of one kept doc_id stay.

    Rows with a null doc_id, which cannot be told apart, stay. Texts stay where they are, but for those that go and a few
    others that a bit set does not tell from them.
    """
    drop = near_duplicates(docs, plan).where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    drop = materialize(drop, "dropped")
    ids = Bits(drop, F.xxhash64("doc_id"), drop.count())
    return _parted(docs, ids, False).unionByName(_parted(docs, ids, True).join(drop, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns]))
