"""Personal data: base patterns, and terms that give protected entities away by their co-occurrence."""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.llm.common import Bits, arrow_batch, attach, packed, rest_field, salted, slices, spark_schema, texts_of, tidy, unpacked
from quayside.session import materialize

#: The kinds in the order of the contract, then the method's own.
BASE_KINDS = ("email", "ip", "card", "phone")
GENERALISED, REMOVED = "term", "secret"
KINDS = (*BASE_KINDS, GENERALISED, REMOVED)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMERIC = re.compile(r"[0-9][0-9.\x20-]*")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"\w+(?:['’-]\w+)*")

Span = tuple[str, int, int]


@dataclass(frozen=True)
class Disclosure:
    """How terms are judged.

    A term t reveals an entity e as far as p(e | t), the share of its documents that hold e, is known to be high: the
    lower end of Wilson's interval counts, so one common document says little and a size of the corpus nothing. -log2
    of it is the information about e that t leaves open. A rare entity is judged with those of its pool too: the
    domain of an address, the first digits of a number. Documents of equal terms are one to the interval.
    """

    #: Standard deviations of the interval: 95 % one-sided.
    deviations: float = 1.645
    #: From this lower end of p(e | t) on a term is generalised (one bit is left open), and from ``remove`` on removed.
    generalise: float = 0.5
    remove: float = 0.65
    #: Bits that the term must tell more than documents of like length do without it.
    gain: float = 3.0


def _emails(text: str) -> Iterator[Span]:
    """By the @: the local part reaches left to the last match or @ at most, so long runs are read once."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        floor = match.end() if match else at + 1
        if match:
            yield "email", start, floor
        at = text.find("@", floor)


def _luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def _numeric(text: str) -> tuple[list[Span], list[Span]]:
    """Addresses and cards; both lie within runs of digits, dots, spaces and hyphens."""
    ips: list[Span] = []
    cards: list[Span] = []
    for run in _NUMERIC.finditer(text):
        if run.end() - run.start() < 7:
            continue
        if "." in run[0]:
            for chain in _CHAIN.finditer(text, run.start(), run.end()):
                parts = chain[0].split(".")
                at = chain.start()
                # The pattern takes the parts of a chain four by four.
                for k in range(0, len(parts) - 3, 4):
                    four = parts[k : k + 4]
                    end = at + sum(map(len, four)) + 3
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                        ips.append(("ip", at, end))
                    at = end + 1
        for card in _CARD.finditer(text, run.start(), run.end()):
            if card.end() - card.start() >= 16:
                digits = card[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    cards.append(("card", card.start(), card.end()))
    return ips, cards


def base_spans(text: str) -> list[Span]:
    """Base personal data of a text: kinds in their order, each by start; code points, end exclusive."""
    ips, cards = _numeric(text)
    phones = []
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 8 <= sum(c in "0123456789" for c in match[0]) <= 15:
                phones.append(("phone", match.start(), match.end()))
    return [*_emails(text), *ips, *cards, *phones]


def uncovered(text: str, spans: list[Span]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) for the words of a text, as far as no base data covers them."""
    covered = sorted((start, end) for _, start, end in spans)
    starts = [start for start, _ in covered]
    # Furthest end of the spans up to each, so a word is held against all of them in one search.
    reach = list(accumulate((end for _, end in covered), max))
    for m in _TERM.finditer(text):
        before = bisect_left(starts, m.end())
        if not before or reach[before - 1] <= m.start():
            yield m[0].lower(), m.start(), m.end()


def _terms(text: str) -> set[str]:
    return {word.lower() for word in set(_TERM.findall(text))}


def _pool(kind: str, value: str) -> str:
    """What an entity has in common with its like: domain, network, first six digits."""
    if kind == "email":
        return value[value.rfind("@") :]
    if kind == "ip":
        return value[: value.rfind(".") + 1]
    return "".join(c for c in value if c in "0123456789")[:6]


def _entities(text: str, spans: list[Span]) -> list[bytes]:
    """Entities of a text and their pools, each once."""
    values = {(kind, text[a:b].lower()) for kind, a, b in spans}
    return list({_digest(f"{kind}:{v}") for kind, v in values} | {_digest(f"{kind}={_pool(kind, v)}") for kind, v in values})


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode(), digest_size=16).digest()


_SPANS = T.ArrayType(spark_schema([("kind", T.StringType()), ("start", T.IntegerType()), ("end", T.IntegerType())]))


def find_mentions(rows: DataFrame) -> DataFrame:
    """Packed rows with base data, under a number of their own: rest, text, spans, entities and their pools (each once,
    as hashes), terms and a hash of all terms."""
    schema = T.StructType([rows.schema["rest"], *spark_schema([
        ("text", T.StringType()), ("spans", _SPANS), ("entities", T.ArrayType(T.BinaryType())), ("terms", T.ArrayType(T.StringType())),
        ("alike", T.BinaryType()),
    ]).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = texts_of(part)
                own = [base_spans(text or "") for text in texts]
                at = [i for i, found in enumerate(own) if found]
                if not at:
                    continue
                terms = [sorted(_terms(texts[i])) for i in at]
                yield arrow_batch(arrow, {
                    "rest": part.column("rest").take(pa.array(at)).cast(arrow.field("rest").type),
                    "text": [texts[i] for i in at],
                    "spans": [[{"kind": k, "start": a, "end": b} for k, a, b in own[i]] for i in at],
                    "entities": [_entities(texts[i], own[i]) for i in at],
                    "terms": terms,
                    "alike": [_digest("\n".join(t)) for t in terms],
                })

    found = rows.select("rest", "text").mapInArrow(tidy(run), schema)
    return materialize(found.withColumn("row", F.monotonically_increasing_id()), "mentions")


def without_mentions(rows: DataFrame) -> DataFrame:
    """rest and text of the packed rows that have no base data; with those of ``find_mentions`` all rows."""
    schema = T.StructType([rows.schema["rest"], T.StructField("text", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                plain = part.filter(pa.array([not base_spans(text or "") for text in texts_of(part)]))
                yield arrow_batch(arrow, {f.name: plain.column(f.name).cast(f.type) for f in arrow})

    return rows.select("rest", "text").mapInArrow(tidy(run), schema)


def _term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """n_t: in how many documents each term is found, for terms in ``terms`` and some that share their bucket."""
    wanted = Bits(terms, F.crc32(F.encode("term", "UTF-8")), terms.count())
    schema = spark_schema([("term", T.StringType()), ("n", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                for text in texts_of(part):
                    counts.update(_terms(text or ""))
                if len(counts) > 200_000:
                    yield flushed(counts)
                    counts.clear()
        yield flushed(counts)

    def flushed(counts: Counter) -> pa.RecordBatch:
        found = wanted.has(np.fromiter((zlib.crc32(t.encode()) for t in counts), np.uint64, len(counts))).tolist()
        some = [item for item, is_found in zip(counts.items(), found) if is_found]
        return arrow_batch(arrow, {"term": [t for t, _ in some], "n": [n for _, n in some]})

    return docs.select("text").mapInArrow(tidy(run), schema).groupBy("term").agg(F.sum("n").alias("n_t"))


def _revealed(n_et: Column, n_alike: Column, rule: Disclosure) -> Column:
    """Lower end of p(e | t), of ``n_et`` of the term's n_t documents, ``n_alike`` different ones; grows with both."""
    share = n_et / F.col("n_t")
    n = n_alike * F.col("n_t") / n_et
    z = F.lit(rule.deviations)
    return (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _length_class(text: Column) -> Column:
    """Texts of like length: by powers of two."""
    return F.floor(F.log2(F.coalesce(F.octet_length(text), F.lit(0)) + 1)).cast("int")


def _bundles(docs: DataFrame, mentions: DataFrame, rule: Disclosure) -> DataFrame:
    """row, bundle, n_e and share of the entities and pools that a term could reveal at all.

    Those that the very same rows hold are one bundle, as counts cannot tell them apart. ``share`` is that of n_e in the
    documents of like length, from half of its own documents' to twice as long. Entities of too few documents are left out here, before they meet terms.
    """
    sizes = {r["size"]: r["count"] for r in docs.groupBy(_length_class(F.col("text")).alias("size")).count().collect()}
    up_to = [0]
    for size in range(max(sizes, default=0) + 1):
        up_to.append(up_to[-1] + sizes.get(size, 0))
    held = mentions.select("row", _length_class(F.col("text")).alias("size"), F.explode("entities").alias("entity"))
    held = materialize(held, "entities")
    of = held.groupBy("entity").agg(
        F.count("*").alias("n_e"), F.min("size").alias("shortest"), F.max("size").alias("longest"),
        # Together as good as the set of rows itself.
        F.struct(*[F.bit_xor(F.xxhash64("row", F.lit(seed))).alias(f"h{seed}") for seed in (1, 2)]).alias("bundle"),
    )
    known = of.withColumn("n_t", F.col("n_e")).where(_revealed(F.col("n_e"), F.col("n_e"), rule) >= rule.generalise).drop("n_t")
    named = attach(held, materialize(known, "bundles"), ["entity"], "n_e", held.count())
    total = F.array(*[F.lit(n) for n in up_to])
    like = F.element_at(total, F.least(F.col("longest") + 3, F.lit(len(up_to)))) - F.element_at(total, F.greatest("shortest", F.lit(1)))
    bundle = F.struct("n_e", "bundle.h1", "bundle.h2").alias("bundle")
    return materialize(named.select("row", bundle, "n_e", (F.col("n_e") / like).alias("share")).distinct(), "held")


def found_marks(docs: DataFrame, mentions: DataFrame, rule: Disclosure) -> DataFrame:
    """row and marks (term, level): the terms, anywhere in a row, that reveal an entity or pool which the row holds."""
    bundles = _bundles(docs, mentions, rule)
    rows = mentions.join(bundles.select("row").distinct(), "row", "left_semi")
    terms = materialize(rows.select("row", "alike", F.explode("terms").alias("term")), "terms")
    here = materialize(terms.groupBy("term").agg(F.count("*").alias("n_here")), "terms-here")
    n_t = materialize(_term_counts(docs, here).join(here, "term"), "term-counts")
    # A term of too few documents, or of far more than an entity has, is left out here, nothing else.
    could = n_t.where(_revealed(F.col("n_here"), F.col("n_here"), rule) >= rule.generalise)
    counted = attach(terms, materialize(could, "known-terms"), ["term"], "n_here", terms.count())
    most = F.least("n_e", "n_here")
    # Dealt by row and term, so that a row of very many of both is not one task's.
    met = salted(counted, bundles, ["row"], "term", hint="merge").where(_revealed(most, most, rule) >= rule.generalise)
    met = materialize(met.select("row", "alike", "bundle", "share", "term", "n_t"), "met")
    level = F.when(F.col("bound") >= rule.remove, REMOVED).otherwise(GENERALISED)
    same = met.groupBy("bundle", "term", "alike").agg(F.count("*").alias("n"), F.first("n_t").alias("n_t"), F.first("share").alias("share"))
    judged = same.groupBy("bundle", "term").agg(
        F.sum("n").alias("n_et"), F.count("*").alias("n_alike"), F.first("n_t").alias("n_t"), F.first("share").alias("share")
    )
    judged = judged.withColumn("bound", _revealed(F.col("n_et"), F.col("n_alike"), rule))
    judged = judged.where((F.col("bound") >= rule.generalise) & (F.log2(F.col("bound") / F.col("share")) >= rule.gain))
    judged = materialize(judged.select("bundle", "term", "n_et", level.alias("level")), "disclosing")
    marked = attach(met.select("row", "bundle", "term"), judged, ["bundle", "term"], "n_et", met.count())
    return marked.groupBy("row").agg(F.collect_set(F.struct("term", "level")).alias("marks"))


def _with_marks(docs: DataFrame, mentions: DataFrame, rule: Disclosure) -> DataFrame:
    """rest, text, spans and marks of the rows with base data; a null doc_id has no marks."""
    marked = mentions.where(F.col("rest.doc_id").isNotNull()).select("row")
    marks = found_marks(docs, mentions, rule).join(marked, "row", "left_semi")
    return mentions.join(marks, "row", "left").select("rest", "text", "spans", "marks")


def _spans_of(batch: pa.RecordBatch) -> Iterator[tuple[str, list[Span]]]:
    """Text and all spans of each row of ``_with_marks``: base data first, then the method's."""
    for text, spans, marks in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "marks"))):
        own = [(s["kind"], s["start"], s["end"]) for s in spans]
        yield text, own + _added(text, own, marks or [])


def all_spans(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """doc_id and spans of every row: base data first, then the method's, each kind by start. Texts without base data stay where they are.

    A null or empty text has no spans. Every row is a document to the counts and is marked for the entities
    it holds itself; a null doc_id has base spans only. No rows, no rows; other columns are not read.
    """
    rows = packed(docs.select("doc_id", "text"))
    mentions = find_mentions(rows)
    schema = spark_schema([("doc_id", docs.schema["doc_id"].dataType), ("spans", _SPANS)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                spans = [[{"kind": k, "start": a, "end": b} for k, a, b in own] for _, own in _spans_of(part)]
                yield arrow_batch(arrow, {"doc_id": part.column("doc_id"), "spans": spans})

    marked = _with_marks(docs, mentions, rule).select(F.col("rest.doc_id").alias("doc_id"), "text", "spans", "marks")
    others = without_mentions(rows).select("rest.doc_id", F.array().cast(_SPANS).alias("spans"))
    return marked.mapInArrow(tidy(run), schema).unionByName(others)


def _added(text: str, own: list[Span], marks) -> list[Span]:
    """Spans of marked terms, by kind and start; a term that two entities mark takes the stronger level."""
    level: dict[str, str] = {}
    for mark in sorted(marks, key=lambda mark: KINDS.index(mark["level"])):
        level[mark["term"]] = mark["level"]
    spans = [(level[term], start, end) for term, start, end in uncovered(text, own) if term in level] if level else []
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


def _general(word: str) -> str:
    """What is left of a generalised term: that it is a number, a name or a word."""
    if any(c.isdigit() for c in word):
        return "[NUMBER]"
    return "[NAME]" if word[:1].isupper() else "[WORD]"


def sanitised(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; spans that overlap become one, by the first kind."""
    out, at = [], 0
    merged: list[list] = []
    for kind, start, end in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        new = _general(text[start:end]) if kind == GENERALISED else "" if kind == REMOVED else f"[{kind.upper()}]"
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """Documents with base data replaced by its kind and disclosing terms generalised or removed.

    Null texts stay null, empty ones empty; other columns pass. See ``all_spans`` for the rest.
    """
    rows = packed(docs)
    schema = T.StructType([rest_field(docs), T.StructField("text", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [sanitised(text, spans) for text, spans in _spans_of(part)]
                yield arrow_batch(arrow, {"rest": part.column("rest").cast(arrow.field("rest").type), "text": texts})

    changed = _with_marks(docs, find_mentions(rows), rule).mapInArrow(tidy(run), schema)
    return unpacked(changed.unionByName(without_mentions(rows)), docs.columns)
