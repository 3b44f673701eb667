"""Byte-level BPE: merges replayed over all different words of a task's texts at once, and decoding."""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re
import unicodedata
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.llm.common import arrow_batch, packed, rest_field, slices, spark_schema, texts_of, unpacked

#: Words whose ids a worker keeps from one piece of its texts to the next; over it, it starts anew.
KNOWN_WORDS = 700_000

_NONE = np.int64(1) << 40


class MergeReplay:
    """Ids of words by a rank file: the lowest rank first, leftmost first, as in byte pair encoding."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.separator = max(self.tokens) + 1
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * (self.separator + 1) + right] = rank
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, or ``_NONE``."""
        keys = left * (self.separator + 1) + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NONE)

    def encode(self, words: Sequence[bytes]) -> list[list[int]]:
        """Ids of each word. A word that is a token is that token, before any merge."""
        out: list = [[self.ranks[w]] if w in self.ranks else None for w in words]
        left = [k for k, ids in enumerate(out) if ids is None and words[k]]
        for k, ids in zip(left, self._replay([words[k] for k in left])):
            out[k] = ids
        return [ids if ids is not None else [] for ids in out]

    def _replay(self, words: list[bytes]) -> list[list[int]]:
        """All words beneath one inverted index from rank to the positions of its pairs.

        Ranks are taken in order from a heap. A rank's live positions are merged together, left to right
        where they overlap, and only the pairs at the two neighbours of a merge are looked up again.
        """
        if not words:
            return []
        raw = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        token = self.byte_ids[raw]
        token[ends] = self.separator
        after = np.arange(1, len(raw) + 1)
        before = np.arange(-1, len(raw) - 1)
        pair = np.full(len(raw), _NONE)
        pair[:-1] = self.rank_of(token[:-1], token[1:])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def put(positions: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            firsts = ranks[np.concatenate(([0], cuts))].tolist()
            for rank, some in zip(firsts, np.split(positions, cuts)):
                if rank in index:
                    index[rank].append(some)
                else:
                    index[rank] = [some]
                    heapq.heappush(heap, rank)

        first = np.flatnonzero(pair < _NONE)
        if len(first):
            put(first, pair[first])
        out_of_order: set[int] = set()
        while heap:
            rank = heapq.heappop(heap)
            lists = index.pop(rank)
            at = np.unique(lists[0] if len(lists) == 1 else np.concatenate(lists))
            at = at[pair[at] == rank]
            if not len(at):
                continue
            overlap = after[at[:-1]] == at[1:]
            if overlap.any():
                numbers = np.arange(len(at))
                run = np.maximum.accumulate(np.where(np.concatenate(([True], ~overlap)), numbers, 0))
                at = at[(numbers - run) % 2 == 0]
            gone = after[at]
            following = after[gone]
            token[at], token[gone], pair[gone] = rank, -1, _NONE
            after[at], before[following] = following, at
            ahead = before[at]
            touched = np.concatenate((at, ahead[ahead >= 0]))
            new = self.rank_of(token[touched], token[after[touched]])
            pair[touched] = new
            if (early := new < rank).any():
                out_of_order.update(np.searchsorted(ends, touched[early]).tolist())
            live = new < _NONE
            if live.any():
                put(touched[live], new[live])
        stays = (token >= 0) & (token != self.separator)
        ids = token[stays].tolist()
        cuts = [0, *np.cumsum(stays)[ends].tolist()]
        out = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        # Where a merge made a pair of lower rank than its own, other places of the rank came too early.
        for k in out_of_order:
            out[k] = self._one(words[k])
        return out

    def _one(self, word: bytes) -> list[int]:
        """One word by a heap of (rank, position): exact also where merges make pairs of lower rank."""
        token = [int(self.byte_ids[b]) for b in word]
        after, before = list(range(1, len(token) + 1)), list(range(-1, len(token) - 1))

        def rank(k: int) -> int | None:
            nxt = after[k]
            return self.pairs.get(token[k] * (self.separator + 1) + token[nxt]) if nxt < len(token) else None

        heap = [(r, k) for k in range(len(token)) if (r := rank(k)) is not None]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            if token[k] < 0 or rank(k) != r:
                continue
            gone = after[k]
            token[k], token[gone] = r, -1
            after[k] = after[gone]
            if after[k] < len(token):
                before[after[k]] = k
            for place in (k, before[k]):
                if place >= 0 and (new := rank(place)) is not None:
                    heapq.heappush(heap, (new, place))
        return [t for t in token if t >= 0]

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@functools.cache
def replay_of(path: str) -> MergeReplay:
    """The merges of a rank file, read once per worker."""
    with open(path, "rb") as lines:
        return MergeReplay({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


@functools.cache
def _known(path: str, pattern: str) -> tuple[dict[str, list[int]], set[str], dict[str, str]]:
    """Ids of known words; characters met; those of them that this Python's tables don't know, with a stand-in."""
    return {}, set(), {}


_CLASS = re.compile(r"\\[pP](?:\{[^}]*\}|.)|\\[sSdDwW]")


@functools.cache
def _classes(pattern: str) -> list[tuple[regex.Pattern, tiktoken.Encoding]]:
    """The character classes of a pattern, as both libraries read them."""
    ranks = {bytes([b]): b for b in range(256)}
    return [
        (regex.compile(c), tiktoken.Encoding("class", pat_str=c, mergeable_ranks=ranks, special_tokens={}))
        for c in sorted(set(_CLASS.findall(pattern)))
    ]


@functools.cache
def _stand_in(pattern: str, classes: tuple[bool, ...]) -> str:
    """A character that Python's tables know, in just these classes of the pattern and nowhere in it as itself."""
    for c in map(chr, range(0x80, 0x110000)):
        if unicodedata.category(c) not in ("Cn", "Cs") and c not in pattern:
            if classes == tuple(bool(own.match(c)) for own, _ in _classes(pattern)):
                return c
    raise ValueError(f"no character stands in for one of classes {classes} of {pattern}")


def _stand_ins(characters: list[str], pattern: str) -> dict[str, str]:
    """For each character one that the pattern takes as tiktoken does this one."""
    text = "".join(characters)
    members = [set(bytes(library.encode_ordinary(text)).decode()) for _, library in _classes(pattern)]
    return {c: _stand_in(pattern, tuple(c in m for m in members)) for c in characters}


def encode_texts(texts: Sequence[str], path: str, pattern: str) -> Iterator[list[int]]:
    """Ids of each text. Words not met before by this worker are encoded together.

    Libraries differ in the newest characters that they know as letters. For one that is unassigned to
    Python's tables, tiktoken is asked for its classes, and the text is split with a stand-in of these.
    """
    (known, met, newest), split = _known(path, pattern), regex.compile(pattern)
    words = [split.findall(text) for text in texts]
    new = set(chain.from_iterable(words)).difference(known)
    characters = set("".join(new)).difference(met)
    met |= characters
    newest.update(_stand_ins([c for c in characters if unicodedata.category(c) == "Cn"], pattern))
    if newest:
        table = str.maketrans(newest)
        for k, text in enumerate(texts):
            if not newest.keys().isdisjoint(text):
                words[k] = [text[m.start() : m.end()] for m in split.finditer(text.translate(table))]
        new = set(chain.from_iterable(words)).difference(known)
    if len(known) + len(new) > KNOWN_WORDS:
        known.clear()
        new = set(chain.from_iterable(words))
    new = list(new)
    known.update(zip(new, replay_of(path).encode([w.encode() for w in new])))
    for own in words:
        yield list(chain.from_iterable(map(known.__getitem__, own)))


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Documents with their token ids, without special tokens; adds ids (array of int).

    The work on words is done once for each different word of a task's texts (see ``MergeReplay``), in
    pieces of bounded size; texts are not shuffled, so a hot source or copies change nothing. Known words
    are kept by the worker up to ``KNOWN_WORDS``.

    A null or empty text has no ids. Repeated rows, null ids and other columns pass as they are. An
    empty table gives an empty result. ``path`` is a rank file that every worker can read.
    """
    schema = T.StructType([rest_field(docs), *spark_schema([("text", T.StringType()), ("ids", T.ArrayType(T.IntegerType()))]).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [text or "" for text in texts_of(part)]
                ids = [np.array(own, np.int32) for own in encode_texts(texts, path, pattern)]
                rest = part.column("rest").cast(arrow.field("rest").type)
                yield arrow_batch(arrow, {"rest": rest, "text": part.column("text").cast(pa.string()), "ids": ids})

    return unpacked(packed(docs).mapInArrow(run, schema), docs.columns, ["ids"])


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Adds decoded (binary): the bytes of the ids. Null ids give no bytes."""
    schema = T.StructType([*[f for f in encoded.schema.fields if f.name != "decoded"], T.StructField("decoded", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = replay_of(path)
        for batch in batches:
            decoded = [merges.decode(own or []) for own in batch.column(ids).to_pylist()]
            columns = {f.name: batch.column(f.name).cast(f.type) for f in arrow if f.name != "decoded"}
            yield arrow_batch(arrow, columns | {"decoded": decoded})

    return encoded.drop("decoded").mapInArrow(run, schema)


def digest_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (decimal, joined by commas) and of the bytes decoded from them.

    The same as ``encode_documents`` and ``decode_documents`` one after the other, in one pass, so that
    the ids, larger than the texts, never leave the task.
    """
    schema = spark_schema([
        ("doc_id", docs.schema["doc_id"].dataType), ("n_tokens", T.LongType()),
        ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = replay_of(path)
        decimal = {rank: str(rank) for rank in merges.tokens}
        for batch in batches:
            for part in slices(batch):
                counts, digests, decoded = [], [], []
                for ids in encode_texts([text or "" for text in texts_of(part)], path, pattern):
                    counts.append(len(ids))
                    digests.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    decoded.append(hashlib.sha256(merges.decode(ids)).hexdigest())
                yield arrow_batch(arrow, {
                    "doc_id": part.column("doc_id"), "n_tokens": counts, "ids_sha256": digests, "decoded_sha256": decoded
                })

    return docs.select("doc_id", "text").mapInArrow(run, schema)
