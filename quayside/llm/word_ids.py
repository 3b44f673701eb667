"""Ids of whole texts by a word-level tokenizer file, at the price of its different words."""

from __future__ import annotations

import functools
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces of text whose ids a worker keeps; over it, it forgets all but those it needs at once.
KNOWN_PIECES = 700_000
#: Pieces that are learnt at a time: what the tokenizer tells of a piece takes many times the room of its ids.
LEARNT = 4096

#: Marks before a space, parted from the letter or digit they follow: the tokenizer parts them there itself.
#: Not after U+0130, whose small letter ends in a combining mark.
_MARKS = re.compile(r"[.,!?;:*$%&#](?<=[^\W_\u0130].)[.,!?;:*$%&#]*(?= |\Z)")


@functools.cache
def tokenizer_of(path: str):
    """The tokenizer, read once per worker; the worker's own threads are Spark's to plan."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _last_of_word(path: str) -> np.ndarray | None:
    """Which ids are the last of a word, for tokenizers that mark these; None for others."""
    tokenizer = tokenizer_of(path)
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    if not suffix:
        return None
    ids = tokenizer.get_vocab()
    last = np.zeros(max(ids.values()) + 1, bool)
    last[[number for token, number in ids.items() if token.endswith(suffix)]] = True
    return last


def _one_word(piece: str) -> bool:
    """Whether the tokenizer should see a single word here, with small letters and composed too."""
    return piece.isalpha() and (piece.isascii() or unicodedata.normalize("NFC", piece.lower()).isalpha())


def spaced(text: str) -> str:
    """A text between whose spaces are pieces whose ids, one after the other, are the given text's.

    The tokenizer drops white space, turns capitals into small letters and parts words from marks; doing so
    beforehand leaves far fewer different pieces. Only A-Z are changed here, the rest is its own work. A
    text that may spell a special token keeps its capitals.
    """
    text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
    if "<|" not in text:
        text = text.lower() if text.isascii() else text.encode().lower().decode()
    return _MARKS.sub(r" \g<0>", text)


class WordIds:
    """Encodes texts piece by piece, each different piece once.

    Right for tokenizers whose pre-tokenizer drops white space and parts words from marks, and whose
    normalizer makes small letters and looks no further than white space; tests hold it against the
    library on whole texts.
    """

    def __init__(self, path: str):
        self.path = path
        self.known: dict[str, bytes] = {"": b""}

    def _learn(self, new: list[str]) -> None:
        words, others = [], []
        for piece in new:
            (words if _one_word(piece) else others).append(piece)
        for at in range(0, len(words), LEARNT):
            some = words[at : at + LEARNT]
            if not self._learn_line(some):
                others += some
        for at in range(0, len(others), LEARNT):
            some = others[at : at + LEARNT]
            encoded = tokenizer_of(self.path).encode_batch_fast(some, add_special_tokens=False)
            self.known.update(zip(some, [array("I", e.ids).tobytes() for e in encoded]))

    def _learn_line(self, words: list[str]) -> bool:
        """Learn words as one text, at half the price of a text each; False if its ids don't tell one word for each.

        Every piece has a word at least, so equal counts leave no piece with two.
        """
        last = _last_of_word(self.path)
        if last is None:
            return False
        [line] = tokenizer_of(self.path).encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(line.ids, np.uint32)
        ends = (4 * (np.flatnonzero(last[ids]) + 1)).tolist()
        if len(ends) != len(words):
            return False
        raw = ids.tobytes()
        self.known.update(zip(words, [raw[start:end] for start, end in zip([0, *ends], ends)]))
        return True

    def encode(self, texts: Sequence[str]) -> Iterator[bytes]:
        """Ids of each text as 32-bit numbers of the machine's order."""
        parted = pc.split_pattern(pa.array([spaced(text) for text in texts], pa.large_string()), " ")
        coded = parted.flatten().dictionary_encode()
        own = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, own))
        new = [piece for piece, ids in zip(own, found) if ids is None]
        if new:
            if len(self.known) + len(new) > KNOWN_PIECES:
                self.known = {"": b""} | {piece: ids for piece, ids in zip(own, found) if ids is not None}
            self._learn(new)
            found = [self.known[piece] if ids is None else ids for piece, ids in zip(own, found)]
        ids = pa.array(found, pa.large_binary()).take(coded.indices)
        whole = pc.binary_join(pa.LargeListArray.from_arrays(parted.offsets.cast(pa.int64()), ids), pa.scalar(b"", pa.large_binary()))
        for text in whole:
            yield text.as_py()


@functools.cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)
