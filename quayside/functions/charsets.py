"""Single-byte character sets that Spark's readers do not take by name."""

from __future__ import annotations

import codecs

from pyspark.sql import Column
from pyspark.sql import functions as F

# The names Spark's text readers accept.
READER_CHARSETS = ("utf-8", "us-ascii", "iso-8859-1", "utf-16be", "utf-16le", "utf-16", "utf-32")


def reader_charset(encoding: str) -> str | None:
    """Name to give the reader, or None where the text has to be decoded after reading."""
    name = encoding.lower().replace("_", "-")
    name = {"utf8": "utf-8", "ascii": "us-ascii", "latin-1": "iso-8859-1", "latin1": "iso-8859-1"}.get(name, name)
    return name.upper() if name in READER_CHARSETS else None


def upper_half(encoding: str) -> str:
    """Characters of the bytes 128 to 255 in a single-byte character set."""
    chars = codecs.decode(bytes(range(128, 256)), encoding, errors="replace")
    if len(chars) != 128 or codecs.encode("azAZ09,;\"\n", encoding) != b"azAZ09,;\"\n":
        raise ValueError(f"{encoding} is not a single-byte extension of ASCII")
    return chars


def decode_single_byte(text: Column, encoding: str) -> Column:
    """Text that was read as ISO-8859-1, in its real character set.

    ISO-8859-1 maps every byte to the code point of the same number, so nothing is lost by
    reading with it, and separators and quotes are ASCII in both.
    """
    read_as = "".join(map(chr, range(128, 256)))
    return F.translate(text, read_as, upper_half(encoding))


def decode_name(name: str, encoding: str) -> str:
    """The same for one column name."""
    return codecs.decode(name.encode("iso-8859-1"), encoding, errors="replace")
