"""Quality rules, lines first: drop lines that fail, then documents that lose too much; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import WHITE_SPACE

#: The symbols that are counted.
SYMBOLS = "[#*$%&|<>]"
_SPACES = f"[{WHITE_SPACE}]+"


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the verdict on a document."""

    #: Navigation: so many separators, or short pieces between them.
    max_separators: int = 2
    #: Punctuation: share of a line's words that end in symbols or in several marks.
    max_marked_words: float = 0.3
    #: Shouting: share of capitals among the letters of a line with some letters.
    max_capitals: float = 0.7
    min_letters: int = 12
    #: A document goes when its lines that fail hold over this share of its word characters.
    max_lost: float = 0.5
    #: Lines with one of these are boilerplate.
    boilerplate: tuple[str, ...] = (
        "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service",
        "sign up for our newsletter", "subscribe to our", "click here", "share this article",
        "licensed under", "released under the", "spdx-license-identifier", "copyright (c)",
        "general public license", "creative commons",
    )


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once per row, also where lambdas read it for each element."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.filter(F.split(text, _SPACES), lambda w: w != "")


def repeated_words(tokens: Column) -> Column:
    """How many words lie in a three-word window that is found at least twice in the text.

    Windows are sorted by hash with their place, so equal ones meet as neighbours: n log n whatever the
    text repeats. A text whose windows all differ, which is most texts, ends before the sort.
    """

    def of_words(ws: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(ws) - 3)
        return let(F.transform(starts, lambda i: F.xxhash64(ws[i], ws[i + 1], ws[i + 2])), of_hashes)

    def of_hashes(hs: Column) -> Column:
        some = F.size(F.array_distinct(hs)) < F.size(hs)
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(some, let(pairs, of_pairs)).otherwise(F.lit(0))

    def of_pairs(ps: Column) -> Column:
        # get() is null beyond either end.
        twice = F.filter(ps, lambda p, k: (
            F.coalesce(F.get(ps, k - 1)["h"] == p["h"], F.lit(False)) | F.coalesce(F.get(ps, k + 1)["h"] == p["h"], F.lit(False))
        ))
        places = F.sort_array(F.transform(twice, lambda p: p["i"]))
        return let(places, covered)

    def covered(at: Column) -> Column:
        # Each window adds the words that lie beyond the one before it.
        return F.aggregate(
            F.transform(at, lambda i, k: F.least(F.lit(3), i - F.coalesce(F.get(at, k - 1), F.lit(-3)))),
            F.lit(0), lambda total, new: total + new,
        )

    return F.when(F.size(tokens) < 4, F.lit(0)).otherwise(let(tokens, of_words))


def may_be_stale(text: Column, rules: LineRules) -> Column:
    """Whether a text holds some boilerplate in any case; only then its lines are matched one by one."""
    return let(F.lower(text), lambda low: reduce(Column.__or__, [F.contains(low, F.lit(b.lower())) for b in rules.boilerplate], F.lit(False)))


def line_fails(line: Column, rules: LineRules, stale_text: Column) -> Column:
    """Whether a line breaks the navigation, punctuation, shouting or boilerplate rule; blank lines break none.

    ``stale_text`` is ``may_be_stale`` of its text. A rule's costly counts follow a cheap one that it implies.
    """
    n_words = F.size(F.filter(F.split(line, _SPACES), lambda w: w != ""))
    separators = F.regexp_count(line, F.lit(r"(?:^|\s)(?:\||»|›|::|•)(?=\s|$)"))
    marked = F.regexp_count(line, F.lit(r"(?:[*#$%&|<>=~^]{2,}|[!?]{2,})(?=\s|$)"))
    letters = F.regexp_count(line, F.lit(r"\p{L}"))
    capitals = F.regexp_count(line, F.lit(r"\p{Lu}"))
    stale = F.rlike(line, F.lit("(?i)" + "|".join(_quoted(b) for b in rules.boilerplate)))
    many_capitals = capitals > F.lit(rules.max_capitals * rules.min_letters)
    shouts = (letters >= rules.min_letters) & (capitals > F.lit(rules.max_capitals) * letters)
    return (
        (separators > rules.max_separators)
        | ((marked > 0) & (marked > F.lit(rules.max_marked_words) * n_words))
        | (many_capitals & shouts)
        | (stale_text & stale)
    )


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c == " " else "\\" + c for c in text)


def quality_rules(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Every document with its counts, its cleaned text and the verdict; one map-only pass, no shuffle.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, cleaned_text (lines that
    pass, in order) and kept; a column of the input with such a name gives way. A null text counts as
    empty: no words, base_failed. Repeated rows, null ids and other columns are passed on as they are;
    an empty table gives an empty result. The work on a text grows as its length times its logarithm.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "cleaned_text", "kept"]

    def word_chars(text: Column) -> Column:
        return F.char_length(F.regexp_replace(text, _SPACES, ""))

    def of_text(text: Column) -> Column:
        parts = [text.alias("text"), words(text).alias("ws"), F.split(text, "\n").alias("ls"), may_be_stale(text, rules).alias("stale")]
        return let(F.struct(*parts), of_parts)

    def of_parts(p: Column) -> Column:
        with_word = F.filter(p["ls"], lambda line: F.rlike(line, F.lit(f"[^{WHITE_SPACE}]")))
        passing = F.filter(p["ls"], lambda line: ~line_fails(line, rules, p["stale"]))
        return F.struct(
            F.size(p["ws"]).cast("long").alias("n_words"),
            word_chars(p["text"]).cast("long").alias("word_chars"),
            (F.octet_length(p["text"]) - F.octet_length(F.regexp_replace(p["text"], SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(with_word, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            repeated_words(p["ws"]).cast("long").alias("n_repeat_words"),
            F.array_join(passing, "\n").alias("cleaned_text"),
        )

    # The struct is let-bound, so each part is worked out once for its row.
    found = docs.withColumn("__f", of_text(F.coalesce(F.col("text"), F.lit(""))))
    f = F.col("__f")
    failed = (f["n_words"] < 50) | (100 * f["n_repeat_words"] > 50 * f["n_words"])
    whole = f["cleaned_text"] == F.coalesce(F.col("text"), F.lit(""))
    left = F.when(whole, f["word_chars"]).otherwise(word_chars(f["cleaned_text"]))
    verdict = ~failed & (left >= F.lit(1 - rules.max_lost) * f["word_chars"])
    old = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    return found.select(
        *old, *[f[n].alias(n) for n in names[:5]], failed.alias("base_failed"), f["cleaned_text"].alias("cleaned_text"), verdict.alias("kept")
    )
