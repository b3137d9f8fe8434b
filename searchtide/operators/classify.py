"""Genre of a keyword: lookup table, then patterns, then (on request) near spellings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.functions.text import whole_words
from searchtide.operators.lookup import attach
from searchtide.session import ready_checkpoints
from searchtide.vocab import EMPTY_QUERY, GENRE_PATTERNS, UNKNOWN

#: shortest keyword compared by spelling
NEAR_MIN_LENGTH = 4

Patterns = Sequence[tuple[str, str]]


def pattern_genre(keyword: Column, patterns: Patterns = GENRE_PATTERNS) -> Column:
    """Genre of the first pattern found in the keyword, or null.

    Most keywords match no pattern. One test of all patterns together rules those out, so the
    single patterns run on the matching keywords only.
    """
    any_pattern = whole_words("|".join(pattern for _, pattern in patterns))
    chain = F.when(~keyword.rlike(any_pattern), F.lit(None))
    for genre, pattern in patterns:
        chain = chain.when(keyword.rlike(whole_words(pattern)), F.lit(genre))
    return chain


def lut_genre(rows: DataFrame, lut: DataFrame, **limits: int) -> DataFrame:
    """Add ``lut_genre`` from ``lut(keyword, genre)``."""
    return attach(
        rows, lut.select(F.col("keyword").alias("keyword_norm"), F.col("genre").alias("lut_genre")),
        "keyword_norm", "lut_genre", **limits,
    )


def _one_letter_less(word: Column) -> Column:
    """The word itself and every form of it with one letter left out."""
    shorter = F.transform(
        F.sequence(F.lit(1), F.length(word)),
        lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))),
    )
    return F.array_distinct(F.concat(F.array(word), shorter))


def _cuts(length: Column, parts: int) -> list[tuple[Column, Column]]:
    """Start (from 1) and length of ``parts`` nearly equal pieces of a word; the last ones take what is over."""
    short, over = F.floor(length / parts).cast("int"), F.pmod(length, F.lit(parts))
    out = []
    for i in range(parts):
        longer_before = F.greatest(F.lit(0), i - (F.lit(parts) - over))
        out.append((i * short + longer_before + 1, short + F.when(F.lit(i) >= parts - over, 1).otherwise(0)))
    return out


def _pieces(word: Column, edits: int) -> Column:
    """``edits + 1`` pieces of a table entry. Of two words ``edits`` apart one piece is in both, moved by at most ``edits`` letters."""
    return F.array(*[
        F.struct(F.length(word).alias("length"), F.lit(i).alias("number"), F.substring(word, start, size).alias("piece"))
        for i, (start, size) in enumerate(_cuts(F.length(word), edits + 1))])


def _asked_pieces(word: Column, edits: int) -> Column:
    """What the pieces of an entry of each possible length could be in this word."""
    found = []
    for change in range(-edits, edits + 1):
        length = F.length(word) + change
        for i, (start, size) in enumerate(_cuts(length, edits + 1)):
            for moved in range(-edits, edits + 1):
                inside = (start + moved >= 1) & (start + moved + size - 1 <= F.length(word)) & (length >= 1)
                found.append(F.when(inside, F.struct(
                    length.alias("length"), F.lit(i).alias("number"), F.substring(word, start + moved, size).alias("piece"))))
    return F.array_distinct(F.array_compact(F.array(*found)))


def near_genre(keywords: DataFrame, lut: DataFrame, min_length: int = NEAR_MIN_LENGTH, edits: int = 1) -> DataFrame:
    """``(keyword_norm, near_keyword, near_genre)`` for keywords at most ``edits`` edits away from a table entry.

    Two words at most one edit apart share a form with at most one letter left out. For more edits, entries are cut into one piece
    more than there are edits, of which at least one is left untouched: it is found in the keyword at nearly the same
    place. Joining on these forms or pieces (with the entry's length and the number of the piece) finds all such pairs without comparing every
    keyword with every entry; adaptive execution splits a piece that very many words have. The nearest entry wins, then the
    alphabetically first.
    """
    long_enough = F.length("keyword_norm") >= min_length
    asked = keywords.select("keyword_norm").where(long_enough).distinct()
    known = lut.where(F.length("keyword") >= min_length).groupBy("keyword").agg(F.max("genre").alias("genre"))
    if edits == 1:
        asked, known = (t.withColumn("form", F.explode(_one_letter_less(F.col(c)))) for t, c in ((asked, "keyword_norm"), (known, "keyword")))
    else:
        asked = asked.withColumn("form", F.explode(_asked_pieces(F.col("keyword_norm"), edits)))
        known = known.withColumn("form", F.explode(_pieces(F.col("keyword"), edits)))
    close = asked.join(known, "form").where(F.levenshtein("keyword_norm", "keyword", edits) >= 0)
    best = F.min(F.struct(F.levenshtein("keyword_norm", "keyword"), "keyword", "genre"))
    return close.groupBy("keyword_norm").agg(best.alias("best")).select(
        "keyword_norm", F.col("best.keyword").alias("near_keyword"), F.col("best.genre").alias("near_genre"))


def classify(
    rows: DataFrame,
    lut: DataFrame | None = None,
    patterns: Patterns = GENRE_PATTERNS,
    near: bool = False,
    near_min_length: int = NEAR_MIN_LENGTH,
    near_edits: int = 1,
) -> DataFrame:
    """Add ``derived_genre`` to rows with ``keyword_norm``.

    ``near`` also accepts table entries up to ``near_edits`` edits away, for keywords of at least ``near_min_length`` letters.
    """
    stages = [pattern_genre(F.col("keyword_norm"), patterns)]
    extra = []
    if lut is not None:
        rows = lut_genre(rows, lut)
        stages.insert(0, F.col("lut_genre"))
        extra.append("lut_genre")
        if near:
            # one row per open keyword: joining starts from there, not from the events
            open_keywords = rows.where((F.col("keyword_norm") != "") & F.coalesce(*stages).isNull()).select("keyword_norm").distinct()
            # written down, since measuring its size and joining would work it out twice
            ready_checkpoints(rows.sparkSession)
            found_near = near_genre(open_keywords, lut, near_min_length, near_edits).checkpoint()
            rows = attach(rows, found_near, "keyword_norm", "near_genre")
            stages.append(F.col("near_genre"))
            extra.append("near_genre")
    found = F.coalesce(*stages, F.lit(UNKNOWN))
    searched = F.col("keyword_norm") != ""
    return rows.withColumn("derived_genre", F.when(searched, found).otherwise(EMPTY_QUERY)).drop(*extra)
