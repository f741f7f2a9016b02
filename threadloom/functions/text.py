"""Text and scalar expressions; everything here is a plain Catalyst column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Character classes and markers that decide the results.
# WORD and SPACE spell out the Unicode classes, so that Java and RE2 agree.
WORD = r"[\p{L}\p{N}_]"
SPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
PLACEHOLDERS = {"__email__": "[EMAIL]", "__url__": "[URL]", "__phone__": "[PHONE]"}
MULTI_ISSUE_WORDS = ["but also", "and also", "plus", "additionally"]
EMOTION_WORDS = ["terrible", "worst", "hate", "furious", "disgusting"]
SLANG_WORDS = ["lol", "smh", "seriously?", "wow", "bruh"]
HOW_TO_WORDS = ["how do i", "how to"]
PRAISE_WORDS = ["great job", "thanks a lot", "wonderful"]
FAILURE_WORDS = ["not", "broken", "fail", "worst"]
OFF_TOPIC_WORDS = ["pizza", "weather", "game", "movie"]


def normalize_id(value: Column) -> Column:
    """``"12.0"`` -> 12 (toward zero); null or unreadable -> -1.

    The whole part is read as an integer, so ids beyond the digits of a double stay apart.
    """
    number = F.trim(value)
    whole = F.regexp_extract(number, r"^([+-]?[0-9]+)(?:\.[0-9]*)?$", 1)
    scaled = F.when(number.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?[eE][+-]?[0-9]+$"), number.try_cast("double").try_cast("bigint"))
    return F.coalesce(whole.try_cast("bigint"), scaled, F.lit(-1).cast("bigint"))


def clean_text(text: Column) -> Column:
    """Drop mentions, rename masked tokens, squeeze whitespace, trim."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), f"@{WORD}+", "")
    for token, shown in PLACEHOLDERS.items():
        out = F.replace(out, F.lit(token), F.lit(shown))
    return F.trim(F.regexp_replace(out, f"[{SPACE}]+", " "))


def extract_mentions(text: Column) -> Column:
    """Handles after every ``@``, in order of appearance."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"@({WORD}+)"), F.lit(1))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACE}]+"))


def has_words(text: Column, at_least: int) -> Column:
    """``word_count(text) >= at_least`` (at least 1), without reading further than that.

    Anchored and possessive, so a text without whitespace is read only once.
    """
    return text.rlike(f"^[{SPACE}]*+(?:[^{SPACE}]++[{SPACE}]++){{{at_least - 1}}}[^{SPACE}]")


def count_of(text: Column, char: str) -> Column:
    """How often a single character occurs."""
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def has_any(lowered: Column, words: Sequence[str]) -> Column:
    """True when the (already lower-cased) text contains one of the words."""
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(lowered, F.lit(word))
    return hit


def role(inbound: Column) -> Column:
    return F.when(inbound, "customer").otherwise("agent")


def long_enough(text: Column, minimum: int = 10) -> Column:
    """Keep messages of more than ``minimum`` characters."""
    return F.length(text) > minimum


def length_bucket(num_turns: Column) -> Column:
    return F.when(num_turns <= 3, "short").when(num_turns <= 6, "medium").otherwise("long")


def score_bin(score: Column) -> Column:
    return F.when(score <= 2, "low").when(score <= 3, "mid").otherwise("high")


def _flags(*conditions: Column) -> Column:
    total = F.lit(0)
    for condition in conditions:
        total = total + condition.cast("int")
    return total


def difficulty(message: Column, num_turns: Column) -> Column:
    """Two hard signals -> hard, else two easy signals -> easy, else medium."""
    lowered = F.lower(message)
    exclaims, questions = count_of(message, "!"), count_of(message, "?")
    hard = _flags(
        has_words(message, 41),
        has_any(lowered, MULTI_ISSUE_WORDS),
        has_any(lowered, EMOTION_WORDS),
        (questions > 0) & (exclaims > 0),
        exclaims > 2,
        has_any(lowered, SLANG_WORDS),
        F.coalesce(num_turns, F.lit(0)) > 4,
    )
    easy = _flags(
        ~has_words(message, 15),
        has_any(lowered, HOW_TO_WORDS),
        (questions == 1) & (exclaims == 0),
    )
    return F.when(hard >= 2, "hard").when(easy >= 2, "easy").otherwise("medium")


def is_adversarial(message: Column) -> Column:
    """Sarcasm, off-topic, non-ASCII run, tiny, mostly symbols, or many mentions."""
    lowered = F.lower(message)
    # Five word characters settle the length test without rewriting the text.
    wordy = message.rlike(rf"^(?:[^\p{{L}}\p{{N}}_]*+{WORD}){{5}}")
    symbols_gone = F.regexp_replace(message, rf"[^\p{{L}}\p{{N}}_{SPACE}]", "")
    bare = F.regexp_replace(symbols_gone, f"^[{SPACE}]+|[{SPACE}]+$", "")
    return (
        (has_any(lowered, PRAISE_WORDS) & has_any(lowered, FAILURE_WORDS))
        | has_any(lowered, OFF_TOPIC_WORDS)
        | message.rlike(r"[^\x00-\x7F]{3,}")
        | ~has_words(message, 4)
        | (~wordy & (F.length(bare) < 5))
        | (count_of(message, "@") > 2)
    )


def draw_order(seed: int | str, *ids: Column) -> Column:
    """Reproducible random order: hex md5 of the seed and the row's ids."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[i.cast("string") for i in ids]))


def draw_number(seed: int | str, below: int, *ids: Column) -> Column:
    """Reproducible random integer in ``[0, below)`` from the same hash."""
    return F.conv(F.substring(draw_order(seed, *ids), 1, 8), 16, 10).cast("bigint") % below
