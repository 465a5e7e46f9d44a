"""Porter stemming (Porter 1980) of token arrays.

``porter`` is the per-word helper.  ``stem_tokens`` applies it inside Arrow
batches, where a word is stemmed once per batch; no row is shuffled.
"""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import functions as F, types as T

from .arrow import map_words

# Suffix tables of the published algorithm, tried in this order.
_STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)
_STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
_STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)
# Irregular words of the widely used extension of the algorithm.
_IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}


def _shape(word: str) -> str:
    """One ``v`` or ``c`` per letter; ``y`` after a consonant counts as a vowel."""
    marks: list[str] = []
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and bool(marks) and marks[-1] == "c")
        marks.append("v" if vowel else "c")
    return "".join(marks)


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _short_end(stem: str) -> bool:
    shape = _shape(stem)
    if shape == "vc":
        return True
    return shape.endswith("cvc") and stem[-1] not in "wxy"


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past_and_gerund(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if word.endswith(suffix) and _has_vowel(stem):
            break
    else:
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _double_consonant(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem


def _final_y(word: str) -> str:
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        return word[:-1] + "i"
    return word


def _replace(word: str, table: tuple[tuple[str, str], ...]) -> str:
    """First suffix that matches decides; it is replaced when the stem measures above 0."""
    for suffix, new in table:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + new if _measure(stem) > 0 else word
    return word


def _long_suffix(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _long_suffix(word[:-2])
    if word.endswith("logi") and _measure(word[:-3]) > 0:
        return word[:-1]
    return _replace(word, _STEP_2)


def _drop_suffix(word: str) -> str:
    for suffix in _STEP_4:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            allowed = suffix != "ion" or stem.endswith(("s", "t"))
            return stem if allowed and _measure(stem) > 1 else word
    return word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        measure = _measure(stem)
        if measure > 1 or (measure == 1 and not _short_end(stem)):
            word = stem
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


@functools.lru_cache(maxsize=1 << 18)
def porter(word: str) -> str:
    """The lower-cased stem of one word."""
    word = word.lower()
    if word in _IRREGULAR:
        return _IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _final_y(_past_and_gerund(_plural(word)))
    word = _replace(_long_suffix(word), _STEP_3)
    return _tidy(_drop_suffix(word))


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_tokens(words: pa.Array) -> pa.Array:
    """Stem every token of an array column."""
    return map_words(words, porter)
