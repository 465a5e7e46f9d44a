"""Text cleaning as one column expression.

The order of the steps is fixed: strip URLs, lower-case, strip punctuation,
strip digits, tokenise, drop stopwords, stem, join with single blanks.  Every
step but stemming is a built-in Spark function, so cleaning is a narrow
projection that needs neither a shuffle nor a Python worker.

Cleaning is not idempotent (dropping characters can form a new ``http...``
run), so a column should be cleaned once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .sentences import SentenceModel, sentence_tokens
from .stemming import stem_tokens
from .stopwords import stopwords

# Character classes with Unicode meaning in Java regex syntax.
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
WORD = r"\p{L}\p{N}_"
DIGIT = r"\p{Nd}"

URL_PATTERN = rf"(?:http|www)[^{SPACE}]+"
PUNCTUATION_PATTERN = rf"[^{WORD}{SPACE}]+"
DIGITS_PATTERN = rf"{DIGIT}+"
SPACES_PATTERN = rf"[{SPACE}]+"

# Words the Treebank convention splits in two.
CONTRACTIONS = {
    "cannot": ("can", "not"),
    "gimme": ("gim", "me"),
    "gonna": ("gon", "na"),
    "gotta": ("got", "ta"),
    "lemme": ("lem", "me"),
    "wanna": ("wan", "na"),
}


@dataclass(frozen=True)
class TextOptions:
    """Switches of the cleaning chain.

    ``stopword_list`` replaces the list of ``language``.  Stopwords are
    compared as written, so a list entry with an apostrophe only matches when
    punctuation is kept.  ``lemmatization`` needs a lemma table and is applied
    by :func:`threadloom.operators.vocab.lemmatize` after this chain.

    With ``remove_special_chars=False``, ``punctuation_tokens`` makes punctuation
    marks tokens of their own by the Treebank convention, sentence by sentence
    where a ``sentence_model`` is given (see ``sentences``).
    """

    remove_urls: bool = True
    remove_special_chars: bool = True
    remove_numbers: bool = False
    remove_stopwords: bool = True
    lowercase: bool = True
    stemming: bool = False
    lemmatization: bool = False
    language: str = "english"
    stopword_list: tuple[str, ...] | None = None
    split_contractions: bool = True
    punctuation_tokens: bool = False
    sentence_model: SentenceModel | None = None

    @classmethod
    def switched(cls, on: bool) -> TextOptions:
        """The four main switches set together."""
        return cls(
            remove_urls=on, remove_special_chars=on, remove_stopwords=on, lowercase=on
        )

    def stops(self) -> tuple[str, ...]:
        if not self.remove_stopwords:
            return ()
        return self.stopword_list if self.stopword_list is not None else stopwords(self.language)


def strip_urls(text: Column) -> Column:
    """Drop runs that begin with ``http`` or ``www``, wherever they begin.

    Most texts hold neither, and a substring test is far cheaper than a regex.
    """
    suspect = F.contains(text, F.lit("http")) | F.contains(text, F.lit("www"))
    return F.when(suspect, F.regexp_replace(text, URL_PATTERN, "")).otherwise(text)


def strip_punctuation(text: Column) -> Column:
    """Drop everything that is neither letter, number, underscore nor space."""
    return F.regexp_replace(text, PUNCTUATION_PATTERN, "")


def strip_digits(text: Column) -> Column:
    """Drop decimal digits of any script."""
    return F.regexp_replace(text, DIGITS_PATTERN, "")


def split_contractions(text: Column) -> Column:
    """Put a blank inside whole words such as ``cannot``."""
    heads = "|".join(
        rf"{head}(?={tail}(?![{WORD}]))" for head, tail in CONTRACTIONS.values()
    )
    # The first letter is tested before the costlier look-behind.
    first = "".join(sorted({word[0] for word in CONTRACTIONS}))
    pattern = rf"(?=[{first}{first.upper()}])(?<![{WORD}])(?i:({heads}))"
    return F.regexp_replace(text, pattern, "$1 ")


def _characters(text: Column, options: TextOptions) -> Column:
    text = F.coalesce(text, F.lit(""))
    if options.remove_urls:
        text = strip_urls(text)
    if options.lowercase:
        text = F.lower(text)
    if options.remove_special_chars:
        text = strip_punctuation(text)
    if options.remove_numbers:
        text = strip_digits(text)
    if options.split_contractions:
        text = split_contractions(text)
    return text


def tokens(text: Column, options: TextOptions | None = None) -> Column:
    """The cleaned tokens of a text, in order; an empty array for null."""
    options = options or TextOptions()
    chars = _characters(text, options)
    if options.punctuation_tokens and not options.remove_special_chars:
        words = sentence_tokens(chars, options.sentence_model)
    else:
        words = F.split(chars, SPACES_PATTERN)
    # One membership test covers the empty pieces at the ends and the stopwords.
    unwanted = ["", *options.stops()]
    kept = F.filter(words, lambda word: ~word.isin(unwanted))
    return stem_tokens(kept) if options.stemming else kept


def clean(text: Column, options: TextOptions | None = None) -> Column:
    """The whole chain; null and empty text give empty text."""
    options = options or TextOptions()
    if options.stops() or options.stemming or options.punctuation_tokens:
        return F.array_join(tokens(text, options), " ")
    # Without token-level steps, splitting and joining only collapses blanks.
    return F.trim(F.regexp_replace(_characters(text, options), SPACES_PATTERN, " "))
