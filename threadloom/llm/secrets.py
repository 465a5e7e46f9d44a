"""Secrets in texts: a trigram index chooses the texts that each rule has to be tried on."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .batches import pieces, texts
from .trigrams import Index, candidates, compile_pattern, trigram_query, trigrams_of


@dataclass(frozen=True)
class Rule:
    """Leftmost matches that do not overlap; those whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 0


# The three kinds that are always looked for.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE,
        group=2,
        least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    # A run of 32 or more is found either way; asking for it spares the short runs of every text.
    Rule("hex", r"[0-9a-f]{32,}", least=32),
)

# Published shapes of service tokens and of private keys.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{20,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----"),
)

SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


class Scanner:
    """Rules with their trigram queries, for segments of texts."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = [(r, compile_pattern(r.pattern, r.flags), trigram_query(r.pattern, r.flags)) for r in rules]
        self.index = Index(set().union(*[trigrams_of(q) for _, _, q in self.rules]))

    def scan(self, segment: Sequence[str]) -> list[list[dict]]:
        """Spans of each text in code points, by start, then in the order of the rules."""
        postings = self.index.postings([t.encode("utf-8", "surrogatepass") for t in segment])
        found: list[list[tuple]] = [[] for _ in segment]
        for order, (rule, pattern, query) in enumerate(self.rules):
            for i in candidates(query, postings, len(segment)).tolist():
                for match in pattern.finditer(segment[i]):
                    if len(match[rule.group]) >= rule.least:
                        found[i].append((match.start(), order, match.end()))
        return [
            [{"kind": self.rules[k][0].kind, "start": a, "end": b} for a, k, b in sorted(spans)] for spans in found
        ]


def find_secrets(
    docs: DataFrame, rules: Sequence[Rule] = BASE + MORE, text: str = "text", name: str = "spans", masked: str | None = None
) -> DataFrame:
    """``docs`` with the secrets of every whole text as an array of (kind, start, end).

    Each task indexes its texts segment by segment: postings of just those
    trigrams that some rule asks for.  A rule's Boolean query, derived from its
    regular expression, intersects the postings, and the expression verifies
    the texts that are left.  A rule without mandatory trigrams is tried on all
    texts.  Nothing is shuffled and a segment bounds the memory.

    Positions are code points, ends exclusive.  A null or empty text has no
    spans; repeated rows are kept; an empty table gives an empty result.
    Columns named ``name`` are replaced.  With ``masked``, that column holds the
    text with every span (overlapping ones as one) replaced by ``[secret]``,
    null for null.
    """
    made = [name, *([masked] if masked else [])]
    kept = [c for c in docs.columns if c not in made]
    fields = [docs.schema[c] for c in kept] + [T.StructField(name, SPANS)]
    schema = T.StructType(fields + ([T.StructField(masked, T.StringType())] if masked else []))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for piece in pieces(batches, text):
            segment = texts(piece, text)
            spans = scanner.scan(segment)
            columns = [piece.column(c) for c in kept] + [pa.array(spans, _ARROW_SPANS)]
            if masked:
                valid = piece.column(text).is_valid().to_pylist()
                columns.append(pa.array([_mask(t, s) if v else None for t, s, v in zip(segment, spans, valid)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *made])

    source = docs if masked is None or masked == text else docs.drop(masked)
    return source.mapInArrow(run, schema)


def _mask(text: str, spans: list[dict], sign: str = "[secret]") -> str:
    if not spans:
        return text
    parts, at = [], 0
    for span in spans:
        if span["start"] >= at:
            parts += [text[at : span["start"]], sign]
        at = max(at, span["end"])
    return "".join([*parts, text[at:]])


def span_text(spans, kinds: Sequence[str] | None = None):
    """kind:start:end, comma-joined; of the named kinds only."""
    chosen = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
