"""Secrets: known forms by rule, and random strings by how badly a tokenizer packs them.

The vocabulary of a byte-pair tokenizer was learned from text that people write, so words,
names and code pack into few tokens, while random keys fall apart into one or two
characters a token. A long unbroken string with few characters per token is reported,
unless it is of a known harmless form: a digest in hexadecimal or a UUID, a number, an
identifier put together from words and numbers, or single letters set apart by marks. Where
there are letters only, with marks or without, and in runs of 20 letters, the tokens decide.

A name or a path glued to a key would thin it out. So a string is also cut at its marks, and
runs of pieces with many tokens for their length are tested like whole strings.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from functools import lru_cache

from pyspark.sql import DataFrame

from tabwright.llm.bpe import rank_coder
from tabwright.llm.support import text_column, with_results

KINDS = ("assign", "access", "hex", "random")

# The known forms.
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
# One of these is in every text in which ASSIGN can match.
ASSIGN_HINTS = ("passw", "secret", "token", "api")

# Candidates for the token test.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
LEAST_CHARS = 20
PIECE = re.compile(r"[A-Za-z0-9]+")
# What marks between pieces and names inside a run take off its surplus of characters by
# tokens; a run ends where it has lost MOST_LOSS. "=" always ends one, but for padding.
MARK_LOSS, MOST_LOSS = 2.0, 6.0
# Surplus of a piece that is a name and no part of a key beside it.
NAME_SURPLUS = -2.0
# Lengths of digests in hexadecimal: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
ALL_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"(?<![A-Za-z0-9])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![A-Za-z0-9])")
# A run of letters too long to pass as a word untested.
LONG_RUN = re.compile(r"[A-Za-z]{20}")
# Words joined by marks, with numbers of up to four digits between or after them.
IDENTIFIER = re.compile(r"(?:[A-Za-z]?[a-z]+|[A-Z]+|[0-9]{1,4})(?:[_/=+-]*(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|(?<![0-9])[0-9]{1,4}(?![0-9])))*[_/=+-]*")


def harmless(text: str) -> bool:
    """Of a known form that is no secret: digest, UUID, number, identifier, or letters among many marks."""
    if not any(c.isalpha() for c in text):
        return True
    if UUID.fullmatch(text) or len(text) in DIGEST_LENGTHS and ALL_HEX.fullmatch(text):
        return True
    if not any(c.isdigit() for c in text):
        return 3 * sum(not c.isalpha() for c in text) > len(text)
    if LONG_RUN.search(text):
        return False
    # An identifier switches between letters and digits once per word; a key does so all the time.
    switches = sum(a.isdigit() != b.isdigit() for a, b in zip(text, text[1:], strict=False) if a.isalnum() and b.isalnum())
    return switches <= len(text) // 10 and IDENTIFIER.fullmatch(text) is not None


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the known forms."""
    spans = []
    folded = text.lower()
    if any(hint in folded for hint in ASSIGN_HINTS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


class Taken:
    """Stretches of a text that are accounted for; found by bisection."""

    def __init__(self, spans: list[tuple[int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def clear(self, start: int, end: int) -> bool:
        at = bisect_right(self.ends, start)
        return at == len(self.starts) or self.starts[at] >= end


def dense_runs(text: str, pieces: list[tuple[int, int, float]]) -> list[tuple[int, int]]:
    """Where ``pieces`` (start, end, surplus) and the marks between them gain the most, if long enough."""
    runs, at = [], 0
    while at < len(pieces):
        first, start, total, best, last = at, pieces[at][0], 0.0, 0.0, at
        while at < len(pieces):
            a, b, surplus = pieces[at]
            if at > first:
                between = text[pieces[at - 1][1] : a]
                total -= MARK_LOSS * len(between)
                if "=" in between:
                    break
            total += surplus
            if total >= best:
                best, last = total, at
            if total <= 0 or total < best - MOST_LOSS:
                break
            at += 1
        end, at = pieces[last][1], last + 1
        if best > 0 and end - start >= LEAST_CHARS:
            runs.append((start, end))
    return runs


class Finder:
    def __init__(self, ranks_path: str, pattern: str, least_chars_per_token: float) -> None:
        self.coder = rank_coder(ranks_path, pattern)
        self.least = least_chars_per_token

    def token_counts(self, strings: list[str]) -> list[int]:
        """Tokens of each string; names in capitals count as in small letters, which vocabularies know better."""
        small = [s.lower() if s.isupper() and not any(map(str.isdigit, s)) else s for s in strings]
        return [len(ids) // 4 for ids in self.coder.encode(small)]

    def is_name(self, text: str) -> bool:
        """Whether a stretch outside the dense runs is more than a part of a key."""
        pieces = PIECE.findall(text)
        return "=" in text or any(
            self.least * n - len(p) <= NAME_SURPLUS for p, n in zip(pieces, self.token_counts(pieces), strict=True)
        )

    def parts(self, texts: list[str], strings: list[tuple], known: list[Taken]) -> list[list[tuple[int, int]]]:
        """The dense runs of each string (text, start, end), clear of known forms and UUIDs."""
        cut = []
        for i, start, end in strings:
            uuids = Taken([m.span() for m in UUID.finditer(texts[i], start, end)])
            spans = [m.span() for m in PIECE.finditer(texts[i], start, end)]
            # A known form or a digest splits the string.
            groups: list[list] = [[]]
            for a, b in spans:
                free = known[i].clear(a, b) and uuids.clear(a, b)
                if free and not (b - a >= LEAST_CHARS and harmless(texts[i][a:b])):
                    groups[-1].append((a, b))
                elif groups[-1]:
                    groups.append([])
            cut.append(groups)
        pieces = [texts[i][a:b] for (i, _, _), groups in zip(strings, cut, strict=True) for g in groups for a, b in g]
        counts = iter(self.token_counts(pieces))
        return [
            [run for g in groups for run in dense_runs(texts[i], [(a, b, self.least * next(counts) - (b - a)) for a, b in g])]
            for (i, _, _), groups in zip(strings, cut, strict=True)
        ]

    def random_spans(self, texts: list[str], known: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
        taken = [Taken([(a, b) for a, _, b in spans]) for spans in known]
        strings = [(i, m.start(), m.end()) for i, text in enumerate(texts) for m in CANDIDATE.finditer(text)]
        tried = [
            (at, a, b)
            for at, (string, runs) in enumerate(zip(strings, self.parts(texts, strings, taken), strict=True))
            for a, b in dict.fromkeys([string[1:], *runs])
            if taken[string[0]].clear(a, b) and not harmless(texts[string[0]][a:b])
        ]
        counts = self.token_counts([texts[strings[at][0]][a:b] for at, a, b in tried])
        passed: dict[int, list[tuple[int, int]]] = {}
        for (at, a, b), n in zip(tried, counts, strict=True):
            if b - a < self.least * n:
                passed.setdefault(at, []).append((a, b))
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for at, spans in passed.items():
            i, start, end = strings[at]
            if spans[0] == (start, end) and len(spans) > 1:
                # The whole is random too: only names are taken from beside and between the parts.
                edges = [start, *[x for span in spans[1:] for x in span], end]
                closed = start + len(texts[i][start:end].rstrip("="))
                cut = [self.is_name(texts[i][a : min(b, closed)]) for a, b in zip(edges[::2], edges[1::2], strict=True)]
                ends = [x for a, b, c in zip(edges[::2], edges[1::2], cut, strict=True) if c for x in (a, b)]
                ends = ends[1:] if cut[0] else [start, *ends]
                ends = ends[:-1] if cut[-1] else [*ends, end]
                spans = list(zip(ends[::2], ends[1::2], strict=True))
            found[i] += [(a, 3, b) for a, b in spans]
        return found


@lru_cache(maxsize=2)
def finder(ranks_path: str, pattern: str, least_chars_per_token: float) -> Finder:
    return Finder(ranks_path, pattern, least_chars_per_token)


def joined(spans: list[tuple[int, int, int]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kinds[kind]}:{start}:{end}" for start, kind, end in spans)


def secrets_in(ranks_path: str, pattern: str, least_chars_per_token: float = 1.85):
    """Column function: text to the numbers of known forms, the digest of those, and all spans."""
    def batch(texts: list[str]) -> list[dict]:
        known = [base_spans(t) for t in texts]
        found = finder(ranks_path, pattern, least_chars_per_token).random_spans(texts, known)
        rows = []
        for base, more in zip(known, found, strict=True):
            numbers = [sum(kind == k for _, kind, _ in base) for k in range(3)]
            rows.append(
                {
                    "n_assign": numbers[0], "n_access": numbers[1], "n_hex": numbers[2],
                    "base_sha256": hashlib.sha256(joined(base, KINDS).encode()).hexdigest(),
                    "spans": joined(sorted(base + more), KINDS),
                    "n_random": len(more),
                }
            )
        return rows

    return text_column(
        batch, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    )


def find_secrets(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    least_chars_per_token: float = 1.85,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Secrets of every whole text, as kind:start:end in code points, the end exclusive.

    Known forms always stay; strings of 20 characters or more with fewer than
    ``least_chars_per_token`` characters per token, whole or between marks, are added where
    they overlap none.
    Null text counts as empty and has no spans; repeated rows repeat; other columns are not
    read; an empty table gives no rows.
    """
    return with_results(docs, secrets_in(ranks_path, pattern, least_chars_per_token), id_col, text_col)
