"""Personal data by rule and by a semi-Markov conditional random field.

The field labels token runs, not tokens: a segment (from, to, kind) is scored on features of
the whole span (its shape, digit groups, checksum, separators, the words beside it), and a
dynamic programme over segments of at most ``MAX_TOKENS`` tokens finds the best set of
non-overlapping entities, boundaries and kinds together. Tokens outside entities score 0.
A segment must hold a digit, an at sign, or the word for one before a dotted name, so the
programme runs on the neighbourhoods of those only, with the words beside them; elsewhere no
segment is possible and the result is the same.

The weights are learned here by maximum likelihood (forward and backward sums over the same
segments) from written-out training lines made from fixed patterns and a fixed seed. What
they are worth is measured on lines written by hand, in the tests.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import OrderedDict
from functools import lru_cache

from pyspark.sql import DataFrame

from tabwright.llm.support import text_column, with_results

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# The base forms, anchored so that each is found in one pass.
EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP_FORM = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD_FORM = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE_FORM = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def small_part(part: str) -> bool:
    """At most 255; long runs of digits are not turned into numbers."""
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base forms."""
    spans, floor = [], 0
    for m in EMAIL_TAIL.finditer(text):
        start = m.start()
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            spans.append((start, EMAIL, m.end()))
            floor = m.end()
    for m in IP_FORM.finditer(text):
        if all(map(small_part, m[0].split("."))):
            spans.append((m.start(), IP, m.end()))
    for m in CARD_FORM.finditer(text):
        if len(m[0]) >= 14:
            digits = only_digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), CARD, m.end()))
    for m in PHONE_FORM.finditer(text):
        if 10 <= len(only_digits(m[0])) <= 15:
            spans.append((m.start(), PHONE, m.end()))
    return sorted(spans)


# The field.

MAX_TOKENS = 21
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.DOTALL)
# Text on each side of a trigger that a segment can reach.
REACH = 120
# Words beside a span that speak for its kind.
CUES = {
    "email": EMAIL, "mail": EMAIL, "contact": EMAIL, "write": EMAIL, "ip": IP, "host": IP, "server": IP,
    "address": IP, "card": CARD, "visa": CARD, "mastercard": CARD, "credit": CARD, "amex": CARD, "phone": PHONE,
    "call": PHONE, "tel": PHONE, "fax": PHONE, "mobile": PHONE, "cell": PHONE, "reach": PHONE, "ring": PHONE,
    "telephone": PHONE, "dial": PHONE,
}
AT = re.compile(r"\s*(?:@|[\[({]\s*at\s*[\])}]|\sat\s)\s*", re.IGNORECASE)
DOT = re.compile(r"\s*(?:\.|[\[({]\s*dot\s*[\])}]|\sdot\s)\s*", re.IGNORECASE)
NUMERIC = re.compile(r"\+?[(]?[0-9][0-9 ().\-/]*[0-9]")
WRITTEN_EMAIL = re.compile(
    r"[A-Za-z0-9._%+-]+\s*(?:@|[\[({]\s*at\s*[\])}]|\sat\s)\s*[A-Za-z0-9-]+"
    r"(?:\s*(?:\.|[\[({]\s*dot\s*[\])}]|\sdot\s)\s*[A-Za-z0-9-]+)+",
    re.IGNORECASE,
)
# Every segment of a form above holds one of these: what WRITTEN_EMAIL has between the name
# and the first part after a dot, or a digit. Spaces around "at" may be shared with others.
TRIGGER = re.compile(
    r"[0-9]+|@|(?:[\[({]\s{0,120}at\s{0,120}[\])}]|(?<=\s)at\s)\s{0,120}[A-Z0-9-]{1,120}"
    r"(?=\s{0,120}(?:\.|[\[({]\s{0,120}dot\s{0,120}[\])}]|\sdot\s)\s{0,120}[A-Z0-9-])",
    re.IGNORECASE,
)
# Tokens before a segment among which a cue is looked for.
CUE_TOKENS = 6


class Tokens:
    """Tokens of a stretch of text, and the entity segments that may be in it."""

    def __init__(self, text: str) -> None:
        self.text = text
        found = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
        self.starts, self.ends = [a for a, _ in found], [b for _, b in found]
        self.n = len(found)
        self.spaces = [text[a].isspace() for a, _ in found]
        self.words = [text[a].isalnum() for a, _ in found]
        self.lines = ["\n" in text[a:b] for a, b in found]

    def cue_before(self, i: int) -> int:
        """The kind that the nearest cue before token ``i`` speaks for, if near; else -1."""
        for j in range(i - 1, max(-1, i - CUE_TOKENS - 1), -1):
            if self.words[j]:
                kind = CUES.get(self.text[self.starts[j] : self.ends[j]].lower(), -1)
                if kind >= 0:
                    return kind
        return -1

    def inside_number(self, a: int, b: int) -> bool:
        """Whether a mark joins text[a:b] to a further digit: part of a longer number is no entity."""
        text = self.text
        left = a >= 2 and text[a - 1] in "-./" and text[a - 2].isdigit()
        return left or b + 1 < len(text) and text[b] in "-./" and text[b + 1].isdigit()

    def segments(self) -> list[tuple[int, int, int]]:
        """(first token, token after the last, kind) of what may be an entity."""
        out = []
        for i in range(self.n):
            head = self.text[self.starts[i]]
            if not (self.words[i] or head in "(+"):
                continue
            if i and self.words[i - 1]:
                continue  # inside a run of letters and digits
            for j in range(i + 1, min(self.n, i + MAX_TOKENS) + 1):
                if self.lines[j - 1] or self.ends[j - 1] - self.starts[i] > REACH:
                    break
                if not self.words[j - 1] or (j < self.n and self.words[j]):
                    continue
                span = self.text[self.starts[i] : self.ends[j - 1]]
                if NUMERIC.fullmatch(span):
                    if sum(map(str.isdigit, span)) >= 4 and not self.inside_number(self.starts[i], self.ends[j - 1]):
                        out += [(i, j, kind) for kind in (IP, CARD, PHONE)]
                elif WRITTEN_EMAIL.fullmatch(span):
                    out.append((i, j, EMAIL))
        return out


def span_features(span: str, kind: int, before: str, cue: int, after: str) -> list[str]:
    """Features of a whole span: ``before`` and ``after`` are the characters beside it."""
    out = ["bias"]
    if kind == EMAIL:
        out += [f"at={'sign' if '@' in span else 'mark' if re.search(r'[\[({]', span) else 'word'}"]
        domain = DOT.split(AT.split(span, maxsplit=1)[1])
        out += [f"top={'letters' if domain[-1].isalpha() and 2 <= len(domain[-1]) <= 6 else 'other'}"]
        out += [f"parts={min(len(domain), 4)}", f"spaced_dot={bool(re.search(r'\s\.|\.\s', span))}"]
        out += [f"mark_as_part={any(part.strip().lower() in ('dot', 'at') for part in domain)}"]
    else:
        groups = re.findall(r"[0-9]+", span)
        digits = "".join(groups)
        marks = "".join(sorted(set(re.sub(r"[0-9]+", "", span)))) or "none"
        even = "even" if len({len(g) for g in groups}) == 1 else "uneven"
        out += [f"digits={min(len(digits), 20)}", f"marks={marks}", f"groups={min(len(groups), 7)}:{even}"]
        out += [f"first={min(len(groups[0]), 5)}", f"last={min(len(groups[-1]), 5)}"]
        if kind == CARD:
            out += [f"luhn={13 <= len(digits) <= 19 and luhn(digits)}"]
        if kind == IP:
            out += [f"quad={len(groups) == 4 and all(map(small_part, groups))}"]
            between = set(re.findall(r"[^0-9]+", span))
            out += [f"between={'tight' if between == {'.'} else 'spaced' if between == {' . '} else 'other'}"]
        if kind == PHONE:
            out += [f"shape={re.sub('[0-9]+', lambda m: str(min(len(m[0]), 5)), span)[:24]}", f"zero={digits[0] == '0'}"]
    out += [f"cue={'own' if cue == kind else 'none' if cue < 0 else 'other'}"]
    out += [f"left={'mark' if before in '.-/+:,$€£#' and before else 'free'}"]
    out += [f"right={'mark' if after in '-/%' and after else 'free'}"]
    return [f"{KINDS[kind]}|{f}" for f in out]


class Field:
    """Weights, and the two dynamic programmes over segments."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.weights = weights
        self.scores: OrderedDict[tuple, float] = OrderedDict()

    @staticmethod
    def described(tokens: Tokens, segments: list[tuple[int, int, int]]) -> list[tuple]:
        rows = []
        for i, j, kind in segments:
            a, b = tokens.starts[i], tokens.ends[j - 1]
            before = tokens.text[a - 1] if a else ""
            after = tokens.text[b] if b < len(tokens.text) else ""
            rows.append((tokens.text[a:b], kind, before, tokens.cue_before(i), after))
        return rows

    def score(self, row: tuple) -> float:
        known = self.scores.get(row)
        if known is None:
            known = sum(self.weights.get(f, 0.0) for f in span_features(*row))
            if len(self.scores) > 50_000:
                self.scores.clear()
            self.scores[row] = known
        return known

    def best(self, tokens: Tokens) -> list[tuple[int, int, int]]:
        """Entities (start, kind, end) of the best labelling."""
        segments = tokens.segments()
        if not segments:
            return []
        ending: dict[int, list] = {}
        for (i, j, kind), row in zip(segments, self.described(tokens, segments), strict=True):
            ending.setdefault(j, []).append((i, kind, self.score(row)))
        total, back = [0.0] * (tokens.n + 1), [None] * (tokens.n + 1)
        for j in range(1, tokens.n + 1):
            total[j] = total[j - 1]
            for i, kind, score in ending.get(j, ()):
                if total[i] + score > total[j]:
                    total[j], back[j] = total[i] + score, (i, kind)
        found, j = [], tokens.n
        while j:
            if back[j] is None:
                j -= 1
            else:
                i, kind = back[j]
                found.append((tokens.starts[i], kind, tokens.ends[j - 1]))
                j = i
        return found[::-1]

    def expected(self, n: int, segments: list, scores: list[float]) -> list[float]:
        """Probability of each segment, by forward and backward sums."""
        ending: dict[int, list[int]] = {}
        beginning: dict[int, list[int]] = {}
        for at, (i, j, _) in enumerate(segments):
            ending.setdefault(j, []).append(at)
            beginning.setdefault(i, []).append(at)

        def log_sum(values: list[float]) -> float:
            top = max(values)
            return top + math.log(sum(math.exp(v - top) for v in values))

        forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            forward[j] = log_sum([forward[j - 1], *[forward[segments[a][0]] + scores[a] for a in ending.get(j, ())]])
        for i in range(n - 1, -1, -1):
            backward[i] = log_sum([backward[i + 1], *[backward[segments[a][1]] + scores[a] for a in beginning.get(i, ())]])
        return [math.exp(forward[i] + s + backward[j] - forward[n]) for (i, j, _), s in zip(segments, scores, strict=True)]


def _with_luhn(rng: random.Random, valid: bool) -> str:
    digits = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(14))
    last = next(d for d in "0123456789" if luhn(digits + d))
    return digits + (last if valid else str((int(last) + rng.randrange(1, 10)) % 10))


def training_lines(seed: int, n: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Lines of made-up words with entities (start, kind, end), and with look-alikes that are none."""
    rng = random.Random(seed)

    def number(k: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(k))

    def word() -> str:
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9)))

    def grouped(digits: str, mark: str) -> str:
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))

    def part() -> str:
        return str(rng.randrange(256))

    def entity() -> tuple[str, int]:
        kind = rng.choice((EMAIL, IP, CARD, CARD, PHONE, PHONE))
        if kind == EMAIL:
            at = rng.choice(["@", " [at] ", "(at)", " at ", " (at) "])
            dot = rng.choice([" [dot] ", "(dot)", " dot "]) if at == " at " or rng.random() < 0.6 else "."
            domain = dot.join([word() for _ in range(rng.choice((1, 1, 2)))] + [rng.choice(["com", "org", "de", "net"])])
            return f"{rng.choice([word(), word(), f'{word()}.{word()}', f'{word()}_{word()}', f'{word()}{number(2)}'])}{at}{domain}", kind
        if kind == IP:
            return rng.choice([".", " . "]).join(part() for _ in range(4)), kind
        if kind == CARD:
            return grouped(_with_luhn(rng, True), rng.choice([" ", "-", "", ".", "/"])), kind
        a, b, c = number(3), number(3), number(4)
        local = rng.choice([f"({a}) {b}-{c}", f"({a}){b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}) {b} {c}", f"{a} {b} {c}"])
        if rng.random() < 0.25:
            local = rng.choice([f"0{number(2)} {number(4)} {number(4)}", f"0{number(3)} {number(6)}", f"0{number(4)} {number(3)} {number(3)}"])
            return local, kind
        return rng.choice(["", "", "+1 ", f"+{number(2)} "]) + local, kind

    def look_alike() -> str:
        return rng.choice(
            [
                lambda: str(rng.randrange(1000, 3000)),
                lambda: f"{rng.randrange(1900, 2100)}-{rng.randrange(10, 13)}-{rng.randrange(10, 32)}",
                lambda: f"{rng.randrange(1, 32)}.{rng.randrange(1, 13)}.{rng.randrange(1900, 2100)}",
                lambda: f"{number(1)}.{number(1)}.{number(2)}",
                lambda: ".".join(str(rng.randrange(200, 999)) for _ in range(4)) + number(1),
                lambda: f"{number(2)}:{number(2)}",
                lambda: grouped(_with_luhn(rng, False), rng.choice(["", " ", "-"])),
                lambda: number(rng.choice((5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 17, 18))),
                lambda: f"{number(3)},{number(3)}.{number(2)}",
                lambda: f"{number(4)}/{number(4)}",
                lambda: f"{number(2)} {number(3)} {number(2)}",
                lambda: f"{word()} at {word()}. {word()}",
                lambda: f"{number(3)}-{number(1)}-{number(5)}-{number(3)}-{number(1)}",
                lambda: " ".join(number(rng.randrange(1, 6)) for _ in range(rng.randrange(2, 7))),
                lambda: " ".join(f"{k}." for k in range(1, rng.randrange(4, 7))) + f" {word()}",
                lambda: f"{word()} at {word()} dot dot dot {word()}",
                lambda: f"{number(3)}-{number(3)}-{number(4)}-{number(3)}",
                lambda: f"{number(3)}.{number(3)}.{number(4)}.{number(2)}",
                lambda: f"{number(2)} {number(2)} {number(2)} {number(2)}",
            ]
        )()

    cues = {kind: [w for w, k in CUES.items() if k == kind] for kind in range(4)}
    lines = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.randrange(1, 4)):
            if not text or rng.random() < 0.85:
                text += " ".join(word() for _ in range(rng.randrange(1, 4))) + " "
            if rng.random() < 0.5:
                written, kind = entity()
                if rng.random() < 0.5:
                    text += rng.choice(cues[kind]) + rng.choice([" ", ": ", " ", f" {word()} ", f" {word()} {word()} "])
                    if kind == PHONE and rng.random() < 0.25:
                        written = rng.choice([number(10), f"0{number(9)}", f"0{number(10)}"])
                spans.append((len(text), kind, len(text) + len(written)))
                text += written
            else:
                text += f"{rng.choice(list(CUES))} " if rng.random() < 0.15 else ""
                text += look_alike()
            text += rng.choice([" ", ", ", ". "])
        lines.append((text + word(), spans))
    return lines


@lru_cache(maxsize=2)
def train(seed: int = 7, n: int = 700, rounds: int = 6, rate: float = 0.5, penalty: float = 1e-3) -> dict[str, float]:
    """Weights by stochastic ascent on the log-likelihood, with a step of its own per weight."""
    examples = []
    for text, spans in training_lines(seed, n):
        tokens = Tokens(text)
        segments = tokens.segments()
        if segments:
            rows = [span_features(*row) for row in Field.described(tokens, segments)]
            gold = [(tokens.starts[i], kind, tokens.ends[j - 1]) in spans for i, j, kind in segments]
            examples.append((tokens.n, segments, rows, gold))
    field, squares = Field({}), {}
    weights = field.weights
    for _ in range(rounds):
        for length, segments, rows, gold in examples:
            scores = [sum(weights.get(f, 0.0) for f in row) for row in rows]
            slope: dict[str, float] = {}
            for row, p, true in zip(rows, field.expected(length, segments, scores), gold, strict=True):
                if abs(true - p) > 1e-4:
                    for f in row:
                        slope[f] = slope.get(f, 0.0) + true - p
            for f, g in slope.items():
                g -= penalty * weights.get(f, 0.0)
                squares[f] = squares.get(f, 1e-6) + g * g
                weights[f] = weights.get(f, 0.0) + rate * g / math.sqrt(squares[f])
    return dict(weights)


def token_before(text: str, end: int) -> int:
    """Where the token (see ``TOKEN``) that ends at ``end`` begins."""
    kind, start = kind_of(text[end - 1]), end - 1
    while kind and start and kind_of(text[start - 1]) == kind:
        start -= 1
    return start


def kind_of(c: str) -> int:
    """0 for a character that is a token of its own."""
    return 1 if c in "0123456789" else 2 if c.isspace() else 3 if c.isalnum() and not c.isdecimal() else 0


def neighbourhoods(text: str) -> list[tuple[int, int]]:
    """Stretches of text around what segments must hold, merged where they meet.

    They reach as far as a segment can, to the ends of words, and back over the tokens in
    which a cue may be; a segment is seen there as in the whole text.
    """
    found: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if found and a <= found[-1][1]:
            found[-1][1] = max(b, found[-1][1])
            continue
        low = found[-1][1] if found else 0
        # Whole words only: a stretch must not begin or end inside one.
        while a > low and text[a - 1].isalnum() and text[a].isalnum():
            a -= 1
        for _ in range(CUE_TOKENS):
            a = token_before(text, a) if a > low else a
        if found and a <= low:
            found[-1][1] = b
        else:
            found.append([a, b])
    out: list[tuple[int, int]] = []
    for a, b in found:
        while b < len(text) and text[b - 1].isalnum() and text[b].isalnum():
            b += 1
        if out and a < out[-1][1]:
            out[-1] = out[-1][0], b
        else:
            out.append((a, b))
    return out


def field_spans(text: str, field: Field) -> list[tuple[int, int, int]]:
    return [(s + a, kind, e + a) for a, b in neighbourhoods(text) for s, kind, e in field.best(Tokens(text[a:b]))]


def all_spans(text: str, field: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and those that the field adds where no base span is."""
    base = base_spans(text)
    more = field_spans(text, field)
    return base, [s for s in more if all(b[2] <= s[0] or b[0] >= s[2] for b in base)]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or run of overlapping ones, replaced by the kind of its first."""
    parts, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def personal_data(weights: dict[str, float], with_text: bool = False):
    """Column function: text to counts and digest of base spans, all spans, and the redacted text."""
    kept: list[Field] = []
    fields = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

    def batch(texts: list[str]) -> list[dict]:
        if not kept:
            kept.append(Field(weights))
        rows = []
        for text in texts:
            base, more = all_spans(text, kept[0])
            row = {f"n_{name}": sum(k == kind for _, k, _ in base) for kind, name in enumerate(KINDS)}
            row |= {
                "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(),
                "spans": joined(sorted(base + more)),
                "n_added": len(more),
            }
            rows.append(row | {"redacted": redacted(text, base + more)} if with_text else row)
        return rows

    return text_column(batch, fields + ", redacted string" * with_text)


def find_personal_data(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """Personal data of every whole text, as kind:start:end in code points, the end exclusive.

    Base forms always stay; the field adds spans that overlap none of them. With
    ``with_text`` the redacted text comes too. Null text counts as empty and has no spans;
    repeated rows repeat; other columns are not read; an empty table gives no rows.
    """
    weights = train() if weights is None else weights
    return with_results(docs, personal_data(weights, with_text), id_col, text_col)
