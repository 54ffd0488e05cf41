"""Token counts that look whole pre-tokens up before merging anything.

Before any text is read, each string of the vocabulary is merged alone. Those that come
out as one token are proven: a pre-token equal to one of them counts 1, without a merge.
Only the other pre-tokens go through the merges, each distinct one once.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import regex
from pyspark.sql import DataFrame

from tabwright.llm.bpe import REMEMBERED, read_merges
from tabwright.llm.support import text_column, with_results


class Counter:
    """Counts tokens as the library does for the tokenizer file at ``path``."""

    def __init__(self, path: str, pattern: str) -> None:
        self.merges, vocabulary, special = read_merges(path)
        tokens = list(vocabulary)
        self.proven = set()
        for token, ids in zip(tokens, self.merges.ids(tokens), strict=True):
            if len(ids) == 1 and ids[0] == vocabulary[token]:
                try:
                    self.proven.add(token.decode())
                except UnicodeDecodeError:
                    continue  # part of a character: never a whole pre-token
        self.pattern = regex.compile(pattern)
        ordered = sorted((s for s in special if s), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, ordered))) if ordered else None
        self.counts: dict[str, int] = {}

    def __call__(self, texts: list[str]) -> list[int]:
        totals, pieces = [], []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            totals.append(len(parts) - 1)
            found = [self.pattern.findall(p) for p in parts]
            pieces.append(found[0] if len(found) == 1 else list(chain.from_iterable(found)))
        self._learn(pieces)
        get = self.counts.__getitem__
        return [n + sum(map(get, p)) for n, p in zip(totals, pieces, strict=True)]

    def _learn(self, pieces: list[list[str]]) -> None:
        wanted = set(chain.from_iterable(pieces))
        fresh = wanted.difference(self.counts)
        if len(self.counts) + len(fresh) > REMEMBERED:
            self.counts.clear()
            fresh = wanted
        rest = list(fresh - self.proven)
        self.counts.update(dict.fromkeys(fresh & self.proven, 1))
        merged = self.merges.ids([p.encode() for p in rest])
        self.counts.update(zip(rest, map(len, merged), strict=True))


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


def counted(path: str, pattern: str, limit: int):
    """Column function: text to n_bytes, n_tokens and over_limit."""

    def batch(texts: list[str]) -> list[dict]:
        tokens = counter(path, pattern)(texts)
        return [
            {"n_bytes": len(t.encode()), "n_tokens": n, "over_limit": n > limit}
            for t, n in zip(texts, tokens, strict=True)
        ]

    return text_column(batch, "n_bytes long, n_tokens long, over_limit boolean")


def count_tokens(
    docs: DataFrame,
    path: str,
    pattern: str,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Tokens of every whole text, without begin or end tokens; special strings count 1 each.

    Null text counts as empty (0 tokens); repeated rows repeat; other columns are not
    read, so their names cannot clash; an empty table gives no rows.
    """
    return with_results(docs, counted(path, pattern, limit), id_col, text_col)
