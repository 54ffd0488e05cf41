"""Byte-level BPE over padded matrices, and its use for encoding and decoding documents.

Distinct pre-tokens of a batch are bucketed by byte length and laid out as the rows of a
padded matrix. In each round every row merges its leftmost pair of least rank; pair ranks
come from a hash table held in arrays, finished rows leave the matrix and every other row
gets one column shorter. Pre-tokens longer than ``LONG_BYTES`` would need as many rounds
as they have bytes, so the same merges are made with a heap there.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame

from tabwright.llm.support import text_column, with_results

LONG_BYTES = 1024
# Rows times columns of one matrix, and pre-tokens remembered by a worker.
MATRIX_CELLS = 2_000_000
REMEMBERED = 100_000
NO_PAIR = np.int32(2**31 - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Rank of a pair of ids: open addressing over a power of two of slots."""

    def __init__(self, left: np.ndarray, right: np.ndarray, ranks: np.ndarray) -> None:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, 2**64 - 1, np.uint64)
        self.ranks = np.full(1 << bits, NO_PAIR, np.int32)
        self.probes = 0
        slots, waiting = self._slots(keys), np.arange(len(keys))
        while len(waiting):
            at = slots[waiting]
            free = self.ranks[at] == NO_PAIR
            taken, first = np.unique(at[free], return_index=True)
            placed = waiting[free][first]
            self.keys[taken], self.ranks[taken] = keys[placed], ranks[placed]
            waiting = np.setdiff1d(waiting, placed, assume_unique=True)
            slots[waiting] = (slots[waiting] + 1) & self.mask
            self.probes += 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * _SPREAD) >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, ``NO_PAIR`` where two ids do not merge; a negative id is padding."""
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        out = np.full(left.size, NO_PAIR, np.int32)
        rest = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left[rest].astype(np.uint64) << np.uint64(32)) | right[rest].astype(np.uint64)
        slots = self._slots(keys)
        for _ in range(self.probes):
            found, ranks = self.keys[slots] == keys, self.ranks[slots]
            out[rest[found]] = ranks[found]
            more = ~found & (ranks != NO_PAIR)
            if not more.any():
                break
            rest, keys, slots = rest[more], keys[more], (slots[more] + 1) & self.mask
        return out.reshape(shape)


class Merges:
    """The merges of a vocabulary: ids of single bytes, ranked pairs, and the id a rank makes."""

    def __init__(self, byte_ids: list[int], pairs: list[tuple[int, int, int]], made: np.ndarray | None = None):
        self.byte_ids = np.array(byte_ids, np.int32)
        left, right, ranks = np.array(pairs, np.int64).reshape(-1, 3).T
        self.table = PairTable(left, right, ranks.astype(np.int32))
        self.made = made

    def ids(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Token ids of each piece, merged alone."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if len(piece) > LONG_BYTES:
                out[i] = self._by_heap(piece)
            elif piece:
                # Widths 1, 2, 3, 4, 6, 8, 12, 16, 24, ...: padding stays under half.
                top = 1 << (len(piece) - 1).bit_length()
                width = top if top < 4 or len(piece) > top * 3 // 4 else top * 3 // 4
                buckets.setdefault(width, []).append(i)
        for width, members in buckets.items():
            step = max(1, MATRIX_CELLS // width)
            for start in range(0, len(members), step):
                self._by_matrix(pieces, members[start : start + step], width, out)
        return out

    def _made(self, ranks: np.ndarray) -> np.ndarray:
        return ranks if self.made is None else self.made[ranks]

    def _by_matrix(self, pieces: list[bytes], rows: list[int], width: int, out: list[np.ndarray]) -> None:
        raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows), np.uint8)
        ids = self.byte_ids[raw].reshape(len(rows), width)
        sizes = np.fromiter((len(pieces[i]) for i in rows), np.int64, len(rows))
        ids[np.arange(width) >= sizes[:, None]] = -1
        rows = np.array(rows)
        ranks = self.table.get(ids[:, :-1], ids[:, 1:])
        while True:
            if ids.shape[1] > 1:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(rows)), at]
                done = best == NO_PAIR
            else:
                done = np.ones(len(rows), bool)
            for row, line, size in zip(rows[done], ids[done], sizes[done], strict=True):
                out[row] = line[:size]
            if done.all():
                return
            going = ~done
            rows, ids, ranks, sizes = rows[going], ids[going], ranks[going], sizes[going] - 1
            at, best = at[going], best[going]
            each = np.arange(len(rows))
            kept = np.arange(ids.shape[1] - 1) <= at[:, None]
            ids[each, at] = self._made(best)
            ids = np.where(kept, ids[:, :-1], ids[:, 1:])
            if ids.shape[1] > 1:
                ranks = np.where(kept[:, :-1], ranks[:, :-1], ranks[:, 1:])
                after = at < ids.shape[1] - 1
                r, a = each[after], at[after]
                ranks[r, a] = self.table.get(ids[r, a], ids[r, a + 1])
                before = at > 0
                r, a = each[before], at[before]
                ranks[r, a - 1] = self.table.get(ids[r, a - 1], ids[r, a])

    def _by_heap(self, piece: bytes) -> np.ndarray:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        first = self.table.get(ids[:-1], ids[1:])
        ids, n = ids.tolist(), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i, ids[i], ids[i + 1]) for i, rank in enumerate(first.tolist()) if rank != NO_PAIR]
        heapq.heapify(heap)

        def push(i: int) -> None:
            if i >= 0 and after[i] < n:
                pair = np.array([ids[i]]), np.array([ids[after[i]]])
                rank = int(self.table.get(*pair)[0])
                if rank != NO_PAIR:
                    heapq.heappush(heap, (rank, i, ids[i], ids[after[i]]))

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = int(self._made(np.array([rank]))[0]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            push(before[i])
            push(i)
        return np.array([x for x in ids if x >= 0], np.int32)


def split_pairs(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """Every way to make a token from two others, with the token's rank."""
    get = ranks.get
    pairs = []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = get(token[:cut]), get(token[cut:])
            if left is not None and right is not None:
                pairs.append((left, right, rank))
    return pairs


class RankCoder:
    """Encoder and decoder for a rank file; one is kept per worker and file."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.merges = Merges([self.ranks[bytes([b])] for b in range(256)], split_pairs(self.ranks))
        self.pattern = regex.compile(pattern)
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.fromiter(map(len, tokens), np.int64, size)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        pieces = [self.pattern.findall(t) for t in texts]
        fresh = [p for p in set(chain.from_iterable(pieces)) if p not in self.known]
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known.clear()
            fresh = list(set(chain.from_iterable(pieces)))
        raw = [p.encode() for p in fresh]
        whole = [self.ranks.get(p) for p in raw]
        rest = [i for i, rank in enumerate(whole) if rank is None]
        for i, rank in enumerate(whole):
            if rank is not None:
                self.known[fresh[i]] = rank.to_bytes(4, "little")
        for i, ids in zip(rest, self.merges.ids([raw[i] for i in rest]), strict=True):
            self.known[fresh[i]] = ids.astype("<u4").tobytes()
        get = self.known.__getitem__
        return [b"".join(map(get, p)) for p in pieces]

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ids) or not ends[-1]:
            return b""
        jump = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.bytes[jump + np.arange(ends[-1])].tobytes()


@lru_cache(maxsize=2)
def rank_coder(path: str, pattern: str) -> RankCoder:
    return RankCoder(path, pattern)


def encoded(ranks_path: str, pattern: str, keep_ids: bool = True):
    """Column function: text to n_tokens, ids (binary, when kept) and the two digests."""
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids

    def batch(texts: list[str]) -> list[dict]:
        coder = rank_coder(ranks_path, pattern)
        rows = []
        for blob in coder.encode(texts):
            decoded = coder.decode(np.frombuffer(blob, "<u4").astype(np.int64))
            row = {
                "n_tokens": len(blob) // 4,
                "ids_sha256": hashlib.sha256(blob).hexdigest(),
                "decoded_sha256": hashlib.sha256(decoded).hexdigest(),
            }
            rows.append(row | {"ids": blob} if keep_ids else row)
        return rows

    return text_column(batch, fields)


def encode_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """Token ids of every whole text, and what they decode to, as digests.

    Each match of ``pattern`` is encoded by itself with the ranks at ``ranks_path``, no
    special tokens. Null text counts as empty and has no ids; repeated rows repeat; other
    columns are not read, so their names cannot clash; an empty table gives no rows.
    """
    return with_results(docs, encoded(ranks_path, pattern, keep_ids), id_col, text_col)


def read_merges(path: str) -> tuple[Merges, dict[bytes, int], list[str]]:
    """Merges, vocabulary (as bytes) and special strings of a tokenizer file of the JSON kind."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    # A byte that prints stands for itself in the file; the others follow from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}

    def raw(token: str) -> bytes:
        return bytes(letters[c] for c in token)

    special = [t["content"] for t in whole["added_tokens"]]
    ids = whole["model"]["vocab"]
    vocabulary = {raw(t): i for t, i in ids.items() if t not in special}
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in whole["model"]["merges"]]
    pairs = [(ids[a], ids[b], rank) for rank, (a, b) in enumerate(merges)]
    made = np.array([ids[a + b] for a, b in merges], np.int32)
    return Merges([vocabulary[bytes([b])] for b in range(256)], pairs, made), vocabulary, special
