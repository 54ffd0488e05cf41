"""Bigram language model with deleted interpolation.

The probability of a token mixes three maximum-likelihood estimates: of the token after its
neighbour, of the token alone, and of any token. Mixture weights belong to buckets of the
neighbour's training count and are learned by expectation-maximisation on a fold of the
training documents whose own counts are deleted first.

Documents are dealt into blocks of about ``BLOCK_BYTES``. A block counts its tokens and
pairs once (``_ask``) and sends each distinct one, as a 64-bit hash, towards the owner of
its hash range. The way has hops: at each, a cell adds up what ``fan`` cells sent it and
sends every fan-th part of its range on, so that the messages of a hop are at most ``fan``
per block however many blocks there are; up to ``MOST_FAN`` blocks one hop is enough. Owners
add up the totals, which go back the same way (``_answer``), so that a block scores its
documents (``_score``) with the counts it needs and no others. The number of blocks and of
ranges follows the size of the texts. A frequent word is one row per block, so no key is hot.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.support import WordIds, id_text, lower_words, mix, prepare
from tabwright.scratch import stage

BLOCK_BYTES = 8 * 1024**2
# Bucket 0: context never seen; bucket b: seen 2^(b-1) times or more, less than 2^b.
BUCKETS = 24
ROUNDS = 60
# Steps per unit of the natural logarithm when held-out events are pooled for the rounds.
STEPS = 16
# No text has these as words, because words hold no white space.
END, START = b"\n", b"\r"
U64 = np.uint64

# Most messages that a block or a cell sends at a hop.
MOST_FAN = 128

ASK = "level int, cell long, range long, sender long, keys binary, trained binary, deleted binary"
ANSWER = (
    "level int, cell long, range long, part long, trained binary, deleted binary, tokens long, types long, fold_tokens long"
)
POOL = "bucket int, single int, pair int, n long"


def _packed(values: np.ndarray) -> bytes:
    """Compressed bytes; those of equal weight lie together."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return values.itemsize.to_bytes(1, "little") + len(values).to_bytes(8, "little") + pa.compress(
        planes.tobytes(), codec="zstd", asbytes=True
    )


def _unpacked(blob: bytes, kind: type) -> np.ndarray:
    width, n = blob[0], int.from_bytes(blob[1:9], "little")
    planes = pa.decompress(blob[9:], decompressed_size=width * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).view(kind).ravel()


class Route:
    """How hashes travel from blocks to owners, in ``hops`` steps of ``fan`` messages each.

    After ``h`` hops there are fan ** h ranges, and a cell (g, r) stands for the keys of range
    r from the blocks g * fan ** h and on.
    """

    def __init__(self, blocks: int, most_fan: int | None = None) -> None:
        most_fan = most_fan or MOST_FAN
        self.hops = 1
        while most_fan**self.hops < blocks:
            self.hops += 1
        self.fan = max(2, math.ceil(blocks ** (1 / self.hops) - 1e-9))
        while self.fan**self.hops < blocks:
            self.fan += 1
        self.unit = 2**64 // self.fan**self.hops

    def cuts(self, hop: int, cell_range: int, keys: np.ndarray) -> list[int]:
        """Where the sorted keys of a range after ``hop`` hops fall into its ``fan`` parts."""
        width = self.unit * self.fan ** (self.hops - hop - 1)
        starts = [(cell_range * self.fan + part) * width for part in range(1, self.fan)]
        return [0, *np.searchsorted(keys, np.array(starts, U64)), len(keys)]

    def sent(self, hop: int, level: int, cell: int, cell_range: int, keys, trained, deleted):
        """Rows of ``ASK`` that a cell sends at its next hop."""
        cuts = self.cuts(hop, cell_range, keys)
        for part, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if b > a:
                yield {
                    "level": level, "cell": cell // self.fan, "range": cell_range * self.fan + part, "sender": cell,
                    "keys": _packed(np.diff(keys[a:b], prepend=U64(0))),
                    "trained": _packed(trained[a:b].astype(np.uint32)), "deleted": _packed(deleted[a:b].astype(np.uint32)),
                }


class Cell:
    """What the messages to a cell add up to, and where each message's keys are in it."""

    def __init__(self, rows: list[dict]) -> None:
        with np.errstate(over="ignore"):
            self.sent = [np.cumsum(_unpacked(r["keys"], U64), dtype=U64) for r in rows]
        self.keys, self.place = np.unique(np.concatenate(self.sent), return_inverse=True)
        self.trained, self.deleted = [
            np.bincount(self.place, np.concatenate([_unpacked(r[c], np.uint32) for r in rows]), len(self.keys)).astype(np.int64)
            for c in ("trained", "deleted")
        ]

    def answers(self, route: Route, rows: list[dict], trained: np.ndarray, deleted: np.ndarray):
        """Rows of ``ANSWER`` to the senders, from totals in the order of ``keys``."""
        at = 0
        for row, own in zip(rows, self.sent, strict=True):
            mine = self.place[at : at + len(own)]
            at += len(own)
            yield {
                "level": row["level"], "cell": row["sender"], "range": row["range"] // route.fan, "part": row["range"] % route.fan,
                "trained": _packed(trained[mine].astype(np.uint32)), "deleted": _packed(deleted[mine].astype(np.uint32)),
            }


class Block:
    """Tokens of a block of texts, and its distinct tokens and pairs sorted by hash."""

    def __init__(self, texts: list[bytes]) -> None:
        words = WordIds()
        start, end = words([START, END])
        ids = [words(lower_words(t)) + [end] for t in texts]
        self.sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.tokens = np.fromiter((i for line in ids for i in line), np.int64, int(self.sizes.sum()))
        self.firsts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.before = np.concatenate([[start], self.tokens[:-1]])
        self.before[self.firsts] = start
        self.start, self.end = start, end
        hashes = words.hashes()
        # Every distinct token, and every distinct pair with the tokens' places in it.
        self.counts = np.bincount(self.tokens, minlength=len(hashes))
        pairs = self.before << 32 | self.tokens
        distinct, self.pair_of, self.pair_counts = np.unique(pairs, return_inverse=True, return_counts=True)
        with np.errstate(over="ignore"):
            together = mix(mix(hashes[distinct >> 32]) * U64(0x9FB21C651E98DF25) + hashes[distinct & 0xFFFFFFFF])
        self.keys = {1: hashes, 2: together}
        self.order = {level: np.argsort(k, kind="stable") for level, k in self.keys.items()}

    def messages(self, block: int, route: Route, trains: bool, in_fold: bool):
        """Rows of ``ASK`` for each part of the range of hashes."""
        for level, counts in ((1, self.counts), (2, self.pair_counts)):
            order = self.order[level]
            trained = counts[order].astype(np.int64) * trains
            yield from route.sent(0, level, block, 0, self.keys[level][order], trained, trained * in_fold)

    def totals(self, answers: pa.Table) -> tuple[dict, dict]:
        """Training counts and deleted counts by level, in the order of ``keys``."""
        found: tuple[dict, dict] = ({}, {})
        rows = sorted(answers.select(["level", "part", "trained", "deleted"]).to_pylist(), key=lambda r: r["part"])
        for level in (1, 2):
            for name, into in zip(("trained", "deleted"), found, strict=True):
                parts = [_unpacked(r[name], np.uint32) for r in rows if r["level"] == level]
                into[level] = np.empty(len(self.keys[level]), np.int64)
                into[level][self.order[level]] = np.concatenate(parts)
        return found


def bucket_of(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(counts.astype(float))[1], BUCKETS - 1)


def estimates(block: Block, single: np.ndarray, pair: np.ndarray, total: int) -> tuple[np.ndarray, ...]:
    """Bucket and the two maximum-likelihood estimates of every token of a block."""
    context = single.copy()
    context[block.start] = single[block.end]
    seen = context[block.before]
    after = pair[block.pair_of] / np.maximum(seen, 1)
    return bucket_of(seen), single[block.tokens] / max(total, 1), np.where(seen > 0, after, 0.0)


def _schema(fields: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in fields.split(", "))])


def _ask(route: Route, fold_from: int) -> Callable:
    schema = _schema(ASK)

    def ask(group: pa.Table) -> pa.Table:
        block = Block(group.column("text").cast(pa.binary()).to_pylist())
        number, trains = group.column("block")[0].as_py(), group.column("trains")[0].as_py()
        return pa.Table.from_pylist(list(block.messages(number, route, trains, number >= fold_from)), schema)

    return ask


def _pass_on(route: Route, hop: int) -> Callable:
    """A cell after ``hop`` hops sends what it adds up to on."""
    schema = _schema(ASK)

    def pass_on(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        cell = Cell(rows)
        first = rows[0]
        sent = route.sent(hop, first["level"], first["cell"], first["range"], cell.keys, cell.trained, cell.deleted)
        return pa.Table.from_pylist(list(sent), schema)

    return pass_on


def _answer(route: Route) -> Callable:
    """Owners: the totals of each key, and a row (cell -1) of what the range holds in all."""
    schema = _schema(ANSWER)

    def answer(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        cell = Cell(rows)
        out = list(cell.answers(route, rows, cell.trained, cell.deleted))
        out.append({"level": rows[0]["level"], "cell": -1, "range": rows[0]["range"], "tokens": int(cell.trained.sum()),
                    "types": int((cell.trained > 0).sum()), "fold_tokens": int(cell.deleted.sum())})
        return pa.Table.from_pylist(out, schema)

    return answer


def _hand_back(route: Route) -> Callable:
    """A cell on the way: the answers to its parts, in order, are those to its senders."""
    schema = _schema(ANSWER)

    def hand_back(messages: pa.Table, answers: pa.Table) -> pa.Table:
        rows = messages.to_pylist()
        if not rows:
            return schema.empty_table()
        cell = Cell(rows)
        parts = sorted(answers.select(["part", "trained", "deleted"]).to_pylist(), key=lambda r: r["part"])
        trained, deleted = [np.concatenate([_unpacked(r[c], np.uint32) for r in parts]) for c in ("trained", "deleted")]
        return pa.Table.from_pylist(list(cell.answers(route, rows, trained, deleted)), schema)

    return hand_back


def _counts(asked: DataFrame, route: Route) -> DataFrame:
    """The answers to all blocks (``cell``), and the totals of all ranges (cell -1), staged."""
    sent = [asked]
    address = ["level", "cell", "range"]
    for hop in range(1, route.hops):
        # Read on the way there and on the way back.
        sent[-1] = stage(sent[-1], "messages")
        sent.append(sent[-1].groupBy(*address).applyInArrow(_pass_on(route, hop), ASK))
    answers = stage(sent.pop().groupBy(*address).applyInArrow(_answer(route), ANSWER), "counts")
    totals = answers.filter("cell = -1")
    for messages in reversed(sent):
        replies = answers.filter("cell >= 0").groupBy(*address)
        answers = stage(messages.groupBy(*address).cogroup(replies).applyInArrow(_hand_back(route), ANSWER), "counts")
    return answers.filter("cell >= 0").unionAll(totals)


def _pool(tokens: int, types: int) -> Callable:
    """Held-out events of a fold block, pooled by bucket and rounded log estimates."""

    def steps(ratio: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.where(ratio > 0, np.rint(np.log(ratio) * STEPS), -(10**6)).astype(np.int64)

    def pool(docs: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([("bucket", pa.int32()), ("single", pa.int32()), ("pair", pa.int32()), ("n", pa.int64())])
        if not docs.num_rows:
            return schema.empty_table()
        block = Block(docs.column("text").cast(pa.binary()).to_pylist())
        trained, deleted = block.totals(answers)
        bucket, single, pair = estimates(block, trained[1] - deleted[1], trained[2] - deleted[2], tokens)
        events = np.stack([bucket, steps(single * (types + 1)), steps(pair * (types + 1))], axis=1)
        distinct, n = np.unique(events, axis=0, return_counts=True)
        columns = [pa.array(distinct[:, i].astype(np.int32)) for i in range(3)]
        return pa.Table.from_arrays([*columns, pa.array(n.astype(np.int64))], schema=schema)

    return pool


def learn_weights(events: np.ndarray) -> np.ndarray:
    """Weights (any token, token alone, token after its neighbour) for each bucket.

    ``events`` has rows (bucket, rounded log estimate alone, rounded log estimate after the
    neighbour, number). One event of each kind is added, so no weight becomes 0.
    """
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = 0.5, 0.5, 0.0
    bucket, n = events[:, 0].astype(int), events[:, 3].astype(float)
    ratios = np.stack([np.ones(len(events)), *(np.where(x > -(10**6), np.exp(x / STEPS), 0.0) for x in events[:, 1:3].T)], 1)
    prior = np.array([[1.0, 1.0, 0.0]] + [[1.0, 1.0, 1.0]] * (BUCKETS - 1))
    for _ in range(ROUNDS):
        parts = weights[bucket] * ratios
        parts *= (n / parts.sum(axis=1))[:, None]
        weights = prior + np.stack([np.bincount(bucket, parts[:, i], BUCKETS) for i in range(3)], 1)
        weights /= weights.sum(axis=1, keepdims=True)
    return weights


def _score(tokens: int, types: int, weights: np.ndarray, schema: pa.Schema) -> Callable:
    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        block = Block(docs.column("text").cast(pa.binary()).to_pylist())
        trained, _ = block.totals(answers)
        bucket, single, pair = estimates(block, trained[1], trained[2], tokens)
        mixed = weights[bucket]
        logs = np.log10(mixed[:, 0] / (types + 1) + mixed[:, 1] * single + mixed[:, 2] * pair)
        counts = trained[1][block.tokens]
        base = np.log10((counts + 1) / (tokens + types + 1))
        per_text = [np.add.reduceat(x, block.firsts) for x in ((counts > 0).astype(np.int64), base, logs)]
        columns = [docs.column("doc_id"), docs.column("held_out"), pa.array(block.sizes), pa.array(per_text[0]),
                   pa.array(np.full(docs.num_rows, tokens, np.int64)), pa.array(per_text[1]), pa.array(per_text[2])]
        return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], schema=schema)

    return score


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 7,
    held_out_fold: int = 2,
    deleted_fold: int = 3,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Scores of every whole text under the model learned from the same table.

    Documents whose crc32(id as text) mod ``folds`` is ``held_out_fold`` are not learned
    from; the fold ``deleted_fold`` of the others teaches the mixture weights. Tokens are
    words with A-Z lower-cased, then one end. Columns: the id, held_out, n_tokens, n_known
    (tokens seen in training), train_tokens, base_score (add-one unigram) and score (log10
    probability). Null text counts as empty (the end alone), a null id as the empty id.
    Repeated rows repeat and count again. Without training documents every known count is
    0. Other columns are not read; an empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    fold = F.crc32(id_text("doc_id").cast("binary")) % folds
    main, deleted = fold != deleted_fold, fold == deleted_fold
    held = fold == held_out_fold
    sizes = texts.agg(*[F.sum(F.when(x, F.octet_length("text") + 16)).alias(n) for x, n in ((held, "held"), (~held & main, "train"), (deleted, "fold"))]).first()
    n_held, n_train, n_fold = [-(-(sizes[n] or 1) // block_bytes) for n in ("held", "train", "fold")]
    # Blocks: held-out ones first, then training ones, the deleted fold at the end.
    # The text deals too, so that rows of one id (or none) do not fill a single block.
    spot = F.xxhash64(id_text("doc_id"), F.col("text"))
    blocks = (
        F.when(held, F.pmod(spot, F.lit(n_held)))
        .when(main, F.pmod(spot, F.lit(n_train)) + n_held)
        .otherwise(F.pmod(spot, F.lit(n_fold)) + n_held + n_train)
    )
    dealt = texts.select("doc_id", "text", blocks.cast("int").alias("block"), held.alias("held_out"), (~held).alias("trains"))
    fold_from = n_held + n_train
    route = Route(fold_from + n_fold)
    asked = dealt.select("text", "block", "trains").groupBy("block").applyInArrow(_ask(route, fold_from), ASK)
    answers = _counts(asked, route)
    known = answers.filter("cell = -1 and level = 1").agg(F.sum("tokens"), F.sum("types"), F.sum("fold_tokens")).first()
    tokens, types, fold_tokens = [x or 0 for x in known]
    replies = answers.filter("cell >= 0").select(F.col("cell").cast("int").alias("block"), "level", "part", "trained", "deleted")

    fold_docs = dealt.filter(deleted).select("text", "block").groupBy("block")
    fold_replies = replies.filter(F.col("block") >= fold_from).groupBy("block")
    pooled = fold_docs.cogroup(fold_replies).applyInArrow(_pool(tokens - fold_tokens, types), POOL)
    rows = pooled.groupBy("bucket", "single", "pair").agg(F.sum("n").alias("n")).toPandas()
    weights = learn_weights(rows.to_numpy(np.int64).reshape(-1, 4))

    id_field = docs.select(F.col(id_col).alias("doc_id")).schema[0]
    out = f"doc_id {id_field.dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(out))
    scored = dealt.select("doc_id", "text", "block", "held_out").groupBy("block")
    result = scored.cogroup(replies.groupBy("block")).applyInArrow(_score(tokens, types, weights, schema), out)
    return result.withColumnRenamed("doc_id", id_col)
