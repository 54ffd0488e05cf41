"""Jaccard join of documents over word shingles, with PartEnum signatures.

Set sizes fall into bands whose ends differ by the wanted similarity; two sets similar
enough lie in one band or in neighbouring ones, so each set signs for its own band and
for the next. Sets of one band that are similar enough differ in at most ``k`` elements.
The domain (hashed shingles) is cut into ``n1`` parts, so that some part holds at most
``k2`` of the differences, and each part into ``n2`` cells; one signature stands for each
choice of ``n2 - k2`` cells. The cells left out may hold the differences, so two sets that
are similar enough share a signature: no link is lost. Choices of empty cells sign only
where a set has too few others.

Rows of one shingle set form a class, numbered by a hash of the set, and one row signs for
it. Nearly all signatures occur once. So they first travel packed, five bytes and about two
bits each, to owners of ranges, which tell the repeated ones; only those travel as rows with
their class. Cutting signatures to their range and 40 bits may merge two buckets, which
brings more members together, never fewer. Members of a bucket (one signature) are compared with its least member, the pivot. Where
that leaves a bucket in several components, element counts in parts of the domain rule most
pairs out. What remains together is compared on whole sets. A whole set travels once per
pair, so pairs are first ruled out by the parities of many small cells (counts and parities
are stored with each row's class, whole sets are made for the documents that need them), and of a document's
pivots only the nearest is tried before the others, which count only where components
differ still. Both steps deal a large bucket
or family into bounded blocks, large components apart from the rest, and take up only pairs
of blocks that more than one component is in; a pair of blocks gives no more links than
join the components. Every link is checked on whole sets.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import combinations
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tabwright.llm.components import components
from tabwright.llm.support import WordIds, bounded, chained, lower_words, mix, prepare
from tabwright.scratch import scoped_staging, short_lived_shuffles, stage

# A list of ids is broadcast only when it was counted and is not longer than this.
BROADCAST_IDS = 2_000_000
BROADCAST_CLASSES = 500_000
# About how many members of a bucket are in a block, and documents and elements in a block
# of whole sets (a longer set is alone); elements compared at a time.
BUCKET_DOCS = 2048
BLOCK_DOCS = 1024
BLOCK_ELEMENTS = 400_000
CHUNK_ELEMENTS = 2048
# Signatures packed or compared at a time, about how many an owner of a range gets at most, and
# too few for one where the session has more partitions; bytes kept of one beside its range.
PACKED_SIGNATURES = 1 << 18
RANGE_SIGNATURES = 1 << 21
FEW_SIGNATURES = 1 << 16
LOW_BYTES = 5
# Parts of the domain whose element counts rule pairs out.
COUNT_CELLS = 64
U64 = np.uint64


def differences(size: int, percent: int) -> int:
    """Most elements in which two sets of at most ``size`` each differ, if similar enough."""
    return (100 - percent) * 2 * size // (100 + percent)


@lru_cache(maxsize=10_000)
def choices(k: int, least: int) -> tuple[int, int, int]:
    """n1, n2 and k2 for ``k`` differences between sets of ``least`` elements or more.

    A part gets k // n1 <= k2 differences. A few parts more than that needs stand in for
    those that a small set leaves nearly empty.
    """
    if k == 0:
        return 1, 1, 0
    if k <= 2:
        return 1, 2 * k + 1, k
    needed = k // 2 + 1
    n1 = needed
    while n1 < 2 * needed:
        empty = math.exp(-least / (3 * n1))
        bad = 3 * empty**2 - 2 * empty**3
        if n1 * (1 - bad) - 2 * math.sqrt(n1 * bad) >= needed:
            break
        n1 += 1
    return n1, 3, 1


@lru_cache(maxsize=100_000)
def band(size: int, percent: int) -> tuple[int, int, int]:
    """Number of the band that holds ``size``, its upper end, and that of the next band."""
    number, low = 0, 1
    while True:
        high = low * 100 // percent
        if size <= high:
            return number, high, (high + 1) * 100 // percent
        number, low = number + 1, high + 1


def _sign(shingles: np.ndarray, running: np.ndarray, tag: int, high: int, percent: int) -> np.ndarray:
    """Signatures of one sorted set for one band; ``running`` sums its mixed elements.

    A choice of cells without elements says nothing and would bring strangers together. It
    is left out where the parts all of whose choices have elements are so many that the
    differences cannot spoil them all. Of two similar sets only one need leave it out: one
    of its parts then shows both the same elements.
    """
    k = differences(high, percent)
    n1, n2, k2 = choices(k, high * percent * percent // 10_000)
    cells = n1 * n2
    with np.errstate(over="ignore"):
        starts = np.arange(1, cells, dtype=U64) * U64((2**64 - 1) // cells)
        edges = np.concatenate([[0], np.searchsorted(shingles, starts), [len(shingles)]])
        ends = running[edges]
        sums, sizes = (ends[1:] - ends[:-1]).reshape(n1, n2), np.diff(edges).reshape(n1, n2)
        if k2 == 1:
            kept, filled = [x.sum(axis=1, dtype=x.dtype)[:, None] - x for x in (sums, sizes)]
        else:
            some = [list(c) for c in combinations(range(n2), n2 - k2)]
            kept, filled = [np.array([[x[0, c].sum(dtype=x.dtype) for c in some]]) for x in (sums, sizes)]
        place = np.arange(kept.size, dtype=U64) + (U64(tag) << U64(32))
        signed = mix(kept.ravel() + mix(place + U64(1)))
    whole = (filled > 0).all(axis=1).sum()
    return signed[filled.ravel() > 0] if whole * (k2 + 1) > k else signed


def signatures(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of a sorted set of hashed shingles, for its own band and the next."""
    number, high, next_high = band(len(shingles), percent)
    with np.errstate(over="ignore"):
        running = np.concatenate([np.zeros(1, U64), np.cumsum(mix(shingles), dtype=U64)])
    own = _sign(shingles, running, number, high, percent)
    return np.concatenate([own, _sign(shingles, running, number + 1, next_high, percent)])


def shingle_sets(texts: list[bytes], length: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text; a shorter text is one shingle."""
    words = WordIds()
    ids = [np.array(words(lower_words(t)), np.int64) for t in texts]
    hashes = words.hashes()
    for each in ids:
        yield np.unique(chained(hashes[each], min(length, len(each)))) if len(each) else np.empty(0, U64)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def node_of(shingles: np.ndarray, seed: int) -> int:
    """The number of a set's class."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes(), seed)).view(np.int64))


def cell_counts(shingles: np.ndarray) -> bytes:
    """Elements of a sorted set in each of ``COUNT_CELLS`` equal parts of the domain, 255 at most."""
    edges = np.searchsorted(shingles, np.arange(1, COUNT_CELLS, dtype=U64) * U64(2**64 // COUNT_CELLS))
    counts = np.diff(np.concatenate([[0], edges, [len(shingles)]]))
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def parities(shingles: np.ndarray) -> bytes:
    """A bit per cell of the domain: whether it holds an odd number of elements; four cells an element or more."""
    cells = max(64, 1 << (4 * len(shingles) - 1).bit_length())
    held = np.bincount((shingles & U64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((held & 1).astype(np.uint8)).tobytes()


def _set_table(texts: DataFrame, length: int, seed: int) -> DataFrame:
    """doc_id, said, n_shingles, node, digest, cell counts and parities of each text; from node on null without words."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in kinds]
            for found in shingle_sets(_texts(batch), length):
                rows[0].append(len(found))
                rows[1].append(node_of(found, seed) if len(found) else None)
                rows[2].append(xxhash.xxh3_128_hexdigest(found.tobytes()) if len(found) else None)
                rows[3].append(cell_counts(found) if len(found) else None)
                rows[4].append(parities(found) if len(found) else None)
            columns = [pa.array(r, k) for r, k in zip(rows, kinds, strict=True)]
            names = ["doc_id", "said", "n_shingles", "node", "digest", "counts", "odd"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("said"), *columns], names)

    kind = "doc_id long, said long, n_shingles long, node long, digest string, counts binary, odd binary"
    return texts.mapInArrow(sets, kind)


def signature_count(size: int, percent: int) -> int:
    """Most signatures of a set of ``size``, for both of its bands."""
    _, *highs = band(size, percent)
    cut = [choices(differences(high, percent), high * percent * percent // 10_000) for high in highs]
    return sum(n1 * math.comb(n2, k2) for n1, n2, k2 in cut)


def _ranges(table: DataFrame, percent: int) -> int:
    """How many ranges the signatures are dealt into: as many as the session's partitions, unless they get too few or many."""
    size = F.col("n_shingles")
    sizes = table.filter(size > 0).groupBy(F.floor(F.log(size) * 4)).agg(F.count("*").alias("n"), F.max(size).alias("size"))
    total = sum(r["n"] * signature_count(r["size"], percent) for r in sizes.collect())
    session = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-total // RANGE_SIGNATURES), min(session, total // FEW_SIGNATURES))


def packed(signed: list[np.ndarray], ranges: int) -> Iterator[tuple[int, bytes, bytes]]:
    """For each range that holds signatures: its number, their low bytes text by text, and a mask of owners.

    The mask has a bit 1 for each signature, and a bit 0 after those of each text.
    """
    values = np.concatenate(signed)
    places = np.repeat(np.arange(len(signed), dtype=np.int32), [len(s) for s in signed])
    at = (((values >> U64(32)) * U64(ranges)) >> U64(32)).astype(np.uint16 if ranges <= 1 << 16 else np.uint32)
    order = np.argsort(at, kind="stable")
    places, at = places[order], at[order]
    low = values[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :LOW_BYTES]
    cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1), len(at)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            mask = np.zeros(b - a + len(signed), np.uint8)
            mask[places[a:b] + np.arange(b - a)] = 1
            yield int(at[a]), low[a:b].tobytes(), np.packbits(mask).tobytes()


def unpacked(low: bytes, mask: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Low bits of the signatures, and the places of their texts."""
    whole = np.zeros((len(low) // LOW_BYTES, 8), np.uint8)
    whole[:, :LOW_BYTES] = np.frombuffer(low, np.uint8).reshape(-1, LOW_BYTES)
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(mask, np.uint8)))
    return whole.view("<u8").ravel().astype(U64), (ones - np.arange(len(ones))).astype(np.int32)


def _packed_signatures(texts: DataFrame, length: int, percent: int, seed: int, ranges: int) -> DataFrame:
    """The signatures of each text that has words, packed by block of texts and range; a row of each block has its classes."""
    names = ["range", "block", "low", "mask", "nodes"]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: list[int] = []
        signed: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            listed = np.array(nodes, np.int64).tobytes()
            block = int(np.uint64(xxhash.xxh3_64_intdigest(listed)).view(np.int64))
            rows = [(block % ranges, block, None, None, listed)] if nodes else []
            if nodes:
                rows += [(at, block, low, mask, None) for at, low, mask in packed(signed, ranges)]
            nodes.clear()
            signed.clear()
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        held = 0
        for batch in batches:
            for found in shingle_sets(_texts(batch), length):
                if len(found):
                    nodes.append(node_of(found, seed))
                    signed.append(signatures(found, percent))
                    held += len(signed[-1])
                if held >= PACKED_SIGNATURES:
                    yield flush()
                    held = 0
        yield flush()

    return texts.mapInArrow(pack, "range int, block long, low binary, mask binary, nodes binary")


def _repeated_signatures(packs: DataFrame, ranges: int) -> DataFrame:
    """block, place and value: the signatures that occur twice or more, and (is_node) the class at each place.

    A task holds the packed bytes of its range and compares about ``PACKED_SIGNATURES`` at a time.
    """
    names = ["block", "place", "value", "is_node"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    bits = U64(8 * LOW_BYTES)

    def table(blocks: np.ndarray, places: np.ndarray, values: np.ndarray, is_node: bool) -> pa.RecordBatch:
        columns = [blocks, places, values, np.full(len(values), is_node)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes, bytes]] = []
        for batch in batches:
            for at, block, low, mask, nodes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if nodes is None:
                    held.append((at, block, low, mask))
                else:
                    values = np.frombuffer(nodes, np.int64)
                    yield table(np.full(len(values), block), np.arange(len(values)), values, True)
        pieces = max(1, -(-sum(len(x[2]) for x in held) // (LOW_BYTES * PACKED_SIGNATURES)))
        for piece in range(pieces):
            keys, places, packs = [], [], []
            for number, (at, _, low, mask) in enumerate(held):
                key, place = unpacked(low, mask)
                if pieces > 1:
                    # By the topmost bits kept.
                    mine = ((key >> (bits - U64(16))) * U64(pieces)) >> U64(16) == U64(piece)
                    key, place = key[mine], place[mine]
                keys.append(key | (U64(at) << bits))
                places.append(place)
                packs.append(np.full(len(key), number, np.int32))
            if keys:
                key, place, pack = (np.concatenate(x) for x in (keys, places, packs))
                del keys, places, packs
                order = np.argsort(key)
                again = key[order[1:]] == key[order[:-1]]
                order = order[np.concatenate([again, [False]]) | np.concatenate([[False], again])] if len(order) else order
                pack, place, key = pack[order], place[order], key[order]
                blocks = np.array([x[1] for x in held], np.int64)
                for start in range(0, len(key), 1 << 16):
                    some = slice(start, start + (1 << 16))
                    yield table(blocks[pack[some]], place[some], key[some].view(np.int64), False)

    dealt = packs.repartitionById(ranges, F.col("range"))
    return dealt.mapInArrow(repeated, "block long, place long, value long, is_node boolean")


def _members_of_buckets(signers: DataFrame, table: DataFrame, length: int, percent: int, seed: int) -> DataFrame:
    """signature and doc (a class) of each member of a bucket of two or more."""
    ranges = _ranges(table, percent)
    packs = _packed_signatures(signers, length, percent, seed, ranges)
    repeated = stage(_repeated_signatures(packs, ranges), "repeated")
    members = repeated.filter("not is_node").select("block", "place", F.col("value").alias("signature"))
    nodes = repeated.filter("is_node").select("block", "place", F.col("value").alias("doc"))
    # Only a block signed again after a failure, from rows in another order, could lack its classes.
    doc = F.coalesce("doc", F.raise_error(F.lit("signatures of a block without classes")).cast("long"))
    return members.join(nodes, ["block", "place"], "left").select("signature", doc.alias("doc"))


def _classes(texts: DataFrame, length: int) -> tuple[DataFrame, DataFrame, int]:
    """The set of each text, the classes of equal sets, and a seed under which no two share a number.

    A class has node, n (its rows) and its least doc_id with that row's said.
    """
    seed = 0
    while True:
        table = stage(_set_table(texts, length, seed), "sets")
        one = F.min(F.struct("doc_id", "said")).alias("one")
        spans = [F.min("digest").alias("low"), F.max("digest").alias("high")]
        classes = table.filter("doc_id is not null and node is not null").groupBy("node").agg(one, F.count("*").alias("n"), *spans)
        classes = stage(classes.select("node", "one.*", "n", "low", "high"), "classes")
        if classes.filter("low != high").isEmpty():
            return table, classes.drop("low", "high"), seed
        seed += 1


def _signers(texts: DataFrame, table: DataFrame, classes: DataFrame) -> DataFrame:
    """One text per class: rows alone in theirs, and one of each class of several."""
    several = bounded(stage(classes.filter("n > 1"), "several"), BROADCAST_CLASSES)
    key = ["doc_id", "said"]
    passed = table.join(several.select("node"), "node", "left_semi").select(*key).distinct()
    alone = texts.join(bounded(stage(passed, "passed"), BROADCAST_IDS), key, "left_anti")
    chosen = texts.join(several.select(*key), key, "left_semi").groupBy(*key).agg(F.first("text").alias("text"))
    columns = [*key, "text"]
    return alone.select(*columns).unionAll(chosen.select(*columns))


def _buckets(flat: DataFrame) -> DataFrame:
    """signature, pivot and doc for each member (signature, doc) of a bucket but its least, the pivot.

    The rows stream past sorted by signature; what is held is the bucket at hand's pivot.
    """

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pivot = None, None
        for batch in batches:
            sig, doc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(sig):
                continue
            starts = np.concatenate([[True], sig[1:] != sig[:-1]])
            first = doc[np.maximum.accumulate(np.where(starts, np.arange(len(sig)), 0))]
            if last is not None and sig[0] == last:
                first[: np.argmax(starts[1:]) + 1 if starts[1:].any() else len(sig)] = pivot
            last, pivot = sig[-1], first[-1]
            keep = first != doc
            columns = [pa.array(x[keep]) for x in (sig, first, doc)]
            yield pa.RecordBatch.from_arrays(columns, ["signature", "pivot", "doc"])

    dealt = flat.repartition("signature").sortWithinPartitions("signature", "doc")
    return dealt.mapInArrow(members, "signature long, pivot long, doc long")


def _sketches(table: DataFrame, classes: DataFrame) -> DataFrame:
    """doc (a class), the size of its set, cell counts and parities; one row per class."""
    several = bounded(stage(classes.filter("n > 1").select("node"), "several"), BROADCAST_CLASSES)
    columns = [F.col("node").alias("doc"), F.col("n_shingles").alias("n"), "counts", "odd"]
    usable = table.filter("doc_id is not null and node is not null").select("node", "n_shingles", "counts", "odd")
    firsts = [F.first(c).alias(c) for c in ("n_shingles", "counts", "odd")]
    chosen = usable.join(several, "node", "left_semi").groupBy("node").agg(*firsts)
    return usable.join(several, "node", "left_anti").unionByName(chosen).select(*columns)


def _sets_of(texts: DataFrame, table: DataFrame, classes: DataFrame, ids: DataFrame, length: int, seed: int) -> DataFrame:
    """doc (a class) and its whole set, for the listed classes."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets(_texts(batch), length))
            nodes = pa.array([node_of(s, seed) for s in found], pa.int64())
            whole = pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([nodes, whole], ["doc", "shingles"])

    listed = stage(classes.join(ids, classes["node"] == ids["doc"], "left_semi").select("doc_id", "said"), "listed")
    key = ["doc_id", "said"]
    listed = bounded(listed, BROADCAST_IDS)
    wanted = texts.join(listed, key, "left_semi").select(*key, "text")
    # Rows that repeat id and text are few: only they are shuffled, and no set is.
    again = stage(table.join(listed, key, "left_semi").groupBy(*key).count().filter("count > 1").select(*key), "again")
    if not again.isEmpty():
        again = bounded(again, BROADCAST_IDS)
        firsts = wanted.join(again, key, "left_semi").groupBy(*key).agg(F.first("text").alias("text"))
        wanted = wanted.join(again, key, "left_anti").unionAll(firsts)
    return wanted.mapInArrow(sets, "doc long, shingles array<long>")


#: doc and whole set of the classes that a column ``doc`` lists.
WholeSets = Callable[[DataFrame], DataFrame]


def _only(sets: DataFrame, ids: DataFrame, column: str = "doc") -> DataFrame:
    """The sets of the listed classes, so that a join does not shuffle the others."""
    listed = stage(ids.select(F.col(column).alias("doc")).distinct(), "listed")
    return sets.join(bounded(listed, BROADCAST_IDS), "doc", "left_semi")


def apart(first: pa.Array, second: pa.Array) -> pa.Array:
    """In how many elements two sets differ at least, by their cell counts."""
    a, b = [np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(-1, COUNT_CELLS) for x in (first, second)]
    return pa.array(np.abs(a.astype(np.int16) - b).sum(axis=1, dtype=np.int64))


def odd_apart(first: pa.Array, second: pa.Array) -> pa.Array:
    """In how many elements two sets differ at least, by their parities."""

    def differ(one: bytes, other: bytes) -> int:
        a, b = sorted((np.frombuffer(x, np.uint8) for x in (one, other)), key=len)
        while len(b) > len(a):
            # Cells are the low bits of an element: two halves on one another are the cells of half as many.
            b = b[: len(b) // 2] ^ b[len(b) // 2 :]
        return int(np.bitwise_count(a ^ b).sum())

    return pa.array([differ(a, b) for a, b in zip(first.to_pylist(), second.to_pylist(), strict=True)], pa.int64())


def _ruled(pairs: DataFrame, first: DataFrame, second: DataFrame, percent: int, column: str, least) -> DataFrame:
    """u, v and differ of the pairs that ``least`` differences by ``column`` do not rule out; whole sets stay where they are."""
    left = first.select(F.col("doc").alias("u"), F.col("n").alias("n_u"), F.col(column).alias("c_u"))
    right = second.select(F.col("doc").alias("v"), F.col("n").alias("n_v"), F.col(column).alias("c_v"))
    allowed = F.expr(f"(n_u + n_v) * {100 - percent} div {100 + percent}")
    both = pairs.join(left, "u").join(right, "v")
    differ = F.arrow_udf(least, "long")(F.col("c_u"), F.col("c_v"))
    return both.select("u", "v", differ.alias("differ"), allowed.alias("allowed")).filter("differ <= allowed").drop("allowed")


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that sizes and cell counts do not rule out, and in how many elements they differ at least."""
    return _ruled(pairs, sets, sets, percent, "counts", apart)


def _linked(pairs: DataFrame, sets: DataFrame, whole: WholeSets, percent: int) -> DataFrame:
    """The pairs (u, v) whose whole sets are similar enough; the sets travel for those whose parities allow it."""
    ends = [_only(sets, pairs, c) for c in ("u", "v")]
    likely = stage(_ruled(pairs, *ends, percent, "odd", odd_apart).select("u", "v"), "likely")
    made = whole(likely.select(F.explode(F.array("u", "v")).alias("doc")).distinct())
    left = _only(made, likely, "u").select(F.col("doc").alias("u"), F.col("shingles").alias("first"))
    right = _only(made, likely, "v").select(F.col("doc").alias("v"), F.col("shingles").alias("second"))
    n, m = F.size("first").cast("long"), F.size("second").cast("long")
    both = F.size(F.array_intersect("first", "second")).cast("long")
    near = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return (
        likely.join(left, "u").join(right, "v").filter(near)
        .filter(both * 100 >= (n + m - both) * percent).select("u", "v")
    )


def _links_of_pivots(possible: DataFrame, sets: DataFrame, whole: WholeSets, percent: int) -> DataFrame:
    """Links among the possible pairs (u, v), enough to join what all of them join.

    In a large family a document meets many pivots, and nearly all those pairs join what is
    joined already. The nearest pivot of each document goes first; another pair is compared
    only where its ends are in unlike components after that.
    """
    nearest = possible.groupBy("v").agg(F.min(F.struct("differ", "u")).alias("at"))
    with scoped_staging(possible.sparkSession):
        first = stage(_linked(nearest.select("at.u", "v"), sets, whole, percent), "links", keep=True)
    found = components(first)
    ends = [found.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in")) for c in ("u", "v")]
    rest = possible.select("u", "v").join(ends[0], "u", "left").join(ends[1], "v", "left")
    rest = rest.filter(F.coalesce("u_in", "u") != F.coalesce("v_in", "v")).select("u", "v")
    # The pairs tried are apart as well, if they are not similar.
    rest = rest.join(nearest.select("at.u", "v"), ["u", "v"], "left_anti")
    with scoped_staging(possible.sparkSession):
        return first.unionAll(stage(_linked(rest, sets, whole, percent), "links", keep=True))


class Bucket:
    """Members of one bucket, or of two of its blocks, and the edges between those that may be similar."""

    def __init__(
        self, docs: np.ndarray, parts: np.ndarray, sizes: np.ndarray, counts: np.ndarray, sides: np.ndarray | None = None
    ) -> None:
        sides = np.zeros(len(docs), np.int64) if sides is None else sides
        order = np.argsort(sides, kind="stable")
        self.docs, self.parts, self.sizes = docs[order], parts[order], sizes[order]
        self.counts = counts[order].astype(np.int16)
        # Members of the first side meet all of the second, those of an only side the ones behind them.
        self.first = int((sides == 0).sum()) if sides.any() else 0

    def edges(self, percent: int) -> list[tuple[int, int]]:
        """As few as connect the members that may be similar across components.

        Two sets differ in at least as many elements as their cell counts differ, so a pair
        whose counts differ by more than similar sets may is none.
        """
        labels = np.arange(len(self.docs))
        found = []
        for i in range(self.first or len(self.docs) - 1):
            begin = self.first or i + 1
            rest = np.flatnonzero(self.parts[begin:] != self.parts[i]) + begin
            rest = rest[labels[rest] != labels[i]]
            for start in range(0, len(rest), 4096):
                some = rest[start : start + 4096]
                apart = np.abs(self.counts[some] - self.counts[i]).sum(axis=1)
                allowed = (100 - percent) * (self.sizes[some] + self.sizes[i]) // (100 + percent)
                for j in some[apart <= allowed]:
                    if labels[j] != labels[i]:
                        found.append((int(self.docs[i]), int(self.docs[j])))
                        labels[labels == labels[j]] = labels[i]
        return found


def _edges_in_buckets(percent: int):
    """Stream members sorted by bucket and pair of blocks; one pair is held at a time."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None

        def flush() -> list[tuple[int, int]]:
            if not held:
                return []
            docs, parts, sizes, counts, sides = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            return Bucket(docs, parts, sizes, counts, sides).edges(percent)

        def table(rows: list[tuple[int, int]]) -> pa.RecordBatch:
            u, v = zip(*rows, strict=True) if rows else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        for batch in batches:
            found = []
            key = np.stack([batch.column(c).to_numpy() for c in ("signature", "i", "j")], axis=1)
            docs, parts, sizes, sides = [batch.column(c).to_numpy() for c in ("doc", "component", "n", "side")]
            raw = np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.uint8).reshape(-1, COUNT_CELLS)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(key)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:
                    if tuple(key[a]) != last:
                        found += flush()
                    last = tuple(key[a])
                    held.append((docs[a:b], parts[a:b], sizes[a:b], raw[a:b], sides[a:b]))
            yield table(found)
        yield table(flush())

    return edges


def _in_blocks(rows: DataFrame, key: str, limit: int, percent: int) -> DataFrame:
    """``rows`` of (key, doc, component, n, weight) in pairs of blocks (i, j) with their side.

    A group of rows with one key and a weight above ``limit`` is dealt into blocks of about
    that weight: a component that fills a block has blocks of its own, the others share
    theirs. Pairs of blocks come up when more than one component and sizes near enough are
    in them. A row is in as many pairs as its block.
    """
    per = rows.groupBy(key, "component").agg(F.sum("weight").alias("own"))
    totals = per.groupBy(key).agg(
        F.sum("own").alias("total"), F.sum(F.when(F.col("own") < limit, F.col("own"))).alias("pooled")
    )
    large = totals.filter(F.col("total") > limit).drop("total")
    filled = F.col("own") >= limit
    parts = F.ceil(F.when(filled, F.col("own")).otherwise(F.col("pooled")) / limit)
    large = stage(per.join(large, key).select(key, "component", filled.alias("filled"), parts.alias("parts")), "large")
    whole = {c: F.lit(0).cast("long") for c in ("i", "j", "side")}
    if large.isEmpty():
        return rows.withColumns(whole)
    dealt = rows.join(bounded(large, BROADCAST_CLASSES), [key, "component"], "left")
    place = F.pmod(F.xxhash64("doc"), F.col("parts"))
    # Only a label: two blocks of one label are one block.
    label = F.when(F.col("filled"), F.xxhash64("component", place)).otherwise(place)
    dealt = stage(dealt.select(*rows.columns, F.when(F.col("parts").isNotNull(), label).alias("block")), "dealt")
    small = dealt.filter("block is null").drop("block").withColumns(whole)
    dealt = dealt.filter("block is not null")
    blocks = dealt.groupBy(key, "block").agg(
        F.min("n").alias("low"), F.max("n").alias("high"),
        F.min("component").alias("first"), F.max("component").alias("last"),
    )
    blocks = stage(blocks, "blocks")
    names = ("block", "low", "high", "first", "last")
    one, other = [blocks.select(key, *[F.col(c).alias(f"{c}_{side}") for c in names]) for side in (0, 1)]
    meet = one.join(other, key).filter(
        f"block_0 <= block_1 and low_1 * {percent} <= high_0 * 100 and low_0 * {percent} <= high_1 * 100 "
        "and least(first_0, first_1) < greatest(last_0, last_1)"
    )
    places = meet.select(key, F.col("block_0").alias("i"), F.col("block_1").alias("j"))

    def at(column: str, side: int) -> Column:
        return F.struct(F.col(column).alias("block"), F.lit(side).cast("long").alias("side"))

    both = F.when(F.col("i") == F.col("j"), F.array(at("i", 0))).otherwise(F.array(at("i", 0), at("j", 1)))
    sides = stage(places.select(key, "i", "j", F.explode(both).alias("at")).select(key, "i", "j", "at.*"), "sides")
    return small.unionByName(dealt.join(sides, [key, "block"]).drop("block"))


def _members_to_compare(buckets: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """family, doc, component, n and weight of the documents that the pivots did not settle.

    A bucket is settled when all its members are in one component; of buckets with the same
    members one is enough. In each other bucket, members of unlike components that may be
    similar by their cell counts are connected; families are the connected pieces.
    """
    found = components(links)
    known = stage(
        buckets.join(found, buckets["doc"] == found["node"], "left")
        .select("signature", "doc", F.coalesce("component", "doc").alias("component")),
        "known",
    )
    each = F.xxhash64("doc")
    spans = known.groupBy("signature").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.count("*").alias("members"), F.min(each).alias("a"), F.max(each).alias("b"), F.bit_xor(each).alias("c"),
    )
    mixed = spans.filter("low < high").groupBy("members", "a", "b", "c").agg(F.min("signature").alias("signature"))
    mixed = stage(mixed.select("signature", "members"), "mixed")
    large = mixed.filter(F.col("members") > BUCKET_DOCS).select("signature")
    has_large = not large.isEmpty()

    def opened(signatures: DataFrame) -> DataFrame:
        """signature, doc, component, n and counts of the members of open buckets; one join fetches both numbers."""
        rows = known.join(signatures, "signature").join(sets.select("doc", "n", "counts"), "doc")
        return rows.select("signature", "doc", "component", "n", "counts", F.lit(1).alias("weight"))

    # Buckets of one block need no dealing, and are not stored.
    whole = {c: F.lit(0).cast("long") for c in ("i", "j", "side")}
    pairs = opened(mixed.filter(F.col("members") <= BUCKET_DOCS).select("signature")).withColumns(whole)
    if has_large:
        pairs = pairs.unionByName(_in_blocks(stage(opened(large), "open"), "signature", BUCKET_DOCS, percent))
    order = ["signature", "i", "j"]
    dealt = pairs.select(*order, "side", "doc", "component", "n", "counts").repartition(*order)
    edges = dealt.sortWithinPartitions(*order, "side", "doc").mapInArrow(_edges_in_buckets(percent), "u long, v long")
    families = components(edges)
    of = families.select(F.col("node").alias("doc"), F.col("component").alias("family"))
    found = found.select(F.col("node").alias("doc"), "component")
    rows = of.join(found, "doc", "left").join(sets.select("doc", "n"), "doc")
    # A block is full with BLOCK_DOCS small sets, or with fewer whose elements fill it.
    weight = F.col("n") + BLOCK_ELEMENTS // BLOCK_DOCS
    return rows.select("family", "doc", F.coalesce("component", "doc").alias("component"), "n", weight.alias("weight"))


def _compare(percent: int):
    """Links between two blocks (or inside one), as few as join the components they join."""

    def compare(group: pa.Table) -> pa.Table:
        docs, parts = group.column("doc").to_numpy(), group.column("component").to_numpy()
        sides, lists = group.column("side").to_numpy(), group.column("shingles").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        elements, column = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        row = np.repeat(np.arange(len(docs)), sizes)
        # An element of one document is in no intersection.
        shared = np.bincount(column, minlength=len(elements)) > 1
        number = np.cumsum(shared) - 1
        kept = shared[column]
        row, column = row[kept], number[column[kept]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == sides.max())
        both = np.zeros((len(left), len(right)), np.float64)
        for start in range(0, int(shared.sum()), CHUNK_ELEMENTS):
            a, b = np.searchsorted(column, [start, start + CHUNK_ELEMENTS])
            there = np.zeros((len(docs), CHUNK_ELEMENTS), np.float32)
            there[row[a:b], column[a:b] - start] = 1
            both += there[left] @ there[right].T
        union = sizes[left][:, None] + sizes[right][None, :] - both
        near = (both * 100.0 >= union * float(percent)) & (parts[left][:, None] != parts[right][None, :])
        roots = {int(p): int(p) for p in parts}

        def root(x: int) -> int:
            while roots[x] != x:
                roots[x] = roots[roots[x]]
                x = roots[x]
            return x

        links = []
        for i, j in zip(*np.nonzero(near), strict=True):
            x, y = root(int(parts[left[i]])), root(int(parts[right[j]]))
            if x != y:
                roots[max(x, y)] = min(x, y)
                links.append((int(docs[left[i]]), int(docs[right[j]])))
        u, v = zip(*links, strict=True) if links else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return compare


class Parities:
    """Parities of the members of a pair of blocks, by their length and folded to a shorter one."""

    def __init__(self, odd: list[bytes]) -> None:
        self.sizes = np.array([len(x) for x in odd])
        self.row = np.zeros(len(odd), np.int64)
        self.made: dict[tuple[int, int], np.ndarray] = {}
        for size in np.unique(self.sizes):
            there = np.flatnonzero(self.sizes == size)
            self.row[there] = np.arange(len(there))
            self.made[size, size] = np.stack([np.frombuffer(odd[i], np.uint64) for i in there])

    def folded(self, size: int, to: int) -> np.ndarray:
        if (size, to) not in self.made:
            twice = self.folded(size, 2 * to)
            half = twice.shape[1] // 2
            self.made[size, to] = twice[:, :half] ^ twice[:, half:]
        return self.made[size, to]

    def apart(self, one: int, others: np.ndarray) -> np.ndarray:
        """In how many elements each of the others differs at least from the one."""
        found = np.empty(len(others), np.int64)
        for size in np.unique(self.sizes[others]):
            to = min(size, self.sizes[one])
            at = np.flatnonzero(self.sizes[others] == size)
            mine = self.folded(self.sizes[one], to)[self.row[one]]
            found[at] = np.bitwise_count(self.folded(size, to)[self.row[others[at]]] ^ mine).sum(axis=1, dtype=np.int64)
        return found


def _edges_by_parities(percent: int):
    """As few edges as connect the members of two blocks (or of one) that may be similar across components."""

    def edges(group: pa.Table) -> pa.Table:
        docs, parts, sizes, sides = [group.column(c).to_numpy() for c in ("doc", "component", "n", "side")]
        odd = Parities(group.column("odd").to_pylist())
        labels = np.arange(len(docs))
        met = sides == sides.max()
        found = []
        for i in np.flatnonzero(sides == 0):
            rest = np.flatnonzero(met & (parts != parts[i]) & (labels != labels[i]))
            small, large = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
            rest = rest[small * 100 >= large * percent]
            allowed = (100 - percent) * (sizes[rest] + sizes[i]) // (100 + percent)
            for start in range(0, len(rest), 256):
                some = rest[start : start + 256]
                for j in some[odd.apart(i, some) <= allowed[start : start + 256]]:
                    if labels[j] != labels[i]:
                        found.append((int(docs[i]), int(docs[j])))
                        labels[labels == labels[j]] = labels[i]
        u, v = zip(*found, strict=True) if found else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return edges


def _likely_members(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``members`` in the smaller families that parities leave connected; those left alone go.

    Cell counts say little of large sets, so strangers fill a family. Parities say more and
    are a sixteenth of a set or less; whole sets then travel for what they leave.
    """
    rows = _in_blocks(members, "family", BLOCK_ELEMENTS, percent).join(_only(sets, members).select("doc", "odd"), "doc")
    grouped = rows.select("family", "i", "j", "side", "doc", "component", "n", "odd").groupBy("family", "i", "j")
    families = components(grouped.applyInArrow(_edges_by_parities(percent), "u long, v long"))
    of = families.select(F.col("node").alias("doc"), F.col("component").alias("family"))
    return members.drop("family").join(of, "doc").select("family", "doc", "component", "n", "weight")


def _links_between_blocks(members: DataFrame, whole: WholeSets, percent: int) -> DataFrame:
    """Links that pivots did not find: blocks of a family against one another, on whole sets."""
    rows = _in_blocks(members, "family", BLOCK_ELEMENTS, percent).join(whole(members.select("doc")), "doc")
    grouped = rows.select("family", "i", "j", "side", "doc", "component", "shingles").groupBy("family", "i", "j")
    return grouped.applyInArrow(_compare(percent), "u long, v long")


def jaccard_components(
    docs: DataFrame,
    length: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Two documents link when their sets of ``length``-word shingles (A-Z lower-cased) have
    100 * intersection >= ``percent`` * union. component_id is the least id reachable by
    links. A text with fewer words is one shingle. Null and wordless texts have the empty
    set and link with nothing. Ids are integers; a row with a null id links with nothing
    and has no component; rows with equal ids are one document, linked by each of its texts,
    and repeat in the result. Other columns are not read. An empty table gives no rows.
    """
    with short_lived_shuffles(prepare(docs.sparkSession)):
        table, names = _named(docs, length, percent, id_col, text_col)
    # Joined to stored names, a class that holds a third of the rows can be split.
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return table.join(bounded(names, BROADCAST_CLASSES), "node", "left").select(
        F.col("doc_id").alias(id_col), "n_shingles", component.alias("component_id")
    )


def _named(docs: DataFrame, length: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The set of each row, and the component_id of each class that has another than its only row's id."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("said", F.xxhash64("text"))
    table, classes, seed = _classes(rows, length)
    texts = rows.filter("doc_id is not null")
    # Signatures are many times a set's size in bytes: they are made anew, not stored.
    with scoped_staging(spark):
        signers = _signers(texts, table, classes)
        buckets = stage(_buckets(_members_of_buckets(signers, table, length, percent, seed)), "buckets", keep=True)
    pairs = buckets.select(F.col("pivot").alias("u"), F.col("doc").alias("v")).distinct()
    ids = buckets.select(F.explode(F.array("pivot", "doc")).alias("doc"))
    sets = stage(_only(_sketches(table, classes), ids), "candidates")

    def whole(ids: DataFrame) -> DataFrame:
        return stage(_sets_of(texts, table, classes, ids, length, seed), "whole")

    possible = stage(_possible(pairs, sets, percent), "possible")
    links = _links_of_pivots(possible, sets, whole, percent)

    with scoped_staging(spark):
        members = stage(_members_to_compare(buckets, links, sets, percent), "members")
        members = stage(_likely_members(members, sets, percent), "members")
        links = links.unionAll(stage(_links_between_blocks(members, whole, percent), "links", keep=True))

    # An id that stands for several texts ties their classes together.
    usable = table.filter("doc_id is not null and node is not null")
    several = usable.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low != high")
    ties = usable.join(bounded(stage(several, "several"), BROADCAST_IDS), "doc_id").select(F.col("node").alias("u"), F.col("low").alias("v"))
    found = components(links.unionAll(ties))
    # Components go by their least id.
    named = found.join(classes, "node").select("node", "component", "doc_id")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = named.join(least, "component").select("node", "component_id")
    alone = classes.filter("n > 1").select("node", F.col("doc_id").alias("own"))
    return table, stage(alone.join(linked, "node", "full").select("node", F.coalesce("component_id", "own").alias("component_id")), "names")
