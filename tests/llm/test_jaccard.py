"""The Jaccard join against all pairs, and that signatures lose no link."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabwright.llm import jaccard
from tabwright.llm.components import components
from tabwright.llm.jaccard import band, choices, differences, jaccard_components, signatures
from tests.llm.helpers import documents


def brute_force(rows, length, percent):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        n = min(length, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for at, a in enumerate(ids):
        for b in ids[:at]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def found(docs, length, percent):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs, length, percent).collect()}


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for length, percent in ((3, 90), (5, 80)):
        assert found(docs, length, percent) == brute_force(rows, length, percent)


@pytest.mark.parametrize("block_docs", [3, 512])
def test_families_of_near_copies(spark, monkeypatch, block_docs):
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(jaccard, "BLOCK_ELEMENTS", 400 * block_docs)
    monkeypatch.setattr(jaccard, "BUCKET_DOCS", block_docs)
    rng = random.Random(block_docs)
    texts = []
    for family in range(6):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([12, 60, 150]))]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 20))):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(3000)}"
            texts.append(" ".join(copy))
        texts.append(" ".join(base).upper())
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert found(documents(spark, texts), 3, 90) == brute_force(rows, 3, 90)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        for size in [*range(1, 60), 100, 333, 1000]:
            for _ in range(5):
                base = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
                other = base
                while True:
                    drop = rng.integers(0, len(other))
                    trial = np.unique(np.append(np.delete(other, drop), rng.integers(0, 2**64, rng.integers(0, 2), dtype=np.uint64)))
                    both = len(np.intersect1d(base, trial))
                    if not len(trial) or 100 * both < percent * (len(base) + len(trial) - both):
                        break
                    other = trial
                assert set(signatures(base, percent)) & set(signatures(other, percent)), (percent, size)


def test_cell_counts_never_rule_out_similar_sets():
    rng = np.random.default_rng(8)
    for percent in (80, 90):
        sets = []
        for _ in range(12):
            base = np.unique(rng.integers(0, 2**64, int(rng.integers(10, 400)), dtype=np.uint64))
            for _ in range(4):
                n = int(len(base) * rng.uniform(0, 0.2))
                kept = np.delete(base, rng.choice(len(base), n, replace=False))
                sets.append(np.unique(np.concatenate([kept, rng.integers(0, 2**64, n // 3, dtype=np.uint64)])))
        counts = np.stack([np.frombuffer(jaccard.cell_counts(s), np.uint8) for s in sets])
        ids = np.arange(len(sets))
        edges = jaccard.Bucket(ids, ids, np.array([len(s) for s in sets]), counts).edges(percent)
        label = ids.copy()
        for a, b in edges:
            label[label == label[b]] = label[a]
        assert len(edges) < len(sets) - 1
        for a in ids:
            for b in ids[:a]:
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    assert label[a] == label[b]


def test_parities_never_rule_out_similar_sets():
    rng = np.random.default_rng(9)
    ruled = 0
    for size in (1, 15, 17, 64, 300, 1000, 5000):
        base = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        for share in (0.0, 0.1, 0.2, 0.7):
            kept = np.delete(base, rng.choice(len(base), int(len(base) * share), replace=False))
            other = np.unique(np.concatenate([kept, rng.integers(0, 2**64, size // 10, dtype=np.uint64)]))
            differ = len(np.setxor1d(base, other))
            found = jaccard.odd_apart(*(pa.array([jaccard.parities(s)]) for s in (base, other)))[0].as_py()
            assert found <= differ and (differ - found) % 2 == 0
            ruled += share == 0.7 and found > 20 * (len(base) + len(other)) // 180
    assert ruled >= 5


def test_parities_part_a_family_of_strangers():
    """Large strangers whose cell counts are alike: edges by parities join the similar ones only, in one block or two."""
    rng = np.random.default_rng(3)
    sets = []
    for group in range(8):
        base = np.unique(rng.integers(0, 2**64, 1000 + 12 * group, dtype=np.uint64))
        sets += [base, np.unique(np.append(base[: len(base) * 19 // 20], rng.integers(0, 2**64, 30, dtype=np.uint64)))]
    docs = list(range(len(sets)))
    for sides in ([0] * len(sets), [d % 2 for d in docs]):
        group = pa.table({"doc": docs, "component": docs, "n": [len(s) for s in sets], "side": sides,
                          "odd": [jaccard.parities(s) for s in sets]})
        edges = jaccard._edges_by_parities(80)(group)
        assert {frozenset(e.values()) for e in edges.to_pylist()} == {frozenset({d, d + 1}) for d in docs[::2]}


def test_whole_sets_travel_for_few_pairs_of_a_family(spark, monkeypatch):
    """A family whose members meet many pivots: about one pair a member is compared, and all are joined."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(60):
        copy = list(base)
        for at in rng.sample(range(300), 3):
            copy[at] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    tried, possible = [], []
    linked, ruled = jaccard._linked, jaccard._possible
    monkeypatch.setattr(jaccard, "_linked", lambda pairs, *rest: tried.append(pairs.count()) or linked(pairs, *rest))
    monkeypatch.setattr(jaccard, "_possible", lambda *all: possible.append(ruled(*all)) or possible[-1])
    got = found(documents(spark, texts), 5, 80)
    assert {c for _, c in got.values()} == {0}
    assert possible[0].count() > 150 and sum(tried) < 100


def test_edges_leave_no_similar_pair_apart_across_components():
    """0 and 1 are of one component, so are 2 and 3; 0-2 and 1-3 may both be similar."""
    counts = np.zeros((4, 64), np.uint8)
    counts[[0, 2], 0], counts[[1, 3], 1] = 200, 200
    bucket = jaccard.Bucket(np.arange(4), np.array([7, 7, 8, 8]), np.full(4, 200), counts)
    assert {frozenset(e) for e in bucket.edges(90)} == {frozenset({0, 2}), frozenset({1, 3})}


@pytest.mark.parametrize("ranges", [1, 7, 70_000])
def test_packed_signatures_come_out_again(ranges):
    rng = np.random.default_rng(ranges)
    sets = [np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (1, 2, 9, 40, 300, 2000, 1)]
    signed = [signatures(s, 80) for s in sets]
    for s, own in zip(sets, signed, strict=True):
        assert len(own) <= jaccard.signature_count(len(s), 80)
    got = []
    for at, low, mask in jaccard.packed(signed, ranges):
        values, places = jaccard.unpacked(low, mask)
        got += [(int(p), at, int(v)) for v, p in zip(values, places, strict=True)]
    wanted = [(p, (int(v) >> 32) * ranges >> 32, int(v) % 2**40) for p, own in enumerate(signed) for v in own]
    assert sorted(got) == sorted(wanted)


@pytest.mark.parametrize("piece", [100, 2000])
def test_only_repeated_signatures_travel_as_rows(spark, monkeypatch, piece):
    """Members of buckets are those of signatures that two or more texts share, by any number of blocks, ranges and pieces."""
    monkeypatch.setattr(jaccard, "PACKED_SIGNATURES", piece)
    monkeypatch.setattr(jaccard, "RANGE_SIGNATURES", piece)
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(60)]
    texts += [f"{t} end" for t in texts[:20]] + ["", "one"]
    signed = {}
    for shingles in jaccard.shingle_sets([t.encode() for t in texts], 5):
        if len(shingles):
            for value in signatures(shingles, 80):
                signed.setdefault(value, []).append(jaccard.node_of(shingles, 0))
    wanted = sorted(sorted(nodes) for nodes in signed.values() if len(nodes) > 1)
    docs = documents(spark, texts).repartition(5)
    table = jaccard._set_table(docs.withColumn("said", F.lit(0).cast("long")), 5, 0)
    if piece == 100:
        assert jaccard._ranges(table, 80) > 50
        monkeypatch.setattr(jaccard, "_ranges", lambda *_: 3)
    groups = {}
    for r in jaccard._members_of_buckets(docs, table, 5, 80, 0).collect():
        groups.setdefault(r["signature"], []).append(r["doc"])
    assert sorted(sorted(nodes) for nodes in groups.values()) == wanted


def test_little_is_stored_and_shuffle_files_do_not_gather(spark, monkeypatch):
    """Strangers that share a passage meet in buckets, but only near copies get whole sets; a query's shuffle files end with it."""
    rng = random.Random(12)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join([passage, *(f"w{rng.randrange(10**6)}" for _ in range(60))]) for _ in range(50)]
    texts += [f"{t} end" for t in texts[:5]]
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> int:
        files = disk.getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))

    spark.sparkContext._jvm.System.gc()
    held, sizes, real = shuffled(), {}, jaccard.stage

    def staged(df, name, *rest, **named):
        out = real(df, name, *rest, **named)
        left.append(shuffled() - held)
        sizes.setdefault(name, []).append(out.count())
        return out

    left = []
    monkeypatch.setattr(jaccard, "stage", staged)
    got = found(documents(spark, texts), 5, 80)
    assert {i: c for i, (_, c) in got.items()} == {i: i - 50 if i >= 50 else i for i in range(55)}
    assert sizes["buckets"][0] > 200
    assert sum(sizes["whole"]) <= 15
    assert max(left) <= 0


def test_bands_and_choices():
    for percent in (50, 80, 90):
        for size in range(1, 500):
            number, high, next_high = band(size, percent)
            largest = size * 100 // percent
            assert band(largest, percent)[0] in (number, number + 1)
            assert size <= high and largest <= next_high
    for k in range(200):
        for least in (1, 3 * k, 20 * k):
            n1, n2, k2 = choices(k, least)
            assert k // n1 <= k2 < n2
    assert differences(10, 90) == 1


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(200)] + [(500, x) for x in range(600, 900)]
    links += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    rng.shuffle(links)
    rows = components(spark.createDataFrame(links, "u long, v long")).collect()
    got = {r["node"]: r["component"] for r in rows}
    assert len(got) == len(rows)
    assert got == {n: root(n) for a, b in links if a != b for n in (a, b)}


def test_ids_of_several_texts_tie_them_together(spark):
    rows = [(1, "a b c d"), (2, "a b c d"), (3, "e f g h"), (2, "e f g h"), (4, "i j k l"), (5, "i j k l")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(documents(spark, rows), 3, 90).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_near_copies_of_both_texts_of_an_id(spark, parts):
    """An id with the texts A and B, a near copy of A and one of B: one component, on any layout."""
    rng = random.Random(11)
    rows = []
    for group in range(40):
        a, b = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(2)]
        for at, words in ((1, a), (1, b), (2, [*a, "end"]), (3, [*b, "end"])):
            rows.append((10 * group + at, " ".join(words)))
    rng.shuffle(rows)
    docs = documents(spark, rows).repartition(parts)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(docs, 5, 80).collect()}
    assert got == {i: i // 10 * 10 + 1 for i, _ in rows}


def test_numbers_of_classes_are_drawn_anew_if_two_share_one(spark, monkeypatch):
    real = jaccard.node_of
    monkeypatch.setattr(jaccard, "node_of", lambda shingles, seed: real(shingles, seed) if seed else len(shingles))
    rows = [(1, "a b c d"), (2, "e f g h"), (3, "A b c d"), (4, "e f g h i j k l m n o p"), (5, "")]
    docs = documents(spark, rows)
    table, classes, seed = jaccard._classes(docs.withColumn("said", F.xxhash64("text")), 3)
    assert seed == 1 and classes.count() == 3 and table.count() == 5


def test_blocks_bring_all_components_together(spark):
    """Every pair of documents of one key and of unlike components and near sizes is in some pair of blocks."""
    rng = random.Random(6)
    rows = [(key, doc, 7 if doc < 60 else doc, 100 + rng.randrange(60), 1) for key in (1, 2) for doc in range(60 + 25 * key)]
    rows += [(3, 0, 0, 100, 1), (3, 1, 1, 100, 1)]
    table = spark.createDataFrame(rows, "k long, doc long, component long, n long, weight long")
    dealt = jaccard._in_blocks(table, "k", 10, 80).collect()
    groups = {}
    for r in dealt:
        groups.setdefault((r["k"], r["i"], r["j"]), {}).setdefault(r["side"], []).append(r)
    met = set()
    for (key, i, j), sides in groups.items():
        assert max(len(x) for x in sides.values()) <= 25
        left, right = sides[0], sides.get(1, sides[0])
        met |= {(key, *sorted((a["doc"], b["doc"]))) for a in left for b in right if a["component"] != b["component"]}
    wanted = {
        (k, a, b) for k, a, p, n, _ in rows for k2, b, q, m, _ in rows
        if k == k2 and a < b and p != q and 100 * min(n, m) >= 80 * max(n, m)
    }
    assert wanted <= met
    # Blocks of the large component alone are not compared among themselves.
    assert not any(all(r["component"] == 7 for s in sides.values() for r in s) for sides in groups.values())


def test_one_outsider_in_a_hot_bucket(spark):
    """20,000 members of one component and one outsider: only the outsider's block meets the others."""
    rows = [(1, doc, 0 if doc else 1, 500, 1) for doc in range(20_000)]
    table = spark.createDataFrame(rows, "signature long, doc long, component long, n long, weight long")
    dealt = jaccard._in_blocks(table, "signature", 2048, 90)
    sizes = dealt.groupBy("i", "j").count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 2 * 2048


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    texts = [None, "", " \t", "one", "ONE", "one two", "one two", long, long + " end", (5, "one two"), (None, "one two")]
    docs = documents(spark, texts).withColumns({"digest": F.lit(1), "doc": F.lit("x"), "component": F.lit(None)})
    rows = jaccard_components(docs, 3, 90).collect()
    assert len(rows) == 11
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert got == {0: (0, 0), 1: (0, 1), 2: (0, 2), 3: (1, 3), 4: (1, 3), 5: (1, 5), 6: (1, 5),
                   7: (29_998, 7), 8: (29_999, 7), None: (1, None)}
    assert jaccard_components(docs.limit(0), 3, 90).count() == 0
