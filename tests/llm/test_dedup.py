"""Substring, suffix and near-duplicate removal against brute force, with awkward rows."""

import collections
import hashlib
import random

import numpy as np
import pytest

from quire.llm import blocks as B
from quire.llm.hashing import between, prefix, rolling, word_hashes
from quire.llm.minhash_dedup import EMPTY, REGISTERS, UPPER, _by_size, _first_pairs, _next_pairs, estimate, minhash_dedup, registers
from quire.llm.substring_dedup import COVERS, period_for, substring_dedup
from quire.llm.suffix_dedup import earlier, suffix_dedup

SCHEMA = "doc_id long, text string, kept string, spans int, node int"


def awkward(spark, texts):
    """A table with columns named like those the operators make, a null id, null and empty texts."""
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(texts)] + [(None, texts[0], "x", 1, 2), (900, None, None, None, None), (901, "", "x", 1, 2), (902, " \t\n", "x", 1, 2)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3), [(i, t or "") for i, t, *_ in rows]


def corpus(seed, n=14):
    rnd = random.Random(seed)
    words = [f"w{i}é" if i % 5 == 0 else f"w{i}" for i in range(60)]
    shared = [" ".join(rnd.choices(words, k=45)) for _ in range(3)]
    texts = []
    for i in range(n):
        own = [" ".join(rnd.choices(words, k=rnd.randint(0, 60))) for _ in range(3)]
        own.insert(rnd.randint(0, 3), rnd.choice(shared))
        texts.append("  ".join(own))
    return [*texts, texts[0], texts[1] + " end", "a " * 120, "one", "word" * 3000, " ".join(rnd.choices(words, k=3000)) + shared[0]]


def test_covers_reach_every_difference():
    for period, members in COVERS.items():
        assert {(a - b) % period for a in members for b in members} == set(range(period))
    assert period_for(35) == 21 and period_for(2) == 0


def test_hashes_depend_on_content_alone():
    data = np.array([3, 1, 2, 3, 1, 2, 9], dtype=np.uint64)
    own = rolling(prefix(data), 3)
    assert own[0] == own[3] and len(set(own.tolist())) == 4
    assert between(prefix(data), np.array([1]), np.array([4]))[0] == own[1]
    assert (word_hashes(b"aa b aa")[[0, 2]] == word_hashes(b"aa")).all()
    long = b" ".join(str(i).encode() for i in range(200_000))
    assert len(np.unique(word_hashes(long))) == 200_000


def removed_words(rows, width):
    count = collections.Counter()
    split = [t.encode().split() for _, t in rows]
    for words in split:
        count.update(tuple(words[i:i + width]) for i in range(len(words) - width + 1))
    for (key, _), words in zip(rows, split, strict=True):
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            if count[tuple(words[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        yield key, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()


@pytest.mark.parametrize("width", [5, 35])
def test_substrings(spark, width):
    docs, rows = awkward(spark, corpus(width))
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup(docs, width).collect()]
    assert sorted(got, key=str) == sorted(removed_words(rows, width), key=str)
    spans = {r.doc_id: r.spans for r in substring_dedup(docs.where("doc_id = 0"), width).collect()}
    assert all(s.length >= width for s in spans[0])


def removed_bytes(rows, length):
    low = -(1 << 63)
    first = {}
    for key, text in rows:
        raw = text.encode()
        for i in range(len(raw) - length + 1):
            s = raw[i:i + length]
            first[s] = min(first.get(s, low if key is None else key), low if key is None else key)
    for key, text in rows:
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first[raw[i:i + length]] < (low if key is None else key):
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(raw)) if gone[i] and not (i and gone[i - 1]))
        yield key, len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone, strict=True) if not g)


@pytest.mark.parametrize("length", [13, 50])
def test_suffixes(spark, length):
    docs, rows = awkward(spark, corpus(length))
    docs = docs.unionByName(docs.where("doc_id = 2"))
    rows += [x for x in rows if x[0] == 2]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup(docs, length).collect()]
    assert sorted(got, key=str) == sorted(removed_bytes(rows, length), key=str)


def test_suffixes_scan_each_block_once_a_pass(spark, monkeypatch, tmp_path):
    """Each of the three passes hashes a block's bytes once."""
    from quire.llm import suffix_dedup as module

    plain, log = module.prefix, str(tmp_path / "scans")

    def counted(values):
        with open(log, "a") as out:
            out.write("scan\n")
        return plain(values)

    monkeypatch.setattr(module, "prefix", counted)
    same = "the same passage of well over fifty bytes stands in both of these"
    docs = spark.createDataFrame([(1, same), (2, f"x {same} y"), (3, "short")], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_removed, bytes(r.kept)) for r in suffix_dedup(docs).collect()}
    assert got == {1: (0, same.encode()), 2: (len(same), b"x  y"), 3: (0, b"short")}
    with open(log) as lines:
        assert len(list(lines)) == 3


def test_earlier_takes_the_smaller_id():
    def message(pieces, ids):
        return np.array([len(p) for p in pieces]), np.array(ids), b"".join(pieces)

    a, b = earlier([message([b"abcdef", b"zzzz"], [5, 1]), message([b"xbcdey"], [3])], 4)
    assert list(np.unpackbits(np.frombuffer(a, np.uint8), count=4)) == [0, 1, 0, 0]
    assert list(np.unpackbits(np.frombuffer(b, np.uint8), count=3)) == [0, 0, 0]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert substring_dedup(docs).count() == 0
    assert suffix_dedup(docs).count() == 0
    assert minhash_dedup(docs).count() == 0


def test_blocks_keep_long_documents_whole(spark):
    docs, _ = awkward(spark, ["x" * 5000, "y", "z" * 10])
    packed = B.pack(docs, block_bytes=64).collect()
    found = [x for r in packed for x in zip(*B.unpack(r.payload), strict=True)]
    assert len(found) == 7 and (0, b"x" * 5000) in found and len({r.block for r in packed}) == len(packed) > 2


def similar_sets(rows, width, percent):
    sets = []
    for _, text in rows:
        w = text.encode().translate(UPPER).split()
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    keys = [k for k, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if keys[i] is None or keys[j] is None:
                continue
            if keys[i] == keys[j] or sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, k in enumerate(keys):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    for i, (k, s) in enumerate(zip(keys, sets, strict=True)):
        yield k, len(s), None if k is None else least[find(i)], k is None or least[find(i)] == k


def test_near_duplicates(spark):
    rnd = random.Random(5)
    words = [f"Word{i}" for i in range(400)]
    texts = []
    for size in (3, 8, 30, 120, 400):
        base = rnd.choices(words, k=size)
        for _ in range(6):
            own = list(base)
            for _ in range(rnd.randint(0, max(1, size // 25))):
                own[rnd.randrange(size)] = rnd.choice(words)
            texts.append(" ".join(own))
    # a chain in which each is similar to the next only, in one large band, and two far ends
    base = rnd.choices(words, k=200)
    for i in range(40):
        base[i * 3] = rnd.choice(words)
        texts.append(" ".join(base))
    docs, rows = awkward(spark, [*texts, texts[3].lower(), texts[3]])
    docs = docs.unionByName(docs.where("doc_id = 4").withColumn("text", docs["text"].substr(1, 20)))
    rows += [(k, t[:20]) for k, t in rows if k == 4]
    for width in (4, 5):
        got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup(docs, width).collect()]
        assert sorted(got, key=str) == sorted(similar_sets(rows, width, 80), key=str)


def test_registers_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    for share in (0.2, 0.5, 0.8, 1.0):
        common = int(2000 * share)
        a = np.concatenate([pool[:common], pool[2000:2000 + (2000 - common) // 2]])
        b = np.concatenate([pool[:common], pool[2500:2500 + (2000 - common) // 2]])
        got = np.mean([estimate(registers(np.unique(a ^ np.uint64(k)))[None], registers(np.unique(b ^ np.uint64(k)))[None])[0] for k in range(1, 30)])
        assert abs(got - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.03
    assert (registers(np.zeros(0, np.uint64)) == EMPTY).all() and len(registers(pool)) == REGISTERS


def test_classes_of_size(spark):
    rows = [(1, i, n) for i, n in enumerate([10, 11, 12, 13, 20, 25, 26, 1000, 1])]
    found = {}
    for r in _by_size(spark.createDataFrame(rows, "band long, node long, n long"), 80).collect():
        found.setdefault(r.size, []).append(r.n)
    assert all(100 * min(x) >= 79 * max(x) for x in found.values())
    assert sum(map(len, found.values())) == 2 * len(rows)
    assert any({10, 11} <= set(x) for x in found.values()) and any({25, 26} <= set(x) for x in found.values())


def test_a_large_group_makes_few_pairs(spark):
    """A group of n near copies gives at most 2 n pairs, then none once it is one component."""
    n = 500
    rows = [(band, node, 100 + node % 60, n) for band in range(40) for node in range(n) if (node + band) % 7]
    large = spark.createDataFrame(rows, "band long, node long, n long, members long")
    pairs = _first_pairs(large, 80)
    assert 0 < pairs.count() <= 2 * n and pairs.where("a >= b").count() == 0
    one = spark.createDataFrame([(i, 0) for i in range(n)], "node long, root long")
    assert _next_pairs(large, one, 80).count() == 0
    apart = spark.createDataFrame([(i, 0 if i >= 10 else i) for i in range(n)], "node long, root long")
    left = _next_pairs(large, apart, 80)
    assert 9 <= left.count() <= 9 * 40 * 2 and left.where("a >= 10 AND b >= 10").count() == 0


def test_a_large_group_of_near_copies(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    base = rnd.choices(words, k=150)
    rows = []
    for i in range(300):
        own = list(base)
        for _ in range(rnd.randint(0, 4)):
            own[rnd.randrange(len(own))] = rnd.choice(words)
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(rnd.choices(words, k=150))) for i in range(100)]
    got = [tuple(r) for r in minhash_dedup(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()]
    assert sorted(got) == sorted(similar_sets(rows, 4, 80))


def test_digest_of_kept_words(spark):
    from pyspark.sql import functions as F

    docs, _ = awkward(spark, ["b  a\tc"])
    row = substring_dedup(docs).where("doc_id = 0").select(F.sha2("kept", 256)).first()
    assert row[0] == hashlib.sha256(b"b a c").hexdigest()
