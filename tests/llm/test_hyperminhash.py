"""HyperMinHash: sketches by themselves, and the components against a comparison of all pairs."""

import random

import numpy as np
import pytest
from plain_text import EDGES, closest, family

from filingloom.llm import hyperminhash as module
from filingloom.llm.hyperminhash import BANDS, BUCKETS, MANTISSA, REGISTERS, chance, estimate, near_copies, op11_hyperminhash_dedup, registers


def hashes(rng, n):
    return rng.integers(0, 2**64, n, dtype=np.uint64)


def plain_registers(tokens):
    out = []
    for m in module._MULTIPLIERS.tolist():
        least = [None] * BUCKETS
        for t in tokens.tolist():
            h = t * m % 2**64
            b, rest = h >> 62, h % 2**62
            least[b] = rest if least[b] is None else min(least[b], rest)
        for v in least:
            if v is None:
                out.append(0)
            else:
                zeros = 62 - v.bit_length()
                mantissa = (v - (1 << v.bit_length() - 1)) * (1 << MANTISSA) >> v.bit_length() - 1 if v else 0
                out.append(1 + (zeros << MANTISSA) + mantissa)
    return out


def test_registers():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 40, 300):
        tokens = hashes(rng, n)
        got, plain = registers(tokens).tolist(), plain_registers(tokens)
        assert sum(a != b for a, b in zip(got, plain, strict=True)) <= 1  # floats may round up to the next power of two
    assert registers(np.zeros(0, np.uint64)).tolist() == [0] * REGISTERS
    tokens = hashes(rng, 200_000)
    assert (registers(tokens) == np.concatenate([registers(tokens)])).all()
    half = [registers(x) for x in (tokens[:100_000], tokens[100_000:])]
    assert ((registers(tokens) == half[0]) | (registers(tokens) == half[1])).all()


def test_agreements_by_chance():
    """Disjoint sets agree as often as the correction says, however unlike their sizes."""
    rng = np.random.default_rng(2)
    for n, m in ((2_000, 2_000), (50, 60), (4_000, 100)):
        left = np.array([registers(hashes(rng, n)) for _ in range(300)])
        right = np.array([registers(hashes(rng, m)) for _ in range(300)])
        share = ((left == right) & (left != 0)).mean()
        expected = float(chance(np.array(n), np.array(m)))
        assert abs(share - expected) < 5 * np.sqrt(expected / left.size) + 1e-4


def test_estimate():
    rng = np.random.default_rng(3)
    for n, common in ((300, 200), (40, 30), (9, 8), (3_000, 1_500)):
        guesses = []
        for _ in range(60):
            shared, a, b = hashes(rng, common), hashes(rng, n - common), hashes(rng, n - common)
            value, margin = estimate(registers(np.concatenate([shared, a]))[None], registers(np.concatenate([shared, b]))[None], np.array([n]), np.array([n]))
            true = common / (2 * n - common)
            assert abs(value[0] - true) <= margin[0]
            guesses.append(value[0])
        assert abs(np.mean(guesses) - true) < 0.05


def test_a_band_is_shared_at_the_threshold():
    """Sets of similarity 0.8, down to four and five members: 3,000 pairs, none without a shared band."""
    rng = np.random.default_rng(4)
    for n, common in ((5, 4), (9, 8), (18, 16), (90, 80), (450, 400)):
        fewest = BANDS
        for _ in range(600):
            shared, more = hashes(rng, common), hashes(rng, n - common)
            same = (registers(shared) == registers(np.concatenate([shared, more]))).reshape(BANDS, BUCKETS).all(axis=1).sum()
            fewest = min(fewest, same)
        assert fewest > 0


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(14)
    out = ["", None, "  \n ", "one", "One", "one two", "two one", "a b c", "a  b\tc"]
    for words in (4, 9, 14, 30, 60, 200):
        out += family(rng, 14, words, max(2, words // 10))
    passage = " ".join(f"p{i}" for i in range(60))
    out += [f"{passage} {' '.join(f'q{rng.randrange(3000)}' for _ in range(40))}" for _ in range(12)]
    chain = [f"c{i}" for i in range(120)]
    for i in range(40):  # each like the one before, the ends unlike each other
        out.append(" ".join(chain))
        chain[3 * i] = f"d{i}"
    rng.shuffle(out)
    return [(i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize(("k", "num", "cell"), [(2, 80, None), (2, 80, 3), (1, 90, 5)])
def test_components_against_all_pairs(spark, texts, k, num, cell):
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_copies(docs, k, num, 100, cell=cell).collect()}
    assert got == closest(texts, k, num, 100)
    assert len({c for _, c in got.values()}) < len(got)


def test_groups_with_several_components(spark):
    """Texts that share a passage meet in groups whose head is like none of them, though some have a copy."""
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(90))
    rows = [f"{passage} {' '.join(f'q{rng.randrange(10**6)}' for _ in range(22 + rng.randrange(3)))}" for _ in range(150)]
    rows += [rows[i] + " end" for i in range(0, 150, 2)]
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_copies(docs, 2, 80, 100, cell=40).collect()}
    assert got == closest(rows, 2, 80, 100)


def test_a_large_group_of_near_copies(spark):
    """A group of 3,000 yields links in proportion to its members."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(3_000):
        own = list(base)
        own[rng.randrange(60)] = f"x{rng.randrange(400)}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.component_id for r in near_copies(docs, 2, 80, 100).collect()} == {0}


def test_edges(spark):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string, node string").selectExpr("*", "1 AS n", "'x' AS Label")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_copies(docs).collect()), key=str)
    assert got == sorted([(3, 2, 3), (3, 2, 3), (None, 2, None), (7, 2, 3), (8, 0, 8), (9, 0, 9), (9, 2, 9), (10, 2, 9)], key=str)
    assert near_copies(docs.limit(0)).count() == 0
    long = " ".join(f"word{i}" for i in range(150_000))
    pair = spark.createDataFrame([(5, long), (2, long + " more"), (1, "other words")], "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_copies(pair, 2).collect()} == {5: (149_999, 2), 2: (150_000, 2), 1: (1, 1)}


def test_given_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in op11_hyperminhash_dedup(spark, sf_dir).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in closest(rows, 2, 80, 100).items()}
