"""Similar documents, lines, top-k search and components against brute force on small fixtures."""

import random

import numpy as np
import pyarrow as pa
import pytest
from plain_text import EDGES, closest, family, kept_lines
from pyspark.sql import functions as F

from filingloom.llm import jaccard, search
from filingloom.llm.common import Stage
from filingloom.llm.components import components
from filingloom.llm.jaccard import Threshold, one_of_each_group, similar_documents
from filingloom.llm.lines import dedup_lines
from filingloom.llm.search import top_k


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    out = ["", None, "  \n ", "one", "One", "one two", "two one", "a b c", "a  b\tc"]
    for words in (4, 9, 11, 14, 18, 22, 30, 60, 200):
        out += family(rng, 14, words, max(2, words // 12))
    passage = " ".join(f"p{i}" for i in range(60))
    out += [f"{passage} {' '.join(f'q{rng.randrange(3000)}' for _ in range(40))}" for _ in range(12)]
    rng.shuffle(out)
    return [(i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize(("k", "num", "den", "block", "region"), [(3, 90, 100, 512, None), (2, 70, 100, 3, 0.9), (1, 80, 100, 5, 0.05)])
def test_components_against_all_pairs(spark, texts, monkeypatch, k, num, den, block, region):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_documents(docs, k, num, den, region=region).collect()}
    assert got == closest(texts, k, num, den)
    assert len({c for _, c in got.values()}) < len(got)


def test_given_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_documents(docs, 3, 90, 100).collect()}
    assert got == closest(rows, 3, 90, 100)


@pytest.mark.parametrize("boundary", [1, 14])
def test_any_boundary_gives_the_same(spark, texts, monkeypatch, boundary):
    monkeypatch.setattr(jaccard, "choose_boundary", lambda *a: boundary)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_documents(docs, 3, 90, 100).collect()}
    assert got == closest(texts, 3, 90, 100)


def test_overlap_bound_is_exact():
    for num, den in ((90, 100), (80, 100), (2, 3)):
        near = Threshold(num, den)
        for a in range(1, 40):
            for b in range(1, 40):
                for common in range(min(a, b) + 1):
                    linked = den * common >= num * (a + b - common)
                    assert linked == (common >= near.overlap(a, b))
                    assert not linked or (near.least_partner(a) <= b <= near.most_partner(a) and a + b - 2 * common <= near.distance(a + b))


def cell_of(maps, sizes, labels, opened):
    n = len(maps)
    rows = [(1, 0, 0, asks, opened[i], i, sizes[i], maps[i], labels[i]) for asks in (False, True) for i in range(n) if opened[i] or not asks]
    names = ["token", "left", "right", "asks", "open", "node", "n", "bits", "label"]
    return pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))


def test_bit_maps_fold_and_never_exceed_the_distance():
    rng = np.random.default_rng(5)
    for n in (1, 3, 2047, 2049, 5000, 17_000):
        tokens = rng.integers(0, 2**64, n, dtype=np.uint64)
        whole = jaccard._matrix([jaccard._bitmap(tokens)])
        assert whole.shape[1] * 64 >= max(1024, n / 2)
        assert (jaccard._folded(whole, 16) == jaccard._folded(jaccard._folded(whole, max(16, whole.shape[1] // 2)), 16)).all()
        other = np.concatenate([tokens[n // 10 :], rng.integers(0, 2**64, n // 7, dtype=np.uint64)])
        b = jaccard._matrix([jaccard._bitmap(other)])
        words = min(whole.shape[1], b.shape[1])
        assert np.bitwise_count(jaccard._folded(whole, words) ^ jaccard._folded(b, words)).sum() <= n // 10 + n // 7


@pytest.mark.parametrize(("num", "n"), [(90, 6000), (80, 6000), (90, 100_000)])
def test_unlike_long_sets_of_a_list_give_no_pair(num, n):
    rng = np.random.default_rng(6)
    count = 200 if n < 10_000 else 20
    sizes = [n + int(x) for x in rng.integers(0, 300, count)]
    maps = [jaccard._bitmap(rng.integers(0, 2**64, x, dtype=np.uint64)) for x in sizes]
    batch = cell_of(maps, sizes, list(range(count)), [i > 0 for i in range(count)])
    assert list(jaccard._near_pairs(Threshold(num, 100), True)([batch])) == []
    pairs = pa.RecordBatch.from_pydict({"a": [0] * (count - 1), "b": list(range(1, count)), "n": [sizes[0]] * (count - 1), "m": sizes[1:], "s": [maps[0]] * (count - 1), "t": maps[1:]})
    assert sum(b.num_rows for b in jaccard._likely(Threshold(num, 100))([pairs])) == 0


def test_a_cell_gives_each_pair_once_and_a_forest_of_labels():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**64, 2060, dtype=np.uint64)
    sets = [np.concatenate([base[i * 3 :], rng.integers(0, 2**64, i, dtype=np.uint64)]) for i in range(12)]  # maps of two widths
    maps, sizes = [jaccard._bitmap(x) for x in sets], [len(x) for x in sets]
    assert len({len(m) for m in maps}) == 2
    labels = [0, 0, 0, *range(3, 12)]
    batch = cell_of(maps, sizes, labels, [x > 0 for x in labels])
    near = Threshold(90, 100)
    every = [(a, b) for out in jaccard._near_pairs(near, True)([batch]) for a, b in zip(out.column("a").to_pylist(), out.column("b").to_pylist(), strict=True)]
    wanted = {(a, b) for a in range(12) for b in range(a + 1, 12) if labels[a] != labels[b]}
    assert len(every) == len(set(every)) and set(every) == wanted
    forest = [(a, b) for out in jaccard._near_pairs(near, False)([batch.slice(0, 5), batch.slice(5)]) for a, b in zip(out.column("a").to_pylist(), out.column("b").to_pylist(), strict=True)]
    assert len(forest) == 9 and set(forest) <= wanted


def test_many_near_copies_cost_a_few_pairs_each(spark, monkeypatch):
    """A family of 3,000 different texts and a chain of drifting ones; few pairs reach the blocks."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(120)]
    out = []
    for i in range(3000):
        own = list(base)
        own[rng.randrange(120)] = f"x{i}"
        out.append(" ".join(own))
    for i in range(40):
        base = list(base)
        base[3 * i] = f"y{i}"
        out.append(" ".join(base))
    seen = []
    write = Stage.write

    def counting(self, df, name):
        staged = write(self, df, name)
        if name in ("likely", "pairs", "again"):
            seen.append((name, staged.count()))
        return staged

    monkeypatch.setattr(Stage, "write", counting)
    docs = spark.createDataFrame(list(enumerate(out)), "doc_id long, text string").repartition(8)
    got = [r.component_id for r in similar_documents(docs, 1, 90, 100).select("component_id").collect()]
    assert got == [0] * len(out)
    assert sum(n for _, n in seen) < 40 * len(out), seen


def test_one_of_each_group_edges(spark):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string, node string")
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    rows = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert rows == sorted([(3, "a b c d e f"), (None, "a b c d e f"), (8, None), (9, "")], key=str)
    assert one_of_each_group(docs.limit(0)).count() == 0
    assert similar_documents(docs.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    path = list(range(0, 600))
    links = [(path[i], path[i + 1]) for i in range(299)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000)]
    rng.shuffle(links)
    links = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in links]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long").repartition(7), Stage(spark)).collect())
    assert {x: got.get(x, x) for x in range(300)} == dict.fromkeys(range(300), 0)
    assert all(got[i] == 1000 for i in range(1001, 1200))


def plain_components(links):
    least = {x: x for link in links for x in link}
    while any(least[a] != least[b] for a, b in links):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return least


@pytest.mark.parametrize("links_a_task", [100_000, 40])
def test_components_in_one_task_or_in_rounds(spark, monkeypatch, links_a_task):
    """Links that fit one task need no rounds of shuffles; more take the rounds. Both give the same."""
    from filingloom.llm import components as module

    rng = random.Random(9)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (900, 3), (3, 900)]
    written = []
    write = Stage.write
    monkeypatch.setattr(Stage, "write", lambda self, df, name: written.append(name) or write(self, df, name))
    monkeypatch.setattr(module, "LINKS", links_a_task)
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long").repartition(6), Stage(spark)).collect())
    assert got == {x: least for x, least in plain_components(links).items() if x != least}
    assert (len(written) == 2) == (links_a_task > len(links)), written
    assert components(spark.createDataFrame([], "a long, b long"), Stage(spark)).count() == 0


def test_a_forest_holds_a_bounded_number_of_links(monkeypatch):
    from filingloom.llm import components as module

    monkeypatch.setattr(module, "LINKS", 50)
    rng = random.Random(10)
    links = [(rng.randrange(90), rng.randrange(90)) for _ in range(170)]
    batches = [pa.RecordBatch.from_pydict(dict(zip("ab", map(list, zip(*part, strict=True)), strict=True))) for part in (links[:20], links[20:150], links[150:])]
    out = [list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)) for b in module._forest(iter(batches))]
    assert len(out) == 4 and all(u > v for part in out for u, v in part)
    forest = [link for part in out for link in part]
    least = plain_components(links)
    assert {x: y for x, y in plain_components(forest).items() if x != y} == {x: y for x, y in least.items() if x != y}
    assert list(module._forest(iter([]))) == []


@pytest.mark.parametrize(("slices", "twice_bits"), [(None, 1 << 20), (1, 64), (16, 1 << 12)])
def test_lines_against_plain_python(spark, slices, twice_bits):
    rng = random.Random(8)
    pool = [f"This is line number {i} " for i in range(30)] + ["short", "", "ÄÖÜ äöü ßßß", "  THIS is LINE number 3", "İİİİİİİİİİ", "éééééééééé"]
    rows = [(i, None if i == 5 else "\n".join(rng.choice(pool) for _ in range(rng.randrange(9)))) for i in range(60)]
    rows += [(4, rows[4][1]), (61, "only here, a line of its own\nonly here, a line of its own")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_lines string").repartition(4)
    out, lines, dropped = dedup_lines(docs, slices=slices, twice_bits=twice_bits)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append((r.text or "", r[lines], r[dropped]))
    assert {i: sorted(v) for i, v in got.items()} == kept_lines(rows, 10)
    assert sum(r[2] for v in got.values() for r in v) > 20
    assert dedup_lines(docs.limit(0))[0].count() == 0


def test_lines_of_rows_without_an_id_come_last(spark):
    docs = spark.createDataFrame([(None, "a line of some length"), (4, "A line of some length "), (None, None)], "doc_id long, text string")
    rows = sorted((str(r.doc_id), r.text, r.n_dropped) for r in dedup_lines(docs)[0].collect() if r.text is not None)
    assert rows == [("4", "A line of some length ", 0), ("None", "", 1)]


@pytest.mark.parametrize(("n_queries", "spread", "tile_bytes"), [(40_000, 200, 16 << 20), (40_000, 2, 1 << 20), (3, 1, 64), (1, 5, 1)])
def test_lists_of_a_block(monkeypatch, n_queries, spread, tile_bytes):
    """Ties, repeated rows, ids with several vectors and the queries themselves, in tiles of a fixed number of bytes."""
    monkeypatch.setattr(search, "TILE_BYTES", tile_bytes)
    rng = np.random.default_rng(5)
    matrix = rng.integers(-spread, spread + 1, (n_queries, 6))
    ids = np.concatenate([np.arange(0, 240), np.full(30, 7), rng.integers(0, 240, 30)])
    rows = rng.integers(-spread, spread + 1, (300, 6))
    rows[150:200] = rows[150]  # copies
    query_ids = np.arange(n_queries) % 500
    lists = search._Lists(query_ids, matrix, 10)
    assert lists.tile * n_queries * 8 <= tile_bytes or lists.tile == 1
    order = rng.permutation(300)
    for cut in range(0, 300, lists.tile):
        own = order[cut : cut + lists.tile]
        lists.add(ids[own], rows[own])
    known = np.unique(ids)
    scores = np.stack([(matrix @ rows[ids == i].T).max(axis=1) for i in known], axis=1)
    scores[query_ids[:, None] == known[None, :]] = -(10**9)
    best = np.argsort(-scores, axis=1, kind="stable")[:, :10]
    assert (lists.row == np.repeat(np.arange(n_queries), 10)).all()
    assert (lists.ids == known[best].ravel()).all()
    assert (lists.scores == np.take_along_axis(scores, best, axis=1).ravel()).all()


def test_top_k_of_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(300)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    whole = {(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(docs, F.col("vec_id") % 3 == 0, k=4).collect()}
    monkeypatch.setattr(search, "QUERY_BYTES", 1200)
    monkeypatch.setattr(search, "TILE_BYTES", 4000)
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(docs, F.col("vec_id") % 3 == 0, k=4).collect()} == whole
    assert len(whole) == 400


def test_top_k_against_plain_python(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).astype("float32").tolist()) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(400, 440)]  # ties
    rows += [(441, None), (442, [1.0, None, 0.0, 0.0]), (443, [float("nan")] * 4), (444, [float("inf")] * 4), (500, []), (501, []), (600, [1.0]), (7, rows[7][1]), (None, rows[0][1]), (700, [3e30] * 4), (701, [3e30] * 4)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = {}
    for r in sorted(top_k(docs, F.col("vec_id") % 100 == 0, k=10).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = {i: [int(np.floor(1024 * float(x))) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and i < 700}
    for q in [i for i in whole if i % 100 == 0]:
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        mine = [(i, s) for _, i, s in got.get(q, []) if i < 700]
        expected = [(i, -s) for s, i in scores]
        assert mine == expected[: len(mine)]
        assert len(got.get(q, [])) == min(10, len(scores) + 2 * (len(whole[q]) == 4))
    assert top_k(docs.limit(0), F.lit(True)).count() == 0
