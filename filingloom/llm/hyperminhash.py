"""Near copies by HyperMinHash: compressed registers, banded, estimated with a correction for collisions, then verified.

A sketch has bands of four buckets. Each band deals a set's hashes, times a multiplier of its own, to its buckets by their
first two bits; a bucket's register holds the least of them as the number of its leading zeros and ten bits of mantissa, in 16 bits.
Two sets share a band if its four registers agree. At a similarity of 0.8 none of 40 bands agrees in fewer than one of
10**9 pairs, for sets of any size, as small sets have small sketches of their own in each band.

The sets that share a band are compared with the smallest id among them. By the sketches' estimate, less a margin that one pair in
10**9 exceeds, a pair is left out or verified on the full sets. Only the groups that these links leave in several
components are looked at again: their members outside the main component, first against some of its members, and what is
still outside against all members, in blocks, by the estimates of pairs of different components, verified where they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingloom.llm.common import Stage, documents
from filingloom.llm.components import components
from filingloom.llm.jaccard import Threshold, shingles
from filingloom.llm.near_sql import near_copies_sql

BANDS, BUCKETS = 40, 4
REGISTERS = BANDS * BUCKETS
MANTISSA = 10  # bits
_BAND_BYTES = 2 * BUCKETS
SCOUTS = 8  # members of a group's main component that the others are compared with before all
CELL = 512  # members of a block of a group; a task compares two blocks at a time
MISS = 1e-9  # share of similar pairs that an estimate may leave out
FILTER_BITS = 1 << 27  # of the filter of wanted sets, at most (16 MB); beyond 8 million wanted sets more texts are read again
_PAGE = 1 << 16  # bytes
_SLICE = 1 << 16  # hashes sketched at a time
_MULTIPLIERS = np.array([int.from_bytes(hashlib.blake2b(b"band %d" % i, digest_size=8).digest()) | 1 for i in range(BANDS)], np.uint64)


def registers(tokens: np.ndarray) -> np.ndarray:
    """The sketch of a set of 64-bit hashes: per band and bucket 0 if empty, else 1 + (leading zeros, mantissa)."""
    room = 64 - BUCKETS.bit_length() + 1  # bits of a hash behind the bucket's number
    least = np.full((BANDS, BUCKETS), 2**64 - 1, np.uint64)
    for cut in range(0, len(tokens), _SLICE):
        own = tokens[None, cut : cut + _SLICE] * _MULTIPLIERS[:, None]
        for b in range(BUCKETS):  # what lies before a bucket wraps round, so that the bucket's own come first
            least[:, b] = np.minimum(least[:, b], (own - np.uint64(b << room)).min(axis=1))
    fraction, exponent = np.frexp(least.astype(float))
    zeros = np.clip(room - exponent, 0, room)
    mantissa = np.minimum(((2 * fraction - 1) * (1 << MANTISSA)).astype(np.int64), (1 << MANTISSA) - 1)
    value = 1 + (zeros << MANTISSA) + np.where(least == 0, 0, mantissa)
    value = np.where(least == 0, 1 + (room << MANTISSA), value)
    return np.where(least >> np.uint64(room), 0, value).astype("<u2").ravel()


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How likely a register of two sets without a common member agrees all the same, by their sizes."""
    a, b = np.asarray(n, float)[..., None] / BUCKETS, np.asarray(m, float)[..., None] / BUCKETS
    top = 0.5 ** np.arange(62 - MANTISSA)
    inside = np.exp(-(a + b) * top / 2) - np.exp(-(a + b) * top)
    return (a * b / (a + b) * inside * top / 2 / (1 << MANTISSA)).sum(axis=-1)


def estimate(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of sketches, row by row, without the agreements by chance; and its margin."""
    used = ((left != 0) | (right != 0)).sum(axis=-1)
    agree = ((left == right) & (left != 0)).sum(axis=-1) / np.maximum(used, 1)
    by_chance = chance(n, m)
    return (agree - by_chance) / (1 - by_chance), np.sqrt(np.log(1 / MISS) / (2 * np.maximum(used, 1)))


def _sketches(k: int) -> Callable:
    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cls, regs = [], [], []
            for text in batch.column(1):
                s = shingles(text.as_py(), k)
                n.append(len(s))
                cls.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                regs.append(registers(s).tobytes() if len(s) else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(regs, pa.binary())], names=["doc_id", "n", "cls", "regs"])

    return sketches


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, REGISTERS)


def _likely(near: Threshold) -> Callable:
    """Rows a, b, n, m, regs and other of pairs: those that may be similar."""
    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            value, margin = estimate(_matrix(batch.column(4)), _matrix(batch.column(5)), batch.column(2).to_numpy(), batch.column(3).to_numpy())
            keep = pa.array(value + margin >= near.num / near.den)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return likely


def _root(up: dict, x: int) -> int:
    while up.get(x, x) != x:
        up[x] = up.get(up[x], up[x])
        x = up[x]
    return x


def _first_band(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The first band that a sketch shares with each of others."""
    same = (left == right).reshape(len(right), BANDS, BUCKETS).all(axis=2) & (right.reshape(len(right), BANDS, BUCKETS) != 0).any(axis=2)
    return same.argmax(axis=1)


def _cell_links(near: Threshold) -> Callable:
    """Links between askers of a group and its members, from rows sorted by cell (a block of members and one of askers).

    Columns: token, left, right, asks, open, band, node, n, regs, label, tokens. Pairs of different components that may be
    similar are verified on the full sets, the most similar first, unless the links found before connect them. A pair is
    looked at in its first band only, and if both are askers once.
    """
    def one(rows: pa.Table) -> list[tuple[int, int]]:
        rows = rows.combine_chunks()
        asks = rows.column("asks").to_numpy()
        if asks.all() or not asks.any():
            return []
        node, n, label, is_open = (rows.column(c).to_numpy() for c in ("node", "n", "label", "open"))
        band, regs, sets = rows.column("band")[0].as_py(), _matrix(rows.column("regs")), rows.column("tokens")
        members = np.flatnonzero(~asks)
        members = members[np.lexsort((node[members], n[members]))]
        sizes, own_regs = n[members], regs[members]
        a, b, value = [], [], []
        for i in np.flatnonzero(asks).tolist():
            some = slice(np.searchsorted(sizes, near.least_partner(int(n[i]))), np.searchsorted(sizes, near.most_partner(int(n[i])), side="right"))
            at = members[some]
            ok = (label[at] != label[i]) & (~is_open[at] | (node[i] < node[at]))
            at, there = at[ok], own_regs[some][ok]
            if len(at):
                first = _first_band(regs[i][None], there) == band
                at, there = at[first], there[first]
            if len(at):
                guess, margin = estimate(regs[i][None], there, np.full(len(at), n[i]), n[at])
                good = guess + margin >= near.num / near.den
                a += [i] * int(good.sum())
                b += at[good].tolist()
                value += guess[good].tolist()
        up: dict[int, int] = {}
        links = []
        for k in np.lexsort((node[b], node[a], -np.array(value))).tolist() if a else []:
            i, j = a[k], b[k]
            x, y = _root(up, int(label[i])), _root(up, int(label[j]))
            if x == y:
                continue
            left, right = sets[i].values.to_numpy(), sets[j].values.to_numpy()
            common = len(np.intersect1d(left, right, assume_unique=True))
            if near.den * common >= near.num * (len(left) + len(right) - common):
                up[max(x, y)] = min(x, y)
                links.append((int(node[i]), int(node[j])))
        return links

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def cells(table: pa.Table, last: bool) -> tuple[list, pa.Table | None]:
            token, left, right = (table.column(c).to_numpy() for c in ("token", "left", "right"))
            ends = (np.flatnonzero((np.diff(token) != 0) | (np.diff(left) != 0) | (np.diff(right) != 0)) + 1).tolist()
            ends += [len(token)] if last else []
            out, start = [], 0
            for end in ends:
                if end - start > 1:
                    out += one(table.slice(start, end - start))
                start = end
            return out, None if start == len(token) else table.slice(start)

        def batch_of(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            out, held = cells(held, False)
            if out:
                yield batch_of(out)
        if held is not None:
            out, _ = cells(held, True)
            if out:
                yield batch_of(out)

    return links


@contextmanager
def _small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Rows that hold whole sets go to Python a few at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _filter_of(ids: DataFrame) -> np.ndarray:
    """A bit for each id in column node, by its hash; 16 bits an id, up to FILTER_BITS. Each page is put together in one task."""
    size = ids.count()
    bits = min(FILTER_BITS, max(8 * _PAGE, 1 << (16 * max(1, size) - 1).bit_length()))

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            page, place = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for p in np.unique(page):
                own = held.setdefault(int(p), np.zeros(_PAGE * 8, bool))
                own[place[page == p]] = True
            for p in [p for p in held if len(held) > 64]:
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([np.packbits(held.pop(p)).tobytes()])], names=["page", "bits"])
        for p, own in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([np.packbits(own).tobytes()])], names=["page", "bits"])

    at = F.pmod(F.xxhash64("node"), F.lit(bits))
    dealt = ids.select(at.alias("at")).select(F.expr(f"at div {8 * _PAGE}").alias("page"), F.expr(f"at % {8 * _PAGE}").alias("place"))
    out = np.zeros(bits // 8, np.uint8)
    for r in dealt.repartition("page").sortWithinPartitions("page").mapInArrow(pages, "page bigint, bits binary").collect():
        own = out[r.page * _PAGE : (r.page + 1) * _PAGE]
        own |= np.frombuffer(r.bits, np.uint8)
    return out


def near_copies(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", cell: int | None = None) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, node (the smallest id with the same set) and component_id (the smallest reachable).

    Words are separated by ASCII white space, A-Z in lower case; a set holds the hashes of a text's distinct shingles of k
    words, of the whole text if it has fewer. Sets with `den * intersection >= num * union` are linked; a null or empty text
    has an empty set and is linked with nothing, not even its like. Every link is confirmed on the full sets; a link is missed
    if a pair shares no band or is underrated, each less than once in 10**9 for num / den of 0.8 or more (lower thresholds
    miss more). Very long texts are taken whole. Rows with one id are one document, whose texts may link it to others in
    turn; a row with a null id has no node or component; an empty table gives an empty one; other columns take no part.

    One node stands for all rows of one set. The members of a group are compared with its smallest node, those outside its main
    component then with a few of that, and only those still outside with all, in cells of two blocks of `cell` members,
    which yield a spanning forest. So a group costs its size times the blocks of members that are like few others.
    """
    spark, near = docs.sparkSession, Threshold(num, den)
    stage = Stage(spark)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sets = stage.write(texts.mapInArrow(_sketches(k), "doc_id bigint, n bigint, cls binary, regs binary"), "hyper-sets")
    some = sets.filter("n > 0 AND doc_id IS NOT NULL")
    nodes = stage.write(some.groupBy("cls").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("regs").alias("regs")), "hyper-nodes")
    rows = sets.select("doc_id", "n", "cls").join(nodes.select("cls", "node"), "cls", "left")
    rows = stage.write(rows.select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("node")).alias("node")), "hyper-rows")
    same_id = rows.filter("node IS NOT NULL AND node <> doc_id").select(F.col("node").alias("a"), F.col("doc_id").alias("b")).join(  # an id whose texts differ links their sets
        nodes.select(F.col("node").alias("b")).distinct(), "b", "left_semi").select("a", "b")
    same_id = stage.write(same_id, "hyper-same-id")
    stage.release("hyper-sets")

    # groups: nodes that share a band. Their smallest node and size are partly computed before the shuffle
    at = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))
    band = nodes.select("node", at.alias("band"), "regs").select("node", "band", F.expr(f"substring(regs, band * {_BAND_BYTES} + 1, {_BAND_BYTES})").alias("key"))
    listed = band.select(F.xxhash64("band", "key").alias("token"), "band", "node")
    heads = stage.write(listed.groupBy("token").agg(F.min("node").alias("head"), F.count("*").alias("size")).filter("size > 1"), "hyper-heads")
    members = stage.write(listed.join(heads, "token"), "hyper-members")

    # full sets of the members, by their texts
    named = stage.write(members.select("node").distinct(), "hyper-named")
    flags = _filter_of(named)
    wanted = spark.sparkContext.broadcast(flags)  # at most 16 MB

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            place = batch.column(2).to_numpy()
            hit = np.flatnonzero((bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1)
            for cut in range(0, len(hit), 64):
                own = [shingles(batch.column(1)[int(i)].as_py(), k).view(np.int64) for i in hit[cut : cut + 64]]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(hit[cut : cut + 64])), pa.array(own, pa.list_(pa.int64()))], names=["node", "tokens"])

    place = F.pmod(F.xxhash64("doc_id"), F.lit(8 * len(flags)))
    full = texts.filter("doc_id IS NOT NULL").select("doc_id", "text", place.alias("place")).mapInArrow(whole, "node bigint, tokens array<bigint>")
    full = stage.write(full.filter(F.size("tokens") > 0).join(named, "node", "left_semi"), "hyper-full")

    left = nodes.select(F.col("node").alias("a"), "n", F.col("regs").alias("s"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("regs").alias("t"))
    left_set, right_set = full.select(F.col("node").alias("a"), F.col("tokens").alias("s")), full.select(F.col("node").alias("b"), F.col("tokens").alias("t"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links: first by size and estimate, then by the full sets."""
        fit = den * F.least("n", "m") >= num * F.greatest("n", "m")
        likely = pairs.distinct().join(left, "a").join(right, "b").filter(fit).select("a", "b", "n", "m", "s", "t").mapInArrow(_likely(near), "a bigint, b bigint")
        likely = stage.write(likely, "hyper-likely")
        common = likely.join(left_set, "a").join(right_set, "b").withColumn("common", F.size(F.array_intersect("s", "t")).cast("bigint"))
        return common.filter(den * F.col("common") >= num * (F.size("s") + F.size("t") - F.col("common"))).select("a", "b")

    def still_open(labels: DataFrame, name: str) -> DataFrame:
        """Members of groups of several components, with their label and main, the label of most of the group."""
        labelled = stage.write(members.filter("size > 2").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), f"{name}-labelled")
        parts = labelled.groupBy("token", "label").agg(F.count("*").alias("n")).groupBy("token").agg(F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("parts"))
        mixed = stage.write(parts.filter("parts > 1").select("token", F.col("most.label").alias("main")), f"{name}-mixed")
        return labelled.join(mixed, "token")

    # each member against the head of its groups
    links = stage.write(confirmed(members.filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"))).unionAll(same_id), "hyper-links")
    labels = stage.write(components(links, stage, "hyper-stars"), "hyper-labels")

    # in groups of several components, those outside the main one against some of its members
    mixed = still_open(labels, "hyper-first")
    scouts = mixed.filter("label = main").groupBy("token").agg(*[F.min_by("node", F.xxhash64("node", F.lit(i))).alias(f"s{i}") for i in range(SCOUTS)])
    asked = mixed.filter("label <> main").join(scouts, "token").select("node", F.explode(F.array_distinct(F.array(*[f"s{i}" for i in range(SCOUTS)]))).alias("scout"))
    more = stage.write(confirmed(asked.select(F.least("node", "scout").alias("a"), F.greatest("node", "scout").alias("b"))), "hyper-more")
    labels = stage.write(components(labels.toDF("a", "b").unionAll(more), stage, "hyper-stars"), "hyper-labels")

    # those that are still outside against all members, in blocks of both
    mixed = still_open(labels, "hyper-second").withColumn("open", F.col("label") != F.col("main"))
    counted = mixed.groupBy("token").agg(F.ceil(F.count("*") / (cell or CELL)).cast("int").alias("lefts"), F.ceil(F.sum(F.col("open").cast("int")) / (cell or CELL)).cast("int").alias("rights"))
    dealt = mixed.join(stage.write(counted, "hyper-counted"), "token").withColumn("h", F.xxhash64("node", F.lit(7)))
    every = lambda many: F.explode(F.sequence(F.lit(0), F.col(many) - 1))
    as_member = dealt.select("token", F.pmod("h", "lefts").cast("int").alias("left"), every("rights").alias("right"), F.lit(False).alias("asks"), "open", "band", "node", "label")
    as_asker = dealt.filter("open").select("token", every("lefts").alias("left"), F.pmod("h", "rights").cast("int").alias("right"), F.lit(True).alias("asks"), "open", "band", "node", "label")
    cells = as_member.unionAll(as_asker).join(nodes.select("node", "n", "regs"), "node").join(full, "node")
    cells = cells.select("token", "left", "right", "asks", "open", "band", "node", "n", "regs", "label", "tokens")
    with _small_batches(spark, 256):
        late = cells.repartition("token", "left", "right").sortWithinPartitions("token", "left", "right").mapInArrow(_cell_links(near), "a bigint, b bigint")
        late = stage.write(late, "hyper-late")
    labels = components(labels.toDF("a", "b").unionAll(late), stage, "hyper-final")
    stage.release(*[n for n in stage.paths if n not in ("hyper-rows", "hyper-final")])
    out = rows.join(labels, "node", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("node", F.col("doc_id")).alias("node"), F.coalesce("label", "node", F.col("doc_id")).alias("component_id"))


def op11_hyperminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of each document's set of two-word shingles, its component at a similarity of 0.8, and whether it is the one kept."""
    groups = near_copies(documents(spark, sf_dir), k=2, num=80, den=100)
    return groups.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


OP11_SQL = f"""{near_copies_sql(2, 80)}
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM found
"""
