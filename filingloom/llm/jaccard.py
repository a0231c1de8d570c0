"""Documents whose sets of word shingles are similar, by a size-aware join.

Small sets (light) enumerate all subsets of the size that a partner must share; two of them share such a subset
just if their overlap is large enough. Large sets (heavy) are met in inverted lists: of each set only so many
shingles, the rarest first, are listed that two similar sets must meet in one of them. The size that separates the
two is the one with the least estimated cost.

What follows is the same for lists of subsets and of shingles. Each member is compared with the smallest one of its
list, those outside the list's main component then with a few of that, and only those still outside with all members,
in blocks. Pairs are compared by bit maps, whose distance never exceeds the distance of the sets, and verified by the
sets themselves. Of the pairs of a block that may be similar, a spanning forest is verified, the closest first; only
lists in which a pair of it failed are looked at again, for the pairs that are not connected otherwise. So a group of
near copies yields a few links for each member and never all its pairs, and no link between two components is missed.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from filingloom.llm.common import Stage, documents, free_name
from filingloom.llm.components import components
from filingloom.llm.near_sql import near_copies_sql

MAX_LIGHT = 24  # sets below this size are sent whole, so that any smaller boundary can be chosen
BITS = 1024  # least number of a set's bit map
BLOCK = 2048  # members of a list compared in one task at a time
SCOUTS = 8  # members of a list's main component that those outside are compared with
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_WORDS: dict[bytes, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


def _word(word: bytes) -> int:
    if (h := _WORDS.get(word)) is None:
        if len(_WORDS) >= 500_000:
            _WORDS.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            _WORDS[word] = h
    return h


def shingles(text: str | None, k: int) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles of k words; of the whole sequence if it has fewer words."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z and the six ASCII white space characters only
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(_word, words), np.uint64, len(words))
    width = min(k, len(words))
    n = len(words) - width + 1
    h = np.full(n, width, np.uint64)
    for j in range(width):
        h = _mix(h + ids[j : j + n])
    return np.unique(h)


class Threshold:
    """Similar: den * intersection >= num * union."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den

    def least_partner(self, n: int) -> int:
        return -(-self.num * n // self.den)

    def most_partner(self, n: int) -> int:
        return self.den * n // self.num

    def overlap(self, n: int, m: int) -> int:
        return -(-self.num * (n + m) // (self.num + self.den))

    def listed(self, n: int) -> int:
        """How many shingles of a set must be listed."""
        return n - self.least_partner(n) + 1

    def distance(self, total):
        """The largest symmetric difference of similar sets whose sizes add up to total."""
        return (self.den - self.num) * total // (self.num + self.den)

    def subset_sizes(self, n: int) -> list[int]:
        return sorted({self.overlap(n, m) for m in range(self.least_partner(n), self.most_partner(n) + 1)})

    def n_subsets(self, n: int) -> int:
        import math

        return sum(math.comb(n, c) for c in self.subset_sizes(n) if c <= n)


def _subsets(tokens: np.ndarray, near: Threshold) -> np.ndarray:
    """Hashes of all subsets of the sizes at which a set can meet a partner."""
    mixed = [int(x) for x in _mix(tokens)]
    whole, n, out = sum(mixed), len(mixed), []
    for c in near.subset_sizes(n):
        if c <= n:
            out.extend((whole - sum(gone)) * 31 + c for gone in itertools.combinations(mixed, n - c))
    return _mix(np.array([x & (2**64 - 1) for x in out], np.uint64))


def choose_boundary(sizes: dict[int, int], near: Threshold, mean_list: float) -> int:
    """Sets below the returned size are light. sizes: number of sets by size, up to MAX_LIGHT."""
    def cost(x: int) -> float:
        light = sum(count * near.n_subsets(n) for n, count in sizes.items() if n < x)
        return light + sum(count * near.listed(n) * mean_list for n, count in sizes.items() if n >= near.least_partner(x))

    return min(range(1, MAX_LIGHT), key=lambda x: (cost(x), x))


_SETS = "doc_id bigint, n bigint, cls binary, low array<bigint>, rest array<bigint>, bits binary"


def _bitmap(tokens: np.ndarray) -> bytes:
    """Parities of the numbers of hashes that fall on each bit; half as many bits as hashes, rounded up to a power of two."""
    width = max(BITS, 1 << ((len(tokens) + 1) // 2 - 1).bit_length())
    counts = np.bincount((_mix(tokens) % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(counts.astype(np.uint8)).tobytes()


def _matrix(maps: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(maps), np.uint64).reshape(len(maps), -1)


def _folded(maps: np.ndarray, words: int) -> np.ndarray:
    """Bit maps of fewer bits: bits that fall together are added up, as if the hashes had been dealt so."""
    while maps.shape[1] > words:
        half = maps.shape[1] // 2
        maps = maps[:, :half] ^ maps[:, half:]
    return maps


def _likely(near: Threshold) -> Callable:
    """The pairs (a, b) with sizes n, m and bit maps s, t that may be similar."""

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column("n").to_numpy() + batch.column("m").to_numpy()
            s, t = batch.column("s").to_pylist(), batch.column("t").to_pylist()
            shapes: dict[tuple[int, int], list[int]] = {}
            for i, shape in enumerate(zip(map(len, s), map(len, t), strict=True)):
                shapes.setdefault(shape, []).append(i)
            keep = np.zeros(len(s), bool)
            for shape, at in shapes.items():
                words = min(shape) // 8
                left, right = _folded(_matrix([s[i] for i in at]), words), _folded(_matrix([t[i] for i in at]), words)
                keep[at] = np.bitwise_count(left ^ right).sum(axis=1) <= near.distance(total[at])
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])

    return likely


def _sketches(k: int, near: Threshold, region: float) -> Callable:
    """Size, identity, listed part and bit map of each text's set.

    low: all hashes in the lowest part of the hash space; rest: the next ones, if low is too short to list from.
    """
    import hashlib

    limit = np.uint64(int(region * 2**64) if region < 1 else 2**64 - 1)

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cls, low, rest, bits = [], [], [], [], []
            for text in batch.column(1):
                s = shingles(text.as_py(), k)
                at = int(np.searchsorted(s, limit))
                to = len(s) if len(s) < MAX_LIGHT else max(at, near.listed(len(s)))
                n.append(len(s))
                cls.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                low.append(s[:at].view(np.int64))
                rest.append(s[at:to].view(np.int64))
                bits.append(_bitmap(s))
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(low, lists), pa.array(rest, lists), pa.array(bits, pa.binary())],
                names=["doc_id", "n", "cls", "low", "rest", "bits"])

    return sketches


def _root(up: dict[int, int], x: int) -> int:
    while (top := up.get(x, x)) != x:
        up[x] = up.get(top, top)
        x = top
    return x


def _near_pairs(near: Threshold, every: bool) -> Callable:
    """Pairs of a list's members that may be similar, by their bit maps.

    Rows come sorted by cell: a block of a list's members and a block of those that ask. Pairs with one label are left
    out. A spanning forest of the labels is given, the closest pairs first, unless every pair is wanted.
    """
    out_names = ["token", "a", "b"]

    def distances(bits: list[bytes], member: np.ndarray, asker: int, lo: int, hi: int, maps: dict) -> np.ndarray:
        """Distances of an asker to the members lo to hi. Members are sorted by size, so those with maps of one width lie together."""
        own, out = _matrix([bits[asker]]), []
        while lo < hi:
            width = len(bits[member[lo]])
            if width not in maps:
                same = [i for i in range(len(member)) if len(bits[member[i]]) == width]
                maps[width] = same[0], same[-1] + 1, _matrix([bits[member[i]] for i in same])
            start, end, whole = maps[width]
            to, words = min(end, hi), min(width // 8, own.shape[1])
            out.append(np.bitwise_count(_folded(whole[lo - start : to - start], words) ^ _folded(own, words)).sum(axis=1))
            lo = to
        return np.concatenate(out)

    def one(token, node, n, bits, asks, opened, label) -> Iterator[tuple]:
        by_size = np.lexsort((node, n))
        member, maps = by_size[~asks[by_size]], {}
        sizes = n[member]
        found_a, found_b, found_d = [], [], []
        for i in np.flatnonzero(asks):
            lo = int(np.searchsorted(sizes, near.least_partner(int(n[i]))))
            hi = int(np.searchsorted(sizes, near.most_partner(int(n[i])), side="right"))
            if lo == hi:
                continue
            to = member[lo:hi]
            d = distances(bits, member, i, lo, hi, maps)
            # two that both ask meet twice: the pair counts where the smaller one asks
            ok = (d <= near.distance(n[i] + n[to])) & (label[to] != label[i]) & ~(opened[to] & (node[to] <= node[i]))
            if len(at := np.flatnonzero(ok)):
                found_a.append(np.full(len(at), i))
                found_b.append(to[at])
                found_d.append(d[at])
        if found_a:
            a, b, d = map(np.concatenate, (found_a, found_b, found_d))
            if not every:
                up: dict[int, int] = {}
                keep = []
                for i in np.lexsort((node[b], node[a], d)).tolist():
                    x, y = _root(up, int(label[a[i]])), _root(up, int(label[b[i]]))
                    if x != y:
                        up[max(x, y)] = min(x, y)
                        keep.append(i)
                a, b = a[keep], b[keep]
            yield np.full(len(a), token), np.minimum(node[a], node[b]), np.maximum(node[a], node[b])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def cells(table: pa.Table, last: bool) -> tuple[list[tuple], pa.Table | None]:
            token, left, right = (table.column(c).to_numpy() for c in ("token", "left", "right"))
            cut = np.flatnonzero((np.diff(token) != 0) | (np.diff(left) != 0) | (np.diff(right) != 0)) + 1
            ends = [*cut.tolist(), len(token)]
            if not last:
                ends = ends[:-1]
            out, start = [], 0
            if ends:
                node, n, asks, opened, label = (table.column(c).to_numpy() for c in ("node", "n", "asks", "open", "label"))
                for end in ends:
                    if end - start > 1:
                        s = slice(start, end)
                        bits = table.column("bits").slice(start, end - start).to_pylist()
                        out.extend(one(token[start], node[s], n[s], bits, asks[s], opened[s], label[s]))
                    start = end
            return out, (None if last or start == len(token) else table.slice(start))

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            out, held = cells(held, False)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=out_names)
        if held is not None:
            out, _ = cells(held, True)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=out_names)

    return pairs


def _cells(mixed: DataFrame, counted: DataFrame) -> DataFrame:
    """Members and those that ask (both, if open) dealt to cells of a block of each."""
    dealt = mixed.join(counted, "token").withColumn("h", F.xxhash64("node", F.lit(7)))
    every = lambda many: F.explode(F.sequence(F.lit(0), F.col(many) - 1))
    as_member = dealt.select("token", F.pmod("h", "lefts").cast("int").alias("left"), every("rights").alias("right"), F.lit(False).alias("asks"), "open", "node", "label")
    as_asker = dealt.filter("open").select("token", every("lefts").alias("left"), F.pmod("h", "rights").cast("int").alias("right"), F.lit(True).alias("asks"), "open", "node", "label")
    return as_member.unionAll(as_asker)


def similar_documents(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, region: float | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_shingles, node (the smallest id with the same set) and component_id (the smallest reachable).

    Words are separated by ASCII white space, A-Z in lower case. Two sets are linked if den * intersection >= num * union.
    Shingles are compared by 64-bit hashes, sets with equal content by 128 bits. A null or empty text has an empty set and
    is linked with nothing, not even its like; a text of fewer than k words has one shingle, all of it. Rows with one id are
    one document, whose texts may link it to others in turn. A row with a null id has no node or component. Very long texts are
    taken whole, with a bit map that grows with their set; an empty table gives an empty one; other columns take no part.
    region: part of the hash space in which the frequency of shingles is counted for the order of listing; any value
    gives the same result.
    """
    spark, near = docs.sparkSession, Threshold(num, den)
    stage = Stage(spark)
    region = region or min(1.0, 2.5 * (den - num) / den)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sets = stage.write(texts.mapInArrow(_sketches(k, near, region), _SETS), "sets")

    # one node for each distinct set
    some = sets.filter("n > 0 AND doc_id IS NOT NULL")
    nodes = stage.write(some.groupBy("cls").agg(F.min("doc_id").alias("node"), *[F.first(c).alias(c) for c in ("n", "low", "rest", "bits")]), "nodes")
    member = F.when(F.col("n") > 0, F.col("doc_id"))
    rows = sets.select("doc_id", "n", "cls").join(nodes.select("cls", "node"), "cls", "left")
    rows = stage.write(rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(member.isNotNull(), F.col("node")).alias("node")), "rows")
    same_id = rows.filter("node IS NOT NULL AND node <> doc_id").select("node", "doc_id").join(  # an id whose texts differ links their sets
        nodes.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi").select("node", F.col("doc_id").alias("other"))
    same_id = stage.write(same_id, "same-id")
    stage.release("sets")

    # frequency of the shingles in the region; of a set's unique ones only the number matters
    large = nodes.filter(F.col("n") >= 2)
    tokens = large.select("node", "n", F.explode("low").alias("token"))
    often = stage.write(tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"), "often")
    shared = stage.write(tokens.join(often, "token"), "shared")
    spread = often.agg(F.sum("df").alias("s"), F.sum(F.col("df") * F.col("df")).alias("q")).first()
    small_sizes = {r.n: r["count"] for r in nodes.filter(F.col("n") < 2 * MAX_LIGHT).groupBy("n").count().collect()}
    boundary = choose_boundary(small_sizes, near, (spread.q or 0) / (spread.s or 1) + 1)

    # inverted lists of the large sets
    least = near.least_partner(boundary)
    n = F.col("n")
    need = n - F.ceil(n * num / F.lit(den)).cast("bigint") + 1
    own = shared.groupBy("node").agg(F.count("*").alias("n_shared"))
    heavy = nodes.filter(n >= least).join(own, "node", "left")
    slots = need - (F.size("low") - F.coalesce("n_shared", F.lit(0)))
    heavy = stage.write(heavy.select("node", "n", slots.alias("slots"), "n_shared", "rest").filter("slots > 0"), "heavy")
    order = Window.partitionBy("node").orderBy("df", "token")
    ranked = shared.join(heavy.select("node", "slots"), "node").withColumn("rank", F.row_number().over(order)).filter("rank <= slots")
    further = heavy.select("node", "n", F.explode(F.slice("rest", F.lit(1), F.least(F.size("rest"), F.greatest(F.lit(0), (F.col("slots") - F.coalesce("n_shared", F.lit(0))).cast("int"))))).alias("token"))
    listed = ranked.select("token", "node", "n").unionAll(further.select("token", "node", "n"))

    # subsets of the small sets
    def light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, size, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys = _subsets(np.array(a + b, np.int64).view(np.uint64), near).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), node)), pa.array(np.full(len(keys), size))], names=["token", "node", "n"])

    subsets = nodes.filter(n < boundary).select("node", "n", "low", "rest").mapInArrow(light, "token bigint, node bigint, n bigint")
    listed = stage.write(listed.unionAll(subsets), "listed")
    stage.release("shared", "often", "heavy")
    heads = stage.write(listed.groupBy("token").agg(F.min(F.struct("node", "n")).alias("head"), F.count("*").alias("size")).filter("size > 1"), "heads")
    members = stage.write(listed.join(heads.select("token", F.col("head.node").alias("head"), F.col("head.n").alias("m"), "size"), "token"), "members")
    stage.release("listed", "heads")

    # verification
    named = stage.write(members.select("node").distinct(), "named")
    flags = named.select(F.pmod(F.xxhash64("node"), F.lit(1 << 22)).alias("at")).groupBy(F.shiftright("at", 6).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
    bitmap = np.zeros(1 << 16, np.int64)
    for r in flags.collect():  # at most 65,536 rows, at any size of the input
        bitmap[r.word] = r.bits
    flag = spark.sparkContext.broadcast(bitmap)
    at = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 22))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = flag.value
        for batch in batches:
            place = batch.column(2).to_numpy()
            for i in np.flatnonzero((bits[place >> 6] >> (place & 63)) & 1):
                s = shingles(batch.column(1)[int(i)].as_py(), k).view(np.int64)
                if len(s):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(int(i), 1), pa.array([s], pa.list_(pa.int64()))], names=["node", "tokens"])

    full = texts.filter("doc_id IS NOT NULL").select("doc_id", "text", at.alias("at")).mapInArrow(whole, "node bigint, tokens array<bigint>")
    full = stage.write(full.join(named, "node", "left_semi"), "full")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        left, right = full.select(F.col("node").alias("a"), F.col("tokens").alias("s")), full.select(F.col("node").alias("b"), F.col("tokens").alias("t"))
        both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("s", "t")).cast("bigint"))
        checked = both.select("a", "b", (den * F.col("common") >= num * (F.size("s") + F.size("t") - F.col("common"))).alias("ok"))
        return stage.write(checked.groupBy("a", "b").agg(F.max("ok").alias("ok")), name)

    left = nodes.select(F.col("node").alias("a"), "n", F.col("bits").alias("s"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("bits").alias("t"))

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) that are links: first by size and bit maps, then by the full sets."""
        fit = den * F.least("n", "m") >= num * F.greatest("n", "m")
        likely = pairs.distinct().join(left, "a").join(right, "b").filter(fit).select("a", "b", "n", "m", "s", "t").mapInArrow(_likely(near), "a bigint, b bigint")
        return verified(stage.write(likely, "likely"), name).filter("ok").select("a", "b")

    def still_open(labels: DataFrame, name: str, of: DataFrame) -> DataFrame | None:
        """Members of lists of several components, with their label, the main one and whether theirs is another; None without such lists."""
        labelled = stage.write(of.filter("size > 2").select("token", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), f"{name}-labelled")
        parts = labelled.groupBy("token", "label").agg(F.count("*").alias("n")).groupBy("token").agg(F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("parts"))
        mixed = stage.write(parts.filter("parts > 1").select("token", F.col("most.label").alias("main")), f"{name}-mixed")
        return None if mixed.isEmpty() else labelled.join(mixed, "token").withColumn("open", F.col("label") != F.col("main"))

    def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
        return labels if links.isEmpty() else stage.write(components(labels.toDF("a", "b").unionAll(links), stage), "labels")

    def candidates(mixed: DataFrame, every: bool) -> DataFrame:
        counted = mixed.groupBy("token").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("lefts"), F.ceil(F.sum(F.col("open").cast("int")) / BLOCK).cast("int").alias("rights"))
        cells = _cells(mixed, stage.write(counted, "counted")).join(nodes.select("node", "n", "bits"), "node")
        cells = cells.select("token", "left", "right", "asks", "open", "node", "n", "bits", "label").repartition("token", "left", "right").sortWithinPartitions("token", "left", "right")
        return cells.mapInArrow(_near_pairs(near, every), "token bigint, a bigint, b bigint")

    # each member against the smallest of its lists
    size_fits = den * F.least("n", "m") >= num * F.greatest("n", "m")
    links = linked(members.filter("node <> head").filter(size_fits).select(F.col("head").alias("a"), F.col("node").alias("b")), "heads-checked")
    labels = stage.write(components(links.unionAll(same_id.toDF("a", "b")), stage), "labels")

    # in lists of several components, those outside the main one against some of its members
    if (mixed := still_open(labels, "first", members)) is not None:
        scouts = mixed.filter("NOT open").groupBy("token").agg(*[F.min_by("node", F.xxhash64("node", F.lit(i))).alias(f"s{i}") for i in range(SCOUTS)])
        asked = mixed.filter("open").join(scouts, "token").select("node", F.explode(F.array_distinct(F.array(*[f"s{i}" for i in range(SCOUTS)]))).alias("scout"))
        links = linked(asked.select(F.least("node", "scout").alias("a"), F.greatest("node", "scout").alias("b")), "scouts-checked")
        labels = merged(labels, links)
        mixed = still_open(labels, "second", members)

    # those that are still outside against all members, and once more where a pair of the forest failed
    if mixed is not None:
        first = stage.write(candidates(mixed, False), "pairs")
        checked = verified(first.select("a", "b").distinct(), "checked")
        failed = stage.write(first.join(checked.filter("NOT ok"), ["a", "b"]).select("token").distinct(), "failed")
        labels = merged(labels, checked.filter("ok").select("a", "b"))
        mixed = None if failed.isEmpty() else still_open(labels, "third", members.join(failed, "token", "left_semi"))
        if mixed is not None:
            again = stage.write(candidates(mixed, True).select("a", "b").distinct().join(checked, ["a", "b"], "left_anti"), "again")
            labels = merged(labels, verified(again, "checked-again").filter("ok").select("a", "b"))
    stage.release(*[n for n in stage.paths if n not in ("rows", "labels")])
    out = rows.join(labels, "node", "left")
    component = F.coalesce("label", "node", F.col("doc_id"))
    return out.select("doc_id", "n_shingles", F.coalesce("node", F.col("doc_id")).alias("node"), component.alias("component_id"))


def one_of_each_group(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that have the smallest id of their component, with their own columns.

    Rows with a null id stay, as they are in no component. Of several rows with one id the one with the smallest text
    stays, null first.
    """
    groups = similar_documents(docs, k, num, den, id_col=id_col, text_col=text_col)
    first = groups.filter("doc_id = component_id").select(F.col("doc_id").alias(name := free_name(docs, "kept_id"))).distinct()
    rank = free_name(docs, "kept_rank")
    keyed = docs.join(first, F.col(id_col).cast("bigint") == F.col(name), "left_semi")
    order = Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_first(), *[F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))])
    kept = keyed.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1).drop(rank)
    return kept.unionByName(docs.filter(F.col(id_col).isNull()))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of each document's set of three-word shingles, and its component at a similarity of 0.9."""
    return similar_documents(documents(spark, sf_dir), k=3, num=90, den=100).select("doc_id", "n_shingles", "component_id", "node")


OP3_SQL = f"""{near_copies_sql(3, 90)}
SELECT doc_id, n_shingles, component_id, node FROM found
"""
