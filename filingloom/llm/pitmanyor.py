"""Scores of texts by a hierarchical Pitman-Yor model of words.

Each word is drawn in the restaurant of its context, the word before it; all context restaurants share the
unigram restaurant as their parent, and its parent is uniform over the training words and one unknown. Every context
has a restaurant of its own; words and contexts are told apart by 64-bit hashes.

Texts are read in groups. A group keeps a file with the pairs (word, context) of each text, and sends each distinct pair
once, with its training count, to the bucket of the word, so the word's tables in all restaurants and its place in the
parent are sampled in one task. Words that make up a large part of the input are dealt to all buckets by their context,
and their parent's place is kept by the driver; there can be at most MAX_HOT of them. Restaurants have homes, dealt by
context: before a sweep a bucket gets the totals of the restaurants it has pairs in from their homes, and sends its tables
there after it. In the end a bucket returns the score of each distinct pair to the groups that sent it.

In a Gibbs sweep every bucket seats the customers of each word in each restaurant anew, given the totals of the
sweep before. The number of tables t of c customers has the conditional probability S(c,t) p^t prod(strength + discount *
tables of others), with S the generalised Stirling numbers; it is drawn from this for up to EXACT customers, and by
seating the rest of them in turn, in blocks of an eighth, for more. One customer has one table.
"""

from __future__ import annotations

import io
import posixpath
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingloom.llm.common import Stage, documents
from filingloom.sources.snapshots import new_path

MAX_HOT = 1 << 16
BUCKET_TOKENS = 3_000_000
GROUP_TOKENS = 500_000
GROUP_DOCS = 60_000
EXACT = 32
_END, _BEGIN = np.uint64(0x5EED0E4D00000001), np.uint64(0x5EED0E4D00000002)  # hashes that stand for the end and the begin of a text
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SCALARS = ["tokens", "words", "customers", "tables", "pairs_1", "pairs_2", "words_1", "words_2"]
#: home and bucket: data from one to the other; only one of them: its own state; bucket -1: a group's file
_ROW = "home int, bucket int, grp bigint, path string, seats string, samples array<string>, totals binary, data binary"
_ROW_SCHEMA = pa.schema([("home", pa.int32()), ("bucket", pa.int32()), ("grp", pa.int64()), ("path", pa.string()), ("seats", pa.string()), ("samples", pa.list_(pa.string())), ("totals", pa.binary()), ("data", pa.binary())])
_WORDS: dict[bytes, int] = {}


def _word(word: bytes) -> int:
    if (h := _WORDS.get(word)) is None:
        if len(_WORDS) >= 500_000:
            _WORDS.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            _WORDS[word] = h
    return h


def _context(hashes: np.ndarray) -> np.ndarray:
    """What a context goes by: one to one, and in the order of homes."""
    return hashes * _MIX


def _home(contexts: np.ndarray, n: int) -> np.ndarray:
    return ((contexts >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    return (((hashes ^ (hashes >> np.uint64(31))) * _MIX >> np.uint64(20)) % np.uint64(n)).astype(np.int32)


def _log_stirling(discount: float) -> np.ndarray:
    """log S(c, t) for c and t up to EXACT; -inf where it is 0."""
    s = np.zeros((EXACT + 1, EXACT + 1))
    s[0, 0] = 1.0
    for c in range(EXACT):
        for t in range(1, c + 2):
            s[c + 1, t] = s[c, t - 1] + (c - t * discount) * s[c, t] * (t <= c)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.log(np.maximum(s, 0))


def sample_tables(count: np.ndarray, p: np.ndarray, others: np.ndarray, discount: float, strength: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish's customers: count of customers, p of the dish in the parent, others: tables of other dishes."""
    tables = np.ones(len(count), np.int64)
    table = _log_stirling(discount)
    logp, start = np.log(np.maximum(p, 1e-300)), np.maximum(others, 0) * discount + strength
    for c in range(2, EXACT + 1):
        at = np.flatnonzero(count == c if c < EXACT else count >= c)
        step = 500_000 // c  # so that a table of ways stays small
        for cut in range(0, len(at), step):
            own = at[cut : cut + step]
            ways = table[c, 1 : c + 1] + np.arange(1, c + 1) * logp[own][:, None]
            ways += np.cumsum(np.log(start[own][:, None] + discount * np.arange(c)), axis=1)
            ways = np.cumsum(np.exp(ways - ways.max(axis=1, keepdims=True)), axis=1)
            tables[own] = 1 + (ways < rng.random(len(own))[:, None] * ways[:, -1:]).sum(axis=1)
    at = np.flatnonzero(count > EXACT)
    seated = np.full(len(at), EXACT, np.int64)
    while len(at):
        block = np.minimum(np.maximum(seated // 8, 1), count[at] - seated)
        new = (start[at] + discount * tables[at]) * p[at]
        share = new / (new + seated - discount * tables[at])
        tables[at] += rng.binomial(block, np.clip(share, 0, 1))
        seated += block
        more = seated < count[at]
        at, seated = at[more], seated[more]
    return tables


def _hot_words(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Hashes of words that would fill a quarter of a bucket or more, the end among them, and how many words there are.

    Only used to deal the work: any list gives the same counts. Counted on every 16th word of each text; a task reports
    words that make up a hundred-thousandth of its own.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        total = ends = 0
        for batch in batches:
            for text in batch.column(0):
                words = (text.as_py() or "").encode().lower().split()
                total += len(words) + 1
                ends += 1
                seen.update(words[len(words) % 16 :: 16])
            if len(seen) > 400_000:  # rare words are not reported
                seen = Counter(dict(seen.most_common(50_000)))
        often = [(w, n) for w, n in seen.most_common(2 * MAX_HOT) if n * 16 * 100_000 >= total]
        hashes = np.array([_word(w) for w, _ in often], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([*hashes.tolist(), int(_END), None], pa.int64()), pa.array([*(16 * n for _, n in often), ends, total], pa.int64())], names=["word", "n"])

    found = texts.mapInArrow(local, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    total = found.filter("word IS NULL").first()
    total = total.n if total else 0
    hot = found.filter(F.col("word").isNotNull() & (F.col("n") * 4 >= BUCKET_TOKENS)).orderBy(F.col("n").desc(), "word").limit(MAX_HOT).collect()
    return np.sort(np.array([r.word for r in hot], np.int64).view(np.uint64)), total


def _small(a: np.ndarray) -> np.ndarray:
    return a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))


def _steps(a: np.ndarray) -> np.ndarray:
    """Differences of numbers below 2**32; undone by _places."""
    return np.diff(a.astype(np.uint32), prepend=np.uint32(0))


def _places(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint32).astype(np.int64)


def _pack(**arrays: np.ndarray) -> bytes:
    """Arrays by name, compressed with the first bytes of all numbers together, then the second, and so on."""
    out = io.BytesIO()
    np.savez(out, **{f"{c}:{a.dtype.str}": np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T) for c, a in arrays.items()})
    return len(out.getbuffer()).to_bytes(8, "little") + pa.compress(out.getvalue(), codec="zstd", asbytes=True)


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    plain = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    with np.load(io.BytesIO(plain)) as held:
        return {c.split(":")[0]: np.ascontiguousarray(held[c].T).reshape(-1).view(c.split(":")[1]) for c in held.files}


def _put(folder: str, name: str, data: bytes) -> str:
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(posixpath.join(root, name)) as out:
        out.write(data)
    return f"{folder}/{name}"


def _arrays(path: str) -> dict[str, np.ndarray]:
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_stream(name) as f:
        return _unpack(f.read())


def _attempt() -> str:
    """Told apart by the attempt: a repeated task writes other files, and only the winner's row names its own."""
    return str(TaskContext.get().taskAttemptId())


def _rows(*rows: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(list(rows), _ROW_SCHEMA)


def _gather(hot: np.ndarray, buckets: int, folder: str):
    """Distinct pairs (word, context) of groups of texts with their training counts, dealt to buckets by word.

    A row with bucket -1 names the group's file: ids, lengths and pairs of its texts, the pairs numbered by bucket, word and
    context, and the number of pairs of each word in each bucket.
    """

    def group(number: int, docs: list[tuple]) -> Iterator[dict]:
        index: dict[bytes, int] = {}
        ids, lengths = [], []
        for _, words, _ in docs:
            ids.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words)))
            lengths.append(len(words) + 1)
        hashes = np.array([*map(_word, index), int(_END), int(_BEGIN)], np.uint64)
        end, begin = len(index), len(index) + 1
        word = np.concatenate([np.append(x, end) for x in ids])
        previous = np.concatenate([np.append(np.array([begin]), x) for x in ids])
        doc = np.repeat(np.arange(len(docs), dtype=np.int64), lengths)
        contexts = _context(hashes)
        by_word, by_context = np.argsort(hashes), np.argsort(contexts)
        word_rank, context_rank = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64)
        word_rank[by_word] = context_rank[by_context] = np.arange(len(hashes))
        pairs, at = np.unique((word_rank[word] << 32) | context_rank[previous], return_inverse=True)
        train = np.array([t for _, _, t in docs])
        cnt = np.bincount(at, weights=train[doc], minlength=len(pairs)).astype(np.int64)
        w, c = by_word[pairs >> 32], pairs & 0xFFFFFFFF
        to = _bucket(hashes, buckets)[w]
        if (spread := np.isin(hashes, hot)[w]).any():
            to = np.where(spread, _bucket(hashes[w] ^ (contexts[by_context[c]] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), buckets), to)
        order = np.argsort(to, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        w, c, cnt, to = w[order], c[order], cnt[order], to[order]
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(to) != 0)), len(to))
        runs = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own = w[a:b]
            run = np.append(np.flatnonzero(np.append(True, np.diff(own) != 0)), b - a)
            runs.append(np.diff(run))
            seen, ctx = np.unique(c[a:b], return_inverse=True)
            yield {"bucket": int(to[a]), "grp": number, "data": _pack(words=hashes[own[run[:-1]]], runs=_small(runs[-1]), contexts=contexts[by_context[seen]], ctx=_small(ctx), cnt=_small(cnt[a:b]))}
        pairs = np.sort((doc << 32) | place[at]) & 0xFFFFFFFF  # in a text the order has no influence
        data = _pack(ids=np.array([i or 0 for i, _, _ in docs], np.int64), missing=np.array([i is None for i, _, _ in docs]), train=train,
                     lengths=np.array(lengths, np.int64), pairs=_steps(pairs), runs=_small(np.concatenate(runs)))
        yield {"bucket": -1, "grp": number, "path": _put(folder, f"group-{number}-{_attempt()}", data)}

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, text, train in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = (text.as_py() or "").encode().lower().split()
                held.append((doc_id, words, train))
                size += len(words) + 1
                if size >= GROUP_TOKENS or len(held) >= GROUP_DOCS:
                    yield _rows(*group(number, held))
                    held, size, number = [], 0, number + 1
        if held:
            yield _rows(*group(number, held))

    return gather


def _by(column: str, batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of sorted batches that agree in a column."""
    current: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if current and current[0][column] != row[column]:
                yield current
                current = []
            current.append(row)
    if current:
        yield current


def _start(hot: np.ndarray, buckets: int, folder: str):
    """The first state of each bucket, and what it says to the homes of its contexts; the rest goes to files.

    Rows of groups' files pass through.
    """

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by("bucket", batches):
            bucket = rows[0]["bucket"]
            if bucket < 0:
                yield _rows(*rows)
                continue
            groups = [r["grp"] for r in rows]
            sent = []
            while rows:
                sent.append(_unpack(rows.pop(0)["data"]))
            words = np.unique(np.concatenate([x["words"] for x in sent]))
            contexts = np.unique(np.concatenate([x["contexts"] for x in sent]))
            keys = [(np.repeat(np.searchsorted(words, x["words"]), x["runs"]) << 32) | np.searchsorted(contexts, x["contexts"])[x["ctx"]] for x in sent]
            sizes, times = [len(x) for x in keys], np.concatenate([x["cnt"].astype(np.int64) for x in sent])
            del sent
            keys, at = np.unique(np.concatenate(keys), return_inverse=True)
            cnt = np.bincount(at, weights=times, minlength=len(keys)).astype(np.int64)
            word, ctx = keys >> 32, keys & 0xFFFFFFFF
            many, own = cnt > 1, ~np.isin(words, hot)
            home = _home(contexts, buckets)
            tables = np.bincount(ctx[many], minlength=len(contexts))  # at first one for each pair
            asked = tables > 0
            path = f"bucket-{bucket}-{_attempt()}"
            _put(folder, f"{path}.pairs", _pack(word=_steps(word), ctx=_small(ctx), cnt=_small(cnt), groups=np.array(groups, np.int64), sizes=np.array(sizes, np.int64), at=_steps(at)))
            fixed = {
                "words": words, "count": np.bincount(word, weights=cnt, minlength=len(words)).astype(np.int64),
                "single": np.bincount(word[cnt == 1], minlength=len(words)), "pair_word": word[many].astype(np.int32),
                "pair_ctx": (np.cumsum(asked) - 1)[ctx[many]].astype(np.int32), "pair_count": cnt[many], "homes": np.bincount(home[asked], minlength=buckets),
            }
            _put(folder, f"{path}.fixed", _pack(**fixed))
            spread = np.bincount(word[cnt > 0], minlength=len(words))
            own &= fixed["count"] > 0
            scalars = [int(cnt.sum()), int(own.sum()), 0, 0, int((cnt == 1).sum()), int((cnt == 2).sum()), int((spread[own] == 1).sum()), int((spread[own] == 2).sum())]
            seats = {"t": np.ones(len(fixed["pair_word"]), np.int32), "t1": np.ones(len(words), np.int32)}
            customers, alone = np.bincount(ctx, weights=cnt, minlength=len(contexts)).astype(np.int64), np.bincount(ctx[cnt == 1], minlength=len(contexts))
            cuts = np.searchsorted(home, np.arange(buckets + 1))
            yield _rows(_state_row(bucket, f"{folder}/{path}", fixed, seats, [], hot, scalars))
            for h in np.flatnonzero(np.diff(cuts)).tolist():
                part = slice(cuts[h], cuts[h + 1])
                yield _rows({"home": h, "bucket": bucket, "data": _pack(contexts=contexts[part], customers=_small(customers[part]), alone=_small(alone[part]), tables=_small(tables[part]))})

    return start


def _open(folder: str):
    """The first state of each home, and the tables of each restaurant for the buckets that have it.

    A home's file has the customers of its restaurants, their tables with one customer, and the places of what each bucket asks for.
    """

    def open_homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by("home", batches):
            home, buckets = rows[0]["home"], [r["bucket"] for r in rows]
            sent = [_unpack(r["data"]) for r in rows]
            contexts = np.unique(np.concatenate([x["contexts"] for x in sent]))
            places = [np.searchsorted(contexts, x["contexts"]) for x in sent]
            sums = {c: np.zeros(len(contexts), np.int64) for c in ("customers", "alone", "tables")}
            for x, at in zip(sent, places, strict=True):
                for c, total in sums.items():
                    total[at] += x[c]
            asked = [x["tables"] > 0 for x in sent]
            data = _pack(customers=sums["customers"], alone=sums["alone"], buckets=np.array(buckets, np.int64), sizes=np.array([len(x) for x in places], np.int64),
                         places=_steps(np.concatenate(places)), asked=np.concatenate(asked))
            yield _rows({"home": home, "path": _put(folder, f"home-{home}-{_attempt()}", data), "samples": []})
            for bucket, at, own in zip(buckets, places, asked, strict=True):
                if own.any():
                    yield _rows({"home": home, "bucket": bucket, "data": _pack(tables=_small((sums["alone"] + sums["tables"])[at[own]]))})

    return open_homes


def _answer(folder: str, number: int, keep: bool, last: bool):
    """Each home's tables after a sweep, for the buckets that have pairs to seat there; keep: they become one of the samples.

    last: instead the customers and all samples' tables of every restaurant, for all buckets.
    """

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for state, *rows in _by("home", batches):
            held = _arrays(state["path"])
            cuts = np.cumsum(held["sizes"])[:-1]
            places = dict(zip(held["buckets"].tolist(), zip(np.split(_places(held["places"]), cuts), np.split(held["asked"], cuts), strict=True), strict=True))
            tables = held["alone"].copy()
            for row in rows:
                at, own = places[row["bucket"]]
                tables[at[own]] += _unpack(row["data"])["tables"]
            samples = state["samples"]
            if keep:
                samples = [*samples, _put(folder, f"home-{state['home']}-{number}-{_attempt()}", _pack(tables=tables))]
            yield _rows({"home": state["home"], "path": state["path"], "samples": samples})
            totals = {"customers": held["customers"], **{f"tables{k}": _arrays(path)["tables"] for k, path in enumerate(samples)}} if last else {"tables": tables}
            for bucket, (at, own) in places.items():
                at = at if last else at[own]
                if len(at):
                    yield _rows({"home": state["home"], "bucket": bucket, "data": _pack(**{c: _small(v[at]) for c, v in totals.items()})})

    return answer


def _state_row(bucket: int, path: str, fixed: dict, seats: dict, samples: list[str], hot: np.ndarray, scalars: list[int], keep: bool = False) -> dict:
    """A bucket's row; its seating goes to a file, which becomes one of the samples if it is to be kept.

    Totals to be summed over buckets: for each hot word its customers in the parent and its count, and the scalars.
    """
    folder, name = posixpath.split(path)
    seating = _put(folder, f"{name}.seats-{_attempt()}", _pack(**seats))
    n = len(fixed["words"])
    customers = fixed["single"] + np.bincount(fixed["pair_word"], weights=seats["t"], minlength=n).astype(np.int64)
    is_hot = np.isin(fixed["words"], hot)
    place = np.searchsorted(hot, fixed["words"][is_hot])
    hot_customers, hot_count = np.zeros(len(hot), np.int64), np.zeros(len(hot), np.int64)
    hot_customers[place], hot_count[place] = customers[is_hot], fixed["count"][is_hot]
    own = ~is_hot & (customers > 0)
    scalars = [*scalars[:2], int(customers[own].sum()), int(seats["t1"][own].sum()), *scalars[4:]]
    totals = np.concatenate([hot_customers, hot_count, np.array(scalars)]).astype(np.int64)
    return {"bucket": bucket, "path": path, "seats": seating, "samples": [*samples, seating] if keep else samples, "totals": totals.tobytes()}


class _Globals:
    """What all tasks know in a sweep: the hot words, and the scalars."""

    def __init__(self, totals: np.ndarray, hot: np.ndarray, first: _Globals | None, seed: int) -> None:
        parts = np.split(totals, np.cumsum([len(hot), len(hot)]))
        self.hot = hot
        if first is None:
            self.scalars = dict(zip(_SCALARS, parts[2].tolist(), strict=True))
            s = self.scalars
            discount = lambda one, two: min(0.95, max(0.05, one / (one + 2 * two))) if one else 0.5
            self.discount, self.discount_1 = discount(s["pairs_1"], s["pairs_2"]), discount(s["words_1"], s["words_2"])
            self.hot_count = parts[1]
            self.words = s["words"] + int((self.hot_count > 0).sum())
            self.hot_tables = (parts[0] > 0).astype(np.int64)
        else:
            for name in ("scalars", "discount", "discount_1", "hot_count", "words", "hot_tables"):
                setattr(self, name, getattr(first, name))
        self.hot_customers = parts[0]
        now = dict(zip(_SCALARS, parts[2].tolist(), strict=True))
        if first is not None:
            others = now["tables"] + self.hot_tables.sum() - self.hot_tables
            seats = sample_tables(self.hot_customers, np.full(len(hot), self.uniform), others, self.discount_1, 1.0, np.random.default_rng(seed))
            self.hot_tables = np.where(self.hot_customers > 0, seats, 0)
        self.all_customers = now["customers"] + int(self.hot_customers.sum())
        self.all_tables = now["tables"] + int(self.hot_tables.sum())

    strength = 1.0

    @property
    def uniform(self) -> float:
        return 1.0 / (self.words + 1)

    def parent(self, words: np.ndarray, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Each word's probability in the unigram restaurant."""
        customers, tables = customers.astype(float), tables.astype(float)
        if len(self.hot):
            place = np.minimum(np.searchsorted(self.hot, words), len(self.hot) - 1)
            is_hot = self.hot[place] == words
            customers[is_hot], tables[is_hot] = self.hot_customers[place[is_hot]], self.hot_tables[place[is_hot]]
        tables = np.where(customers > 0, tables, 0)
        return (customers - self.discount_1 * tables + (self.strength + self.discount_1 * self.all_tables) * self.uniform) / (self.strength + self.all_customers)


def _sweep(sent, number: int, seed: int, keep: bool):
    """One Gibbs sweep over a bucket's words; keep: its seating becomes one of the samples."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g: _Globals = sent.value
        for row, *answers in _by("bucket", batches):
            a, old = _arrays(f"{row['path']}.fixed"), _arrays(row["seats"])
            tables = np.concatenate([np.zeros(0, np.int64), *(_unpack(x["data"])["tables"].astype(np.int64) for x in answers)])
            rng = np.random.default_rng([seed, number, row["bucket"]])
            seen = lambda t: a["single"] + np.bincount(a["pair_word"], weights=t, minlength=len(a["words"])).astype(np.int64)  # noqa: B023, E731
            p = g.parent(a["words"], seen(old["t"]), old["t1"])
            t = sample_tables(a["pair_count"], p[a["pair_word"]], tables[a["pair_ctx"]] - old["t"], g.discount, g.strength, rng)
            customers = seen(t)
            t1 = sample_tables(customers, np.full(len(customers), g.uniform), g.all_tables - old["t1"].astype(np.int64), g.discount_1, g.strength, rng)
            seats = {"t": t.astype(np.int32), "t1": t1.astype(np.int32)}
            yield _rows(_state_row(row["bucket"], row["path"], a, seats, row["samples"], g.hot, [0] * len(_SCALARS), keep))
            cuts = np.append(0, np.cumsum(a["homes"]))
            tables = np.bincount(a["pair_ctx"], weights=t, minlength=len(tables)).astype(np.int64)
            for h in np.flatnonzero(a["homes"]).tolist():
                yield _rows({"home": h, "bucket": row["bucket"], "data": _pack(tables=_small(tables[cuts[h] : cuts[h + 1]]))})

    return sweep


def _score(sent):
    """For the pairs that each group sent to a bucket: the log probabilities, and the training counts of their words."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples: list[_Globals] = sent.value
        g = samples[0]
        for row, *answers in _by("bucket", batches):
            a, pairs = _arrays(f"{row['path']}.fixed"), _arrays(f"{row['path']}.pairs")
            answers = [_unpack(x.pop("data")) for x in answers]
            restaurants = {c: np.concatenate([x[c].astype(np.int64) for x in answers]) for c in answers[0]}
            del answers
            words, count = a["words"], a["count"].copy()
            if len(g.hot):
                place = np.minimum(np.searchsorted(g.hot, words), len(g.hot) - 1)
                is_hot = g.hot[place] == words
                count[is_hot] = g.hot_count[place[is_hot]]
            word, ctx, c = _places(pairs["word"]), pairs["ctx"], pairs["cnt"].astype(np.int64)
            many = c > 1
            tables, total = c.copy(), np.zeros(len(c))
            for k, (s_g, path) in enumerate(zip(samples, row["samples"], strict=True)):
                held = _arrays(path)
                p = s_g.parent(words, a["single"] + np.bincount(a["pair_word"], weights=held["t"], minlength=len(words)).astype(np.int64), held["t1"])
                tables[many] = held["t"]
                total += (c - s_g.discount * tables + (s_g.strength + s_g.discount * restaurants[f"tables{k}"][ctx]) * p[word]) / (s_g.strength + restaurants["customers"][ctx])
            logs = np.log10(total / len(samples)).astype(np.float32)
            for grp, at in zip(pairs["groups"].tolist(), np.split(_places(pairs["at"]), np.cumsum(pairs["sizes"])[:-1]), strict=True):
                own = word[at]
                yield _rows({"bucket": row["bucket"], "grp": grp, "data": _pack(score=logs[at], count=_small(count[own[np.append(True, np.diff(own) != 0)]]))})

    return score


def _merge(all_counts: int):
    """The sums of each group's texts; rows come sorted by group and bucket, the one with the group's file first."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, *rows in _by("grp", batches):
            texts, sent = _arrays(head["path"]), [_unpack(r["data"]) for r in rows]
            scores, counts = np.concatenate([x["score"] for x in sent]).astype(float), np.concatenate([x["count"].astype(np.int64) for x in sent])
            run = np.repeat(np.arange(len(counts)), texts["runs"])
            if len(run) != len(scores):
                raise ValueError(f"group {head['grp']} has {len(run)} pairs, got {len(scores)}")
            at = _places(texts["pairs"])
            first = np.cumsum(texts["lengths"]) - texts["lengths"]
            base = np.log10((counts + 1) / all_counts)
            sums = [np.add.reduceat(v, first) for v in ((counts > 0).astype(np.int64)[run][at], base[run][at], scores[at])]
            yield pa.RecordBatch.from_arrays([pa.array(texts["ids"], mask=texts["missing"]), pa.array(~texts["train"]), pa.array(texts["lengths"]), *map(pa.array, sums)],
                                             names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return merge


def _summed(state: DataFrame, stage: Stage) -> np.ndarray:
    """The sum of all buckets' totals, by a tree: no task and not the driver gets more than 16 vectors."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for v in batch.column(0):
                own = np.frombuffer(v.as_buffer(), np.int64)
                total = own.copy() if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["totals"])

    vectors, n, level = state.select("totals"), state.count(), 0
    while n > 16:
        n, level = -(-n // 16), level + 1
        vectors = stage.write(vectors.repartition(n).mapInArrow(add, "totals binary"), f"totals-{level}")
    return sum(np.frombuffer(r.totals, np.int64) for r in vectors.collect())


def score_texts(docs: DataFrame, train: Column, burn_in: int = 2, samples: int = 3, seed: int = 11, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, learned from the rows where train holds.

    Tokens are the words between ASCII white space, A-Z in lower case, and one end. base_score: sum of log10 of (count + 1) /
    (training tokens + training words + 1). score: the log10 probability of the text, each token's probability being the mean
    over the samples kept after burn_in sweeps. A null or empty text is its end alone. Rows are scored each for itself; ids
    may be null or repeat. train that is null counts as held out. Without training rows every token has probability 1.
    """
    spark = docs.sparkSession
    stage = Stage(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    hot, total = _hot_words(rows.select("text"))
    buckets = max(1, -(-total // BUCKET_TOKENS))
    folder = new_path(spark, "llm-buckets")
    dealt = rows.mapInArrow(_gather(hot, buckets, folder), _ROW).repartition("bucket", F.when(F.col("bucket") < 0, F.col("grp"))).sortWithinPartitions("bucket", "grp")
    begun = stage.write(dealt.mapInArrow(_start(hot, buckets, folder), _ROW), "buckets")
    heads = stage.write(begun.filter("bucket < 0"), "heads")
    if heads.isEmpty():
        return spark.createDataFrame([], "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")

    def meet(at: str, state: DataFrame, messages: DataFrame | None = None) -> DataFrame:
        """What each bucket or home needs for a step: its own row, then what it was sent."""
        both = state if messages is None else state.unionByName(messages)
        return both.repartition(buckets, at).sortWithinPartitions(at, "home", "bucket")

    state, messages = begun.filter("bucket >= 0 AND home IS NULL"), begun.filter("home IS NOT NULL")
    first = now = _Globals(_summed(state, stage), hot, None, seed)
    back = stage.write(meet("home", messages).mapInArrow(_open(folder), _ROW), "homes")
    kept: list[_Globals] = []
    for number in range(burn_in + samples):
        sent, keep = spark.sparkContext.broadcast(now), number >= burn_in
        both = meet("bucket", state, back.filter("bucket IS NOT NULL"))
        swept = stage.write(both.mapInArrow(_sweep(sent, number, seed, keep), _ROW), "buckets")
        state, messages = swept.filter("home IS NULL"), swept.filter("home IS NOT NULL")
        now = _Globals(_summed(state, stage), hot, now, seed + number)
        if keep:
            kept.append(now)
        back = stage.write(meet("home", back.filter("bucket IS NULL"), messages).mapInArrow(_answer(folder, number, keep, number == burn_in + samples - 1), _ROW), "homes")
        sent.unpersist()
    both = meet("bucket", state, back.filter("bucket IS NOT NULL"))
    parts = both.mapInArrow(_score(spark.sparkContext.broadcast(kept)), _ROW)
    merged = heads.unionByName(parts).repartition("grp").sortWithinPartitions("grp", "bucket")
    merged = merged.mapInArrow(_merge(first.scalars["tokens"] + first.words + 1), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return merged.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(first.scalars["tokens"]).cast("bigint").alias("train_tokens"), "base_score", "score")


def op10_pitman_yor_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log probability of every document, learned from the documents that are not held out."""
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    return score_texts(documents(spark, sf_dir), train)
