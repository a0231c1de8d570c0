"""Repair of the structure of conversations: faults, and the cheapest edits that give a legal order of roles.

The turns are put in order by a range sort, so a conversation may lie across tasks, and are cut into stretches of a
bounded size. A stretch is a sequence of symbols, whose transfer matrix comes from a grammar that all conversations
share. The matrices of a conversation's stretches are multiplied in a tree, with the ranks of the letters in place of the
letters; then each stretch knows between which states it leads, and writes out its own letters and turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingloom.llm.common import Stage, importable
from filingloom.llm.grammar import DELETE, DROP, INSERT, KEEP, REROLE, STATES, TRUNCATED, finish, learn, written

STRETCH = 1024  # turns in a stretch
STRETCH_BYTES = 1 << 20  # characters of text at which a stretch ends
FAN = 64  # matrices multiplied at a time
LEGAL = ("su", "ua", "au")
_SPACE = " \t\n\x0b\x0c\r"
_COSTS = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}

# what a stretch knows of its turns; the counts are of its own turns, without the pair across its beginning
_FACTS = {
    "blank": "bigint", "duplicate": "bigint", "truncated": "bigint", "illegal": "bigint", "n_turns": "bigint",
    "first_turn": "bigint", "last_turn": "bigint", "low_turn": "bigint", "first_role": "string", "last_role": "string",
}
_ARROW = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()),
          "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()),
          "array<struct<role:string,text:string>>": pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))}
_STRETCH = {"at": "bigint", "whole": "boolean", "symbols": "string", **_FACTS, "roles": "array<string>", "texts": "array<string>"}
_PIECE = {"at": "bigint", "whole": "boolean", **_FACTS, "cost": "bigint", "audit": "string", "turns": "array<struct<role:string,text:string>>"}


def _ddl(conv: str, columns: dict[str, str]) -> str:
    return ", ".join([f"conv {conv}", *[f"{c} {t}" for c, t in columns.items()]])


def _batch(conv: pa.DataType, columns: dict[str, str], rows: list[tuple]) -> pa.RecordBatch:
    types = [conv, *[_ARROW[t] for t in columns.values()]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["conv", *columns])


class _Stretch:
    """Consecutive turns of one conversation, in the making."""

    def __init__(self, conv, at: int, begins: bool) -> None:
        self.conv, self.at, self.begins, self.chars = conv, at, begins, 0
        self.symbols: list[str] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.turns: list[int | None] = []
        self.initials: list[str] = []
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}

    def add(self, turn: int | None, role: str, text: str, first: bool) -> None:
        last = text.rstrip(_SPACE)[-1:]
        fault = "blank" if not last else "duplicate" if not first else "truncated" if last not in ".!?" else None
        if fault:
            self.faults[fault] += 1
        self.turns.append(turn)
        self.initials.append(role[:1])
        if fault in ("blank", "duplicate"):
            self.symbols.append(DROP)
            return
        symbol = role[:1] if role[:1] in ("s", "u", "a") else "o"
        self.symbols.append(symbol.upper() if fault else symbol)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def row(self, whole: bool) -> tuple:
        known = [t for t in self.turns if t is not None]
        illegal = sum(a + b not in LEGAL for a, b in zip(self.initials, self.initials[1:], strict=False))
        ends = (self.turns[0], self.turns[-1], known[0] if known else None, self.initials[0], self.initials[-1]) if self.turns else (None,) * 5
        return (self.conv, self.at, whole, "".join(self.symbols), *self.faults.values(), illegal, len(set(known)), *ends, self.roles, self.texts)


def _stretches(most: int, most_chars: int) -> Callable:
    """Turns that come sorted, as stretches. Columns: conv, turn, role, text, copy (null: a dropped turn), first, pos.

    whole: the conversation begins and ends in this task and is one stretch. Turns that must go leave a symbol and no text.
    """
    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Stretch | None = None
        kind = None
        for batch in batches:
            kind, out = batch.schema.field(0).type, []
            for conv, turn, role, text, copy, first, pos in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None:
                    held = _Stretch(conv, pos, False)
                elif held.conv != conv:
                    out.append(held.row(held.begins))
                    held = _Stretch(conv, pos, True)
                if copy is None:
                    continue
                if len(held.symbols) >= most or held.chars >= most_chars:
                    out.append(held.row(False))
                    held = _Stretch(conv, pos, False)
                held.add(turn, role, text, first)
            if out:
                yield _batch(kind, _STRETCH, out)
        if held is not None:
            yield _batch(kind, _STRETCH, [held.row(False)])

    return stretches


def _ranked(matrix: list) -> tuple[list, list]:
    """Costs of a matrix (null: no way) and the ranks of its letters among one another."""
    letters = [x and written(x[1]) for x in matrix]
    rank = {t: k for k, t in enumerate(sorted({t for t in letters if t is not None}))}
    return [x and x[0] for x in matrix], [None if t is None else rank[t] for t in letters]


def _fold(parts: list[list]) -> tuple[list, list[list]]:
    """The product of matrices of (cost, rank), and for each step but the first the state between the two factors."""
    total, between = parts[0], []
    for part in parts[1:]:
        found, via = [], []
        for i in range(STATES):
            for j in range(STATES):
                ways = [(x[0] + y[0], x[1], y[1], m) for m in range(STATES) if (x := total[i * STATES + m]) and (y := part[m * STATES + j])]
                best = min(ways, default=None)
                found.append(best)
                via.append(best and best[3])
        order = {k: r for r, k in enumerate(sorted({f[1:3] for f in found if f}))}
        total = [f and (f[0], order[f[1:3]]) for f in found]
        between.append(via)
    return total, between


def _entries(costs: list, ranks: list) -> list:
    return [None if c is None else (c, r) for c, r in zip(costs, ranks, strict=True)]


_NODE = {"idx": "bigint", "costs": "array<bigint>", "ranks": "array<int>"}
_PATH = {"idx": "bigint", "start": "bigint", "stop": "bigint"}


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns conv, idx, parts (up to FAN matrices in order): their product."""
    for batch in batches:
        out = []
        for conv, idx, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            total, _ = _fold([_entries(p["costs"], p["ranks"]) for p in parts])
            out.append((conv, idx, [x and x[0] for x in total], [x and x[1] for x in total]))
        if out:
            yield _batch(batch.schema.field(0).type, _NODE, out)


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns conv, parts, start, stop: between which states each part leads."""
    for batch in batches:
        out = []
        for conv, parts, start, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            _, between = _fold([_entries(p["costs"], p["ranks"]) for p in parts])
            to = stop
            for part, via in zip(reversed(parts[1:]), reversed(between), strict=True):
                middle = via[start * STATES + to]
                out.append((conv, part["idx"], middle, to))
                to = middle
            out.append((conv, parts[0]["idx"], start, to))
        if out:
            yield _batch(batch.schema.field(0).type, _PATH, out)


def _paths(nodes: DataFrame, stage: Stage, fan: int) -> DataFrame:
    """Between which states each stretch leads and how many turns are inserted after it: conv, idx, start, stop, added.

    nodes: conv, idx (0, 1, ... within a conversation), costs, ranks. The product goes up a tree, the choice comes down.
    """
    kind = nodes.schema["conv"].dataType.simpleString()
    levels = [nodes]
    while (levels[-1].agg(F.max("idx").alias("m")).first().m or 0) > 0:
        grouped = levels[-1].groupBy("conv", F.expr(f"idx div {fan}").alias("up")).agg(F.sort_array(F.collect_list(F.struct("idx", "costs", "ranks"))).alias("parts"))
        levels.append(stage.write(grouped.select("conv", F.col("up").alias("idx"), "parts").mapInArrow(_merge, _ddl(kind, _NODE)), f"turns-level-{len(levels)}"))

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, idx, costs, ranks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                stop, added, _ = finish(_entries(costs, ranks)[:STATES])
                out.append((conv, idx, 0, stop, added))
            if out:
                yield _batch(batch.schema.field(0).type, {**_PATH, "added": "bigint"}, out)

    top = stage.write(levels[-1].select("conv", "idx", "costs", "ranks").mapInArrow(ended, _ddl(kind, {**_PATH, "added": "bigint"})), "turns-ends")
    paths = top.drop("added")
    for k in range(len(levels) - 1, 0, -1):
        grouped = levels[k - 1].groupBy("conv", F.expr(f"idx div {fan}").alias("up")).agg(F.sort_array(F.collect_list(F.struct("idx", "costs", "ranks"))).alias("parts"))
        above = paths.select(F.col("conv").alias("c"), F.col("idx").alias("up"), "start", "stop")
        joined = grouped.join(above, F.col("conv").eqNullSafe(F.col("c")) & (grouped["up"] == above["up"]))
        paths = stage.write(joined.select("conv", "parts", "start", "stop").mapInArrow(_descend, _ddl(kind, _PATH)), f"turns-path-{k}")
    last = nodes.groupBy("conv").agg(F.max("idx").alias("idx"))
    added = last.join(top.select(F.col("conv").alias("c"), "added"), F.col("conv").eqNullSafe(F.col("c"))).select(F.col("conv").alias("c"), F.col("idx").alias("i"), "added")
    out = paths.join(added, F.col("conv").eqNullSafe(F.col("c")) & (F.col("idx") == F.col("i")), "left")
    return out.select("conv", "idx", "start", "stop", F.coalesce("added", F.lit(0)).alias("added"))


def _written(grammar) -> Callable:
    """Stretches with start, stop, added (null: the conversation is this stretch) as pieces of the repaired conversation."""
    known = list(_STRETCH)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = grammar.value
        for batch in batches:
            out = []
            for conv, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row, (state, stop, added) = dict(zip(known, rest, strict=False)), rest[len(known) :]
                symbols, audit = row["symbols"], ""
                if symbols:
                    matrix = shared.evaluate(symbols)
                    if state is None:
                        state = 0
                        stop, added, _ = finish([x and (x[0], written(x[1])) for x in matrix[:STATES]])
                    audit = written(matrix[state * STATES + stop][1]) + "I" * added
                cost = sum(_COSTS[e] for e in audit)
                at, text, turns = -1, 0, []
                for e in audit:
                    if e != "I":
                        at += 1
                        gone = symbols[at] == DROP
                        if e != "D":
                            cost += TRUNCATED * symbols[at].isupper()
                        text += not gone
                    if e != "D":
                        role = "assistant" if state == 2 else "user"
                        if e == "K":
                            role = row["roles"][text - 1]
                        turns.append({"role": role, "text": "" if e == "I" else row["texts"][text - 1]})
                        state = {"s": 1, "u": 2, "a": 3}[role[0]]
                out.append((conv, row["at"], row["whole"], *[row[c] for c in _FACTS], cost, audit, turns))
            if out:
                yield _batch(batch.schema.field(0).type, _PIECE, out)

    return pieces


def repair_conversations(rows: DataFrame, dropped: Column | None = None, copies: Column | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", stretch: int | None = None, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """A report on each conversation and the repaired turns.

    The report has the conversation's id under its own name, gaps, blank, duplicate, truncated, illegal, cost and audit:
    one letter for each edit (keep, rerole, delete, insert), of the cheapest edits after which the roles' initials read
    `(s?(ua)+)?`, of equally cheap ones those that come first in ASCII. The turns come as rows of the id, at, whole and turns
    (role, text): a conversation's rows in the order of `at` are its repaired turns, whole says that there is only one.

    Turns are in order of `turn`, nulls first, then of role and text. A turn's first fault counts: blank (no character but
    white space, as the empty text), duplicate (role and text of an earlier turn), truncated (does not end in `.!?`). Null
    roles and texts count as one space, so a null text is blank; a null turn leaves no gap; the rows with a null id are one
    conversation. Repeated rows are turns of their own, the second one a duplicate. `dropped` and `copies` say which rows
    are no turns, though their conversation is reported, and how often a row counts. An empty table gives two empty
    tables; other columns take no part, whatever they are called.

    A conversation of any length and any number of copies is spread over tasks: texts are held a stretch at a time, of
    1,024 turns or a million characters and a turn, a very long text whole. Its audit is one text in the report.
    """
    spark = rows.sparkSession
    stage = Stage(spark)
    times = F.coalesce(copies, F.lit(1)) if copies is not None else F.lit(1)
    times = F.when(dropped, 0).otherwise(times) if dropped is not None else times
    space = F.lit(" ")
    given = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), F.coalesce(role_col, space).alias("role"),
                        F.coalesce(text_col, space).alias("text"), times.cast("bigint").alias("n"))
    kind = given.schema["conv"].dataType.simpleString()
    given = given.select("conv", "turn", F.when(F.col("n") > 0, F.col("role")).otherwise("").alias("role"), F.when(F.col("n") > 0, F.col("text")).otherwise("").alias("text"), "n")
    turns = given.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn("like", F.sha2("text", 256))
    turns = stage.write(turns, "turns")

    # the earliest turn of each role and text; a group may be most of a conversation, so its minimum is partly computed first
    earliest = turns.filter("n > 0").groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("like").alias("l")).agg(F.min(F.struct("turn")).alias("early"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("like") == F.col("l"))
    judged = turns.join(earliest, same, "left").withColumn("is_first", F.col("turn").eqNullSafe(F.col("early.turn")))
    copy = F.explode_outer(F.when(F.col("n") > 0, F.sequence(F.lit(1).cast("bigint"), F.col("n")))).alias("copy")
    single = judged.select("conv", "turn", "role", "text", copy, "is_first").withColumn("first", F.col("is_first") & (F.col("copy") == 1)).drop("is_first")
    single = stage.write(single, "single-turns")
    order = ["conv", "turn", "role", "text", "copy"]
    ordered = single.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())
    stretches = ordered.mapInArrow(_stretches(stretch or STRETCH, STRETCH_BYTES), _ddl(kind, _STRETCH))
    stretches = stage.write(stretches, "stretches")
    stage.release("turns", "single-turns")
    grammar = spark.sparkContext.broadcast(learn(stretches.filter("symbols <> ''"), stage))

    # conversations of several stretches, or whose stretch reaches the edge of a task
    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, at, symbols in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out.append((conv, at, *_ranked(grammar.value.evaluate(symbols))))
            if out:
                yield _batch(batch.schema.field(0).type, {"at": "bigint", **{k: v for k, v in _NODE.items() if k != "idx"}}, out)

    cut = stretches.filter("NOT whole AND symbols <> ''").select("conv", "at", "symbols").mapInArrow(ranked, _ddl(kind, {"at": "bigint", "costs": "array<bigint>", "ranks": "array<int>"}))
    place = (F.row_number().over(Window.partitionBy("conv").orderBy("at")) - 1).cast("bigint")
    nodes = stage.write(cut.withColumn("idx", place), "turns-level-0")
    paths = _paths(nodes.select("conv", "idx", "costs", "ranks"), stage, fan)
    spot = nodes.select(F.col("conv").alias("c"), F.col("idx").alias("i"), F.col("at").alias("spot"))
    paths = paths.join(spot, F.col("conv").eqNullSafe(F.col("c")) & (F.col("idx") == F.col("i"))).select("spot", "start", "stop", "added")
    parted = stretches.filter("NOT whole").join(paths, F.col("at") == F.col("spot"), "left").drop("spot")
    alone = stretches.filter("whole").select("*", *[F.lit(None).cast("bigint").alias(c) for c in ("start", "stop", "added")])
    pieces = stage.write(alone.unionByName(parted).mapInArrow(_written(grammar), _ddl(kind, _PIECE)), "pieces")
    stage.release(*[n for n in stage.paths if n.startswith("turns-")], "stretches")

    # pairs of turns across the ends of stretches
    before = Window.partitionBy("conv").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ends = F.when(F.col("first_role").isNotNull(), F.struct("last_turn", "last_role"))
    narrow = pieces.drop("turns").withColumn("prior", F.last(ends, ignorenulls=True).over(before))
    across = F.col("first_role").isNotNull() & F.col("prior").isNotNull()
    wrong = (across & ~F.concat("prior.last_role", "first_role").isin(*LEGAL)).cast("bigint")
    again = (across & F.coalesce(F.col("prior.last_turn") == F.col("first_turn"), F.lit(False))).cast("bigint")
    total = narrow.withColumns({"illegal": F.col("illegal") + wrong, "n_turns": F.col("n_turns") - again}).groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "n_turns", "cost")], F.min("low_turn").alias("low"), F.max("last_turn").alias("high"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    exact = F.col("high").cast("decimal(38,0)") - F.col("low").cast("decimal(38,0)") + 1 - F.col("n_turns")
    report = total.select(F.col("conv").alias(conv_col), F.coalesce(exact.try_cast("bigint"), F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return report, pieces.select(F.col("conv").alias(conv_col), "at", "whole", "turns")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each conversation's lines, which come sorted: conv, lines (null: none in this piece)."""
    conv, state, lines, kind = None, None, 0, None
    for batch in batches:
        kind, out = batch.schema.field(0).type, []
        for own, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if state is None or own != conv:
                if state is not None:
                    out.append((conv, state.hexdigest()))
                conv, state, lines = own, hashlib.sha256(), 0
            if text is not None:
                state.update(("\n" if lines else "").encode() + text.encode())
                lines += 1
        if out:
            yield _batch(kind, {"digest": "string"}, out)
    if state is not None:
        yield _batch(kind, {"digest": "string"}, [(conv, state.hexdigest())])


def turn_digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's repaired turns, as `role:text` lines: conv, digest.

    A conversation of several pieces is read in order by one task, a piece at a time, since a hash runs from beginning to end.
    """
    conv = turns.columns[0]
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    lines = F.when(F.size("turns") > 0, F.array_join(line, "\n"))
    whole = turns.filter("whole").select(F.col(conv).alias("conv"), F.sha2(F.coalesce(lines, F.lit("")), 256).alias("digest"))
    parts = turns.filter("NOT whole").select(F.col(conv).alias("conv"), "at", lines.alias("lines"))
    parts = parts.repartition("conv").sortWithinPartitions("conv", "at").select("conv", "lines")
    return whole.unionAll(parts.mapInArrow(_digest, whole.schema))


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, Column, Column]:
    """The rows with faults made by a hash of id and turn, with a column each for dropped and for copies.

    Of 20 hash values 0 drops a row, 1 empties its text, 2 removes its ends of sentences, 3 repeats it, 4 makes it the
    user's. Nulls are taken as one space, in the hash as in role and text.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    hit = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce(text_col, space), F.coalesce(role_col, space)
    out = rows.select(
        F.col(conv_col), F.col(turn_col), F.when(hit == 4, "user").otherwise(role).alias(role_col),
        F.when(hit == 1, "").when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias(text_col), hit.alias("_hit"))
    return out, F.col("_hit") == 0, F.when(F.col("_hit") == 3, 2).otherwise(1)


def op12_repair_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of each damaged conversation, the cheapest repair, and a hash of the repaired turns."""
    importable(spark)
    rows, dropped, copies = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    report, turns = repair_conversations(rows, dropped, copies)
    digests = turn_digests(turns)
    joined = report.join(digests, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    return joined.select(*report.columns, F.col("digest").alias("repaired_sha256"))
