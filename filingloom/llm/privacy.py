"""Personal data, and the words that give it away, in built-in expressions only.

Patterns find the protected entities: e-mail and IP addresses, card and phone numbers. How much a word in a document
with one discloses is estimated from the whole corpus: with N documents, n(e) that hold entity e, n(t) that hold word t and
n(e,t) that hold both, the pointwise mutual information is log(N n(e,t) / (n(e) n(t))), and its share of
the information content log(N / n(e)) is what a reader of t learns of e. Words above one threshold are
generalised and above another removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingloom.llm.common import Stage, documents, free_name

# Each pattern finds the same matches as its plain form, but never tries a start that must fail, and never backtracks
# over a repeated group, so that long runs of the same characters stay cheap.
KINDS: dict[str, str] = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NAMES = list(KINDS)
TERM = r"[\p{L}\p{M}\p{N}]++(?:[-'\u2019][\p{L}\p{M}\p{N}]++)*+"
MANY_DIGITS = r"(?<![0-9])[0-9](?:[\x20-]?+[0-9]){12}"  # in every card number
_HIT = "struct<kind:int,i:int,gap:bigint,size:bigint,value:string>"


def _hits(text: Column, kind: int) -> Column:
    """All matches of a kind, each with the length of the text since the one before."""
    pattern = F.lit(list(KINDS.values())[kind])
    found, gaps = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, list(KINDS.values())[kind], -1)
    zipped = F.arrays_zip(found.alias("m"), F.slice(gaps, F.lit(1), F.size(found)).alias("g"))
    hit = lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.cast("int").alias("i"), F.length(x["g"]).cast("bigint").alias("gap"), F.length(x["m"]).cast("bigint").alias("size"), x["m"].alias("value"))
    return F.when(text.rlike(list(KINDS.values())[kind]), F.transform(zipped, hit)).otherwise(F.array().cast(f"array<{_HIT}>"))


def _valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    parts = F.split(value, r"\.")
    low = lambda p: F.regexp_replace(p, "^0+", "")
    ip = F.forall(parts, lambda p: (F.length(low(p)) <= 3) & (F.coalesce(F.when(F.length(low(p)) <= 3, low(p).try_cast("int")), F.lit(0)) <= 255))
    places = F.sequence(F.lit(1), F.least(n, F.lit(19)))
    digit = lambda i: F.substring(digits, n - i + 1, F.lit(1)).cast("int")
    luhn = F.aggregate(places, F.lit(0), lambda s, i: s + F.when(i % 2 == 1, digit(i)).otherwise(digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0)))
    return (F.when(kind == NAMES.index("ip"), ip).when(kind == NAMES.index("card"), n.between(13, 19) & (luhn % 10 == 0))
            .when(kind == NAMES.index("phone"), n.between(9, 15)).otherwise(True))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def _words(held: DataFrame, base: DataFrame) -> DataFrame:
    """row, term, start and end of all words that share no character with an entity."""
    text = F.col("text")
    found, gaps = F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.split(text, TERM, -1)
    zipped = F.arrays_zip(found.alias("m"), F.slice(gaps, F.lit(1), F.size(found)).alias("g"))
    size = lambda x: F.struct(F.lower(x["m"]).alias("term"), F.length(x["m"]).cast("bigint").alias("size"), F.length(x["g"]).cast("bigint").alias("gap"))
    words = held.select("row", F.posexplode(F.transform(zipped, size)).alias("i", "w")).select("row", "i", "w.*")
    words = words.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("row").orderBy("i"))).withColumn("start", F.col("end") - F.col("size"))
    both = words.select("row", "term", "start", "end").unionByName(base.select("row", F.lit(None).cast("string").alias("term"), "start", "end"))
    so_far = lambda *order: Window.partitionBy("row").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    entity = F.col("term").isNull()
    both = both.withColumn("before", F.max(F.when(entity, F.col("end"))).over(so_far(F.col("start"), F.col("term").isNotNull())))
    both = both.withColumn("after", F.min(F.when(entity, F.col("start"))).over(so_far(F.col("start").desc(), F.col("term").isNotNull())))
    free = (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.coalesce("after", F.col("end")) >= F.col("end"))
    return both.filter(~entity & free).select("row", "term", "start", "end")


def find_private(docs: DataFrame, generalise: float = 0.6, remove: float = 0.9, support: int = 2, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Per row: row (a number of the row), doc_id and spans, sorted by kind and place; columns row, doc_id, text, spans.

    A span has kind (0 to 3 as listed in KINDS; 4: word to generalise, 5: word to remove), start and end in code points.
    Words are runs of letters and digits, with single hyphens or apostrophes inside, that share no character with an entity; all
    in a document with an entity count, and every place of a word that discloses one is marked. A word must be in at least
    support documents with an entity that is in so many; for an entity in fewer, in all of them. generalise, remove: least
    share of an entity's information that a word discloses. A word in a document counts with the entities of that document
    only. A null or empty text has no spans. Each row counts as a document of its own, whatever its id. row_col: a column
    that numbers the rows already.
    """
    stage = Stage(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    maybe = text.rlike(MANY_DIGITS)
    for name in ("email", "ip", "phone"):
        maybe = maybe | text.rlike(KINDS[name])
    all_hits = F.concat(*[_hits(text, k) for k in range(len(NAMES))])
    number = F.col(row_col) if row_col else F.monotonically_increasing_id()
    found = docs.select(number.alias("row"), F.col(id_col).alias("doc_id"), F.when(maybe, text).alias("text"), all_hits.alias("hits"))
    found = stage.write(found, "private-hits")
    total = float(max(found.count(), 1))
    hits = found.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    before = Window.partitionBy("row", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("size")).over(before)
    base = hits.withColumn("end", end).withColumn("start", F.col("end") - F.col("size")).filter(_valid(F.col("kind"), F.col("value")))
    value = F.when(F.col("kind") == 0, F.lower("value")).when(F.col("kind") == 1, F.col("value")).otherwise(F.regexp_replace("value", "[^0-9]", ""))
    base = stage.write(base.withColumn("entity", F.sha2(F.concat_ws(":", "kind", value), 256)).select("row", "kind", "start", "end", "entity"), "private-base")
    words = stage.write(_words(found.filter("text IS NOT NULL"), base), "private-words")

    held = base.select("row", "entity").distinct()
    entities = held.groupBy("entity").agg(F.count("*").alias("n_e")).withColumn("e", F.monotonically_increasing_id())
    held = stage.write(held.join(stage.write(entities, "private-entities"), "entity").select("row", "e", "n_e"), "private-held")
    own = words.select("row", "term").distinct()
    # of texts that may hold an entity only the words outside of entities count
    inside = found.filter("text IS NOT NULL").select(F.explode(_terms(F.col("text"))).alias("term"), F.lit(-1).alias("n"))
    everywhere = docs.select(F.explode(_terms(text)).alias("term"), F.lit(1).alias("n")).unionByName(inside).unionByName(own.select("term", F.lit(1).alias("n")))
    terms = everywhere.groupBy("term").agg(F.sum("n").alias("n_t")).join(words.select("term").distinct(), "term", "left_semi")
    own = stage.write(own.join(terms, "term").select("row", "term", "n_t"), "private-own")

    content = F.log(F.lit(total) / F.col("n_e"))
    share = F.when(content > 0, 1 + F.log(F.least(F.col("n_et") / F.col("n_t"), F.lit(1.0))) / content).otherwise(0.0)
    # an entity of one document has each of its words once, so all such entities of a document make one
    once = own.join(held.filter("n_e = 1").select("row").distinct(), "row").withColumns({"n_e": F.lit(1), "n_et": F.lit(1)})
    once = once.select("row", "term", share.alias("share")).filter(F.col("share") >= generalise)
    # no word in more documents than that can reach the share, even if it is in all documents with the entity
    most = F.col("n_e") * F.pow(F.lit(total) / F.col("n_e"), F.lit(1.0 - generalise)) * (1 + 1e-9)
    pairs = stage.write(held.filter("n_e > 1").join(own, "row").filter(F.col("n_t") <= most), "private-pairs")
    together = pairs.groupBy("e", "term").agg(F.count("*").alias("n_et"), F.max("n_e").alias("n_e"), F.max("n_t").alias("n_t"))
    together = together.filter(F.col("n_et") >= F.least(F.lit(support), F.col("n_e")))
    telling = stage.write(together.withColumn("share", share).filter(F.col("share") >= generalise).select("e", "term", "share"), "private-telling")
    marked = pairs.join(telling, ["e", "term"]).select("row", "term", "share").unionByName(once).groupBy("row", "term").agg(F.max("share").alias("share"))
    added = words.join(marked, ["row", "term"]).select("row", F.when(F.col("share") >= remove, 5).otherwise(4).alias("kind"), "start", "end")
    spans = base.select("row", "kind", "start", "end").unionByName(added).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("spans"))
    empty = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return found.select("row", "doc_id").join(spans, "row", "left").select("row", "doc_id", F.coalesce("spans", empty).alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """Documents with entities replaced by their kind in brackets, words generalised to theirs, and the words to remove taken out.

    A word is generalised to [NUMBER], [CODE] (letters and digits), [ACRONYM] (capitals), [NAME] (a capital first) or [WORD].
    Columns stay as they are, but for the text; a null text stays null. Overlapping spans are replaced from left to right,
    each from where the one before ends. The rows are numbered once and written, so that spans and texts belong together
    however the input is split.
    """
    row, spans = free_name(docs, "private_row"), free_name(docs, "private_spans")
    numbered = Stage(docs.sparkSession).write(docs.withColumn(row, F.monotonically_increasing_id()), "private-rows")
    found = find_private(numbered, id_col=id_col, text_col=text_col, row_col=row, **thresholds)
    joined = numbered.join(found.select(F.col("row").alias(row), F.col("spans").alias(spans)), row, "left")
    text = F.col(text_col)

    def tag(s: Column) -> Column:
        word = F.substring(text, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))
        shape = (
            F.when(word.rlike(r"^[\p{N}'\u2019-]+$"), "[NUMBER]").when(word.rlike(r"\p{N}"), "[CODE]").when(word.rlike(r"^[\p{Lu}'\u2019-]{2,}$"), "[ACRONYM]")
            .when(word.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
        )
        known = F.array(*[F.lit(f"[{n.upper()}]") for n in NAMES])
        return F.when(s["kind"] < len(NAMES), F.get(known, s["kind"])).when(s["kind"] == len(NAMES), shape).otherwise("")

    step = lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["end"] > acc["at"], F.concat(acc["out"], F.substring(text, acc["at"].cast("int") + 1, F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int")), tag(s))).otherwise(acc["out"]).alias("out"))
    by_place = F.array_sort(F.transform(F.col(spans), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(by_place, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"].cast("int") + 1, F.length(text))))
    clean = F.when(F.size(spans) > 0, clean).otherwise(text)
    return joined.select(*[clean.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def op6_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of personal data in every document, with the words that disclose it."""
    found = find_private(documents(spark, sf_dir).select("doc_id", "text"))
    names = F.array(*[F.lit(n) for n in [*NAMES, "word", "telling"]])
    listed = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")
    return found.select("doc_id", *[count(k).alias(f"n_{n}") for k, n in enumerate(NAMES)],
                        F.sha2(listed(F.filter("spans", lambda s: s["kind"] < len(NAMES))), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
