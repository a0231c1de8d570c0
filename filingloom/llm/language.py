"""Language identification by string kernels.

The kernel of two texts is the number of character n-grams, of several lengths, that are present in both,
divided by the root of the numbers in each (a blended spectrum presence kernel). Landmark texts give the
Nystrom features, and a kernel ridge regression of one language versus the rest is solved on them. As the kernel
is an inner product of presence vectors, a batch is scored by two matrix products: presence by landmarks,
landmarks by languages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingloom.llm.common import documents, importable

UNDETERMINED = "und"
SPACE_BITS = 19  # n-grams of code points are hashed to so many bits
_LETTER = re.compile(r"[^\W\d_]")
_BATCH = 64
_MIX = np.uint64(0x9E3779B97F4A7C15)


@cache
def _codes() -> np.ndarray:
    """A number for each code point: its own plus one for letters of any script, 1 for everything else."""
    return np.array([c + 1 if chr(c).isalpha() else 1 for c in range(0x110000)], np.uint64)


def present(text: str) -> np.ndarray:
    """The slots of the n-grams, for n from 1 to 3, that a text has, lower-cased, between two white spaces.

    Three code points fit into 63 bits, so each n-gram has a number of its own, which a multiplication then hashes to the
    fixed space; only there may two share a slot. N-grams without a letter don't count.
    """
    one = _codes()[np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
    seen = np.zeros(1 << SPACE_BITS, bool)
    shift, grams, blank = np.uint64(21), one, np.uint64(1)
    for n in range(3):
        if n:
            grams = (grams[:-1] << shift) | one[n:]
            blank = (blank << shift) | np.uint64(1)
        seen[(grams[grams != blank] * _MIX) >> np.uint64(64 - SPACE_BITS)] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    """grams: sorted slots of the landmarks' n-grams; landmarks: their presence, each divided by its root; weights: per language."""

    languages: list[str]
    grams: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray


def kernel(model: Model, texts: list[str]) -> np.ndarray:
    """The kernel of some texts with all landmarks."""
    place = np.full(1 << SPACE_BITS, -1, np.int32)
    place[model.grams] = np.arange(len(model.grams), dtype=np.int32)
    out = np.zeros((len(texts), len(model.landmarks)), np.float32)
    for cut in range(0, len(texts), _BATCH):
        part = texts[cut : cut + _BATCH]
        presence = np.zeros((len(part), len(model.grams)), np.float32)
        for i, text in enumerate(part):
            own = present(text)
            at = place[own]
            presence[i, at[at >= 0]] = 1 / np.sqrt(max(len(own), 1))
        out[cut : cut + len(part)] = presence @ model.landmarks.T
    return out


def train(rows: list[tuple[str, str]], n_landmarks: int = 40, ridge: float = 1e-2) -> Model:
    """Fit on (language, text) rows; the first n_landmarks rows of each language are the landmarks.

    Nystrom: with K the kernel of the landmarks and C that of the rows with them, the features are C K^(-1/2); the ridge
    regression on them has targets of 1 for the language and -1 for the rest, each language weighing the same.
    """
    languages = sorted({lang for lang, _ in rows})
    chosen = [t for lang in languages for t in [t for x, t in rows if x == lang][:n_landmarks]]
    slots = [present(t) for t in chosen]
    grams = np.unique(np.concatenate([np.zeros(0, np.int64), *slots]))
    landmarks = np.zeros((len(chosen), len(grams)), np.float32)
    for i, own in enumerate(slots):
        landmarks[i, np.searchsorted(grams, own)] = 1 / np.sqrt(max(len(own), 1))
    model = Model(languages, grams, landmarks, np.zeros((len(chosen), len(languages)), np.float32))
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(float))
    good = values > 1e-6 * max(values.max(initial=0.0), 1e-12)
    half = vectors[:, good] / np.sqrt(values[good])
    features = kernel(model, [t for _, t in rows]).astype(float) @ half
    target = np.array([[1.0 if lang == x else -1.0 for x in languages] for lang, _ in rows]).reshape(len(rows), len(languages))
    share = np.array([1 / sum(x == lang for x, _ in rows) for lang, _ in rows])
    gram = features.T @ (features * share[:, None]) + ridge * np.eye(features.shape[1])
    model.weights = (half @ np.linalg.solve(gram, features.T @ (target * share[:, None]))).astype(np.float32) if rows else model.weights
    return model


def fit_languages(docs: DataFrame, per_language: int = 250, n_landmarks: int = 40, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", longest: int = 100_000) -> Model:
    """Fit on a sample of at most per_language rows for each language, the same in any run: those whose id and text hash lowest.

    Rows without a language, or whose text is null, has no letter or has more than `longest` characters, are left out, so what
    comes to the driver is at most per_language * longest characters a language; texts of any length are predicted. An empty
    table gives a model without languages. Only the three named columns are read, whatever others there are. The languages are counted first, and only rows
    with a hash so low that about eight times the sample passes are looked at further, so the same amount of text moves
    at any size of the input. A language that then has too few, as when its rows repeat, is drawn from all its rows.
    """
    share = F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 53)) / F.lit(float(1 << 53))
    some = docs.filter(F.col(lang_col).isNotNull() & (F.length(text_col) <= longest) & F.col(text_col).rlike(r"\p{L}")).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), share.alias("h"))
    counts = {r.lang: r.n for r in some.groupBy("lang").agg(F.count("*").alias("n")).collect()}

    def lowest(limits: dict[str, float]) -> list[tuple]:
        table = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])
        low = some.filter(F.col("h") < F.try_element_at(table, F.col("lang")))
        picked = low.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))).filter(F.col("r") <= per_language)
        return [(r.lang, r.h, r.text) for r in picked.collect()]

    rows = lowest({lang: 8 * per_language / n for lang, n in counts.items()}) if counts else []
    found = [lang for lang, _, _ in rows]
    short = {lang: 2.0 for lang, n in counts.items() if found.count(lang) < min(n, per_language)}
    if short:
        rows = [r for r in rows if r[0] not in short] + lowest(short)
    rows.sort()
    return train([(lang, text) for lang, _, text in rows], n_landmarks)


def predict_languages(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """A struct of lang_pred and score for each row's text.

    lang_pred is the language with the highest regression value, the first in order on a tie; score is its share in a
    softmax of the values. A text that is null or has no letter, or a model without languages, gives "und" and 0. Whole texts
    of any length count; a very long one takes memory in proportion to its length, and equal texts get equal results.
    """
    importable(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        for batch in batches:
            langs, scores = [UNDETERMINED] * len(batch), np.zeros(len(batch))
            at, texts = [], []

            def flush(at=at, texts=texts, langs=langs, scores=scores) -> None:
                values = 4 * (kernel(model, texts) @ model.weights).astype(float)
                share = np.exp(values - values.max(axis=1, keepdims=True))
                share /= share.sum(axis=1, keepdims=True)
                for i, row in zip(at, share, strict=True):
                    langs[i], scores[i] = model.languages[int(row.argmax())], float(row.max())
                at.clear()
                texts.clear()

            for i, text in enumerate(batch):
                whole = text.as_py()
                if whole and model.languages and _LETTER.search(whole):
                    at.append(i)
                    texts.append(whole)
                    if len(at) == _BATCH:
                        flush()
            if at:
                flush()
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores)], names=["lang_pred", "score"])

    return predicted(F.col(text_col))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    model = fit_languages(docs.filter(~held_out))
    predicted = docs.select("doc_id", held_out.alias("held_out"), predict_languages(docs, model).alias("p"))
    return predicted.select("doc_id", "held_out", "p.lang_pred", "p.score")
