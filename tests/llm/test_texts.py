"""Rules, mixing, languages, personal data and language-model scores against plain Python."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from plain_text import WORD, plain_measures
from pyspark.sql import functions as F

from filingloom.llm import pitmanyor
from filingloom.llm.language import SPACE_BITS, fit_languages, kernel, predict_languages, present, train
from filingloom.llm.mixing import mix_sources
from filingloom.llm.pitmanyor import sample_tables, score_texts
from filingloom.llm.privacy import find_private, sanitise
from filingloom.llm.rules import MEASURES, POLICIES, RULES, ablations, kept_by, measure_text, policy_mask, with_ledger

def test_measures():
    rng = random.Random(3)
    texts = [None, "", " \n\t ", "a", "a b", "a a a a", "x y z x y z", "é ü ß\x1c|||\nA\n a\nA"]
    texts += ["".join(rng.choice(["the ", "of ", "ß| ", "\n", "Ab\t", "a b c ", "\n\n"]) for _ in range(rng.randrange(60))) for _ in range(300)]
    for t in texts:
        assert measure_text(t) == plain_measures(t)


def test_ledger_and_policies(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("failures", F.lit("taken")).withColumn("Measures", F.lit(1))
    extra = spark.createDataFrame([(None, None, None, None, None, "x", 1), (5, "", "en", "s", 0, "x", 1)], docs.schema)
    ledger, m, bits = with_ledger(docs.unionByName(extra))
    rows = ledger.select("doc_id", "text", f"{m}.*", F.col(bits).alias("bits")).collect()
    expected = {}
    for r in rows:
        x = dict(zip(MEASURES, plain_measures(r.text), strict=True))
        assert {k: r[k] for k in MEASURES} == x
        fails = [bool(eval(c.replace("OR", "or"), {}, x)) for c in RULES.values()]  # noqa: S307
        assert r.bits == sum(1 << k for k, f in enumerate(fails) if f)
        expected[r.doc_id] = fails
    out = {(r.policy, r.rule): r for r in ablations(ledger, bits).collect()}
    names = list(RULES)
    for policy, own in POLICIES.items():
        masks = [r.bits & policy_mask(own) for r in rows]
        for rule in own:
            bit = 1 << names.index(rule)
            assert (out[policy, rule].rejected, out[policy, rule].failed, out[policy, rule].only_this_rule) == (sum(x != 0 for x in masks), sum(x & bit != 0 for x in masks), sum(x == bit for x in masks))
    kept = kept_by(docs, "v2")
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.bits == 0 for r in rows if r.text)
    assert kept_by(docs.limit(0)).count() == 0


def test_mixing_reaches_the_weights(spark):
    rows = [(i, "x" * (1 + i % 50), "hot" if i % 3 else f"s{i % 7}") for i in range(6000)] + [(None, "no id", "hot"), (9000, None, "void"), (9001, "", "void"), (9002, "one", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copy", F.lit("c")).withColumn("d", F.lit(1))
    weights = {"hot": 1.0, **{f"s{k}": 2.0 for k in range(7)}}
    out, copy, key = mix_sources(docs, weights, budget=300_000)
    got = out.collect()
    assert {"copy", "d"} <= set(out.columns) and copy != "copy"
    chars = Counter()
    for r in got:
        chars[r.source] += len(r.text or "")
    share = {s: n / 300_000 for s, n in chars.items()}
    total = 1 + 7 * 2 + 1  # the null source has the default weight
    assert abs(share["hot"] - 1 / total) < 0.02
    for k in range(7):
        assert abs(share[f"s{k}"] - 2 / total) < 0.03
    counts = Counter((r.doc_id, r.text) for r in got)
    for r in got:
        assert 0 <= r[copy] < counts[r.doc_id, r.text]
    again = mix_sources(docs.repartition(3), weights, budget=300_000)[0]
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, got))
    assert mix_sources(docs.limit(0))[0].count() == 0
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_poisson_draws_have_the_right_spread(spark):
    docs = spark.createDataFrame([(i, "x", "a" if i < 4000 else "b") for i in range(4040)], "doc_id long, text string, source string")
    counts = Counter(r.doc_id for r in mix_sources(docs, {"a": 1.0, "b": 1.0}, budget=16_000)[0].select("doc_id").collect())
    a, b = [counts[i] for i in range(4000)], [counts[i] for i in range(4000, 4040)]
    assert abs(np.mean(a) - 2) < 0.1 and abs(np.var(a) - 2) < 0.2  # mean 2
    assert abs(np.mean(b) - 200) < 8 and 80 < np.var(b) < 400  # mean 200, drawn in parts


def _slots(text):
    """The hashed n-grams of a text, in plain Python."""
    codes = [ord(c) + 1 if c.isalpha() else 1 for c in f" {text.lower()} "]
    out = set()
    for n in (1, 2, 3):
        for i in range(len(codes) - n + 1):
            gram = codes[i : i + n]
            if any(c != 1 for c in gram):
                number = 0
                for c in gram:
                    number = (number << 21) | c
                out.add((number * 0x9E3779B97F4A7C15) % 2**64 >> (64 - SPACE_BITS))
    return out


def _plain_kernel(a, b):
    x, y = _slots(a), _slots(b)
    return len(x & y) / math.sqrt(max(len(x), 1) * max(len(y), 1))


SCRIPTS = [
    ("zh", "\u6211\u4eec\u5728\u8fd9\u91cc\u5b66\u4e60\u6c49\u8bed"), ("zh", "\u4ed6\u4eec\u5728\u90a3\u91cc\u5de5\u4f5c"),
    ("ja", "\u79c1\u305f\u3061\u306f\u3053\u3053\u3067\u52c9\u5f37\u3057\u307e\u3059"), ("ja", "\u5f7c\u306f\u305d\u3053\u3067\u50cd\u304d\u307e\u3059"),
    ("ko", "\uc6b0\ub9ac\ub294 \uc5ec\uae30\uc11c \uacf5\ubd80\ud569\ub2c8\ub2e4"), ("ru", "\u043c\u044b \u0443\u0447\u0438\u043c\u0441\u044f \u0437\u0434\u0435\u0441\u044c"),
    ("en", "We study HERE, 12 of us"), ("el", "\u03b5\u03b4\u03ce \u03bc\u03b1\u03b8\u03b1\u03af\u03bd\u03bf\u03c5\u03bc\u03b5"),
]


@pytest.mark.parametrize("text", ["", " ", "a", "ab c", "1 2 a", "\U0002070e \u6f22", "x" * 5000, *[t for _, t in SCRIPTS]])
def test_present_grams(text):
    assert set(present(text).tolist()) == _slots(text)


def test_regression_against_plain_kernels():
    """Scores equal a ridge regression on the Nystrom features of kernels counted in plain Python."""
    landmarks = [t for lang in sorted({x for x, _ in SCRIPTS}) for t in [t for x, t in SCRIPTS if x == lang][:1]]
    model = train(SCRIPTS, n_landmarks=1)
    k = np.array([[_plain_kernel(a, b) for b in landmarks] for a in landmarks])
    values, vectors = np.linalg.eigh(k)
    half = vectors @ np.diag(values**-0.5)
    x = np.array([[_plain_kernel(t, b) for b in landmarks] for _, t in SCRIPTS]) @ half
    y = np.array([[1.0 if lang == m else -1.0 for m in model.languages] for lang, _ in SCRIPTS])
    w = np.diag([1 / sum(m == lang for m, _ in SCRIPTS) for lang, _ in SCRIPTS])
    beta = np.linalg.solve(x.T @ w @ x + 1e-2 * np.eye(x.shape[1]), x.T @ w @ y)
    assert np.allclose(kernel(model, [t for _, t in SCRIPTS]) @ model.weights, x @ beta, atol=1e-3)


def test_scripts_beyond_the_alphabets(spark):
    docs = spark.createDataFrame([(i, t, lang, "x") for i, (lang, t) in enumerate(SCRIPTS)], "doc_id long, text string, lang string, p string")
    model = fit_languages(docs)
    asked = spark.createDataFrame([(1, "\u5f7c\u3089\u306f\u50cd\u3044\u3066\u3044\u307e\u3059", "ja"), (2, "\u4ed6\u5728\u5b66\u4e60", "zh"), (3, "\ud569\ub2c8\ub2e4", "ko"), (4, "\u0443\u0447\u0438\u043c", "ru")], "p long, Text string, lang_pred string")
    out = asked.select("lang_pred", predict_languages(asked, model).alias("got")).select("lang_pred", F.col("got.lang_pred").alias("found")).collect()
    assert [r.found for r in out] == [r.lang_pred for r in out]
    assert "en" not in fit_languages(docs, longest=22).languages and "en" in fit_languages(docs, longest=23).languages


def test_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = fit_languages(docs.filter(~held), per_language=40, n_landmarks=8)
    odd = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "123 !?", "en"), (4, "中文", None), (5, "the and of " * 20_000, "en"), (None, "the of and with", "x")], docs.schema)
    out = docs.filter(held).unionByName(odd).withColumn("p", predict_languages(docs, model)).select("*", "p.*").collect()
    given = [r for r in out if r.doc_id is not None and r.text and len(r.text) < 100_000 and r.lang and r.doc_id > 5]
    assert np.mean([r.lang == r.lang_pred for r in given]) >= 0.97
    assert all(0 <= r.score <= 1 for r in out)
    assert [r.lang_pred for r in out if r.lang == "en" and (not r.text or r.text == "123 !?")] == ["und"] * 3
    assert {r.lang_pred for r in out if r.text and r.text != "123 !?"} <= set(model.languages)
    copies = spark.createDataFrame([(1, "the same words", "en")] * 60 + [(2, "le la de et", "fr")] * 3, docs.schema)
    assert fit_languages(copies, per_language=2).languages == ["en", "fr"]
    none = fit_languages(docs.limit(0))
    assert {r.p.lang_pred for r in docs.limit(3).select(predict_languages(docs, none).alias("p")).collect()} == {"und"}
    assert train([]).languages == []


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in enumerate(PLAIN.values()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = [True, all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True, 13 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15][kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return sorted(out)


def test_base_spans(spark, sf_dir):
    rng = random.Random(6)
    bits = ["a.b@c.de", "@", ".", "x_", "10.0.0.1", "255.256.1.1", "000001.2.3.4", "1.2.3.4.5.6.7.8", "+", "+49 (0)30 123456", "4111 1111 1111 1111", "4111-1111-1111-1112", "-", " ", "  ", "\n", "é", "\U0001f600", "12", "0", "7" * 25, "%", "joe", "+1.212.555.0100"]
    texts = [None, "", "1" * 30_000, "a" * 30_000, "1 " * 20_000, "a.b@" * 5_000, "+1" * 9_000, "1." * 9_000, "a@b.c" * 4_000]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randrange(25))) for _ in range(1500)]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    found = find_private(docs)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    for r in found.collect():
        assert sorted(tuple(s) for s in r.spans if s.kind < 4) == base_spans(texts[r.doc_id]), texts[r.doc_id][:300]


def test_words_that_disclose(spark):
    filler = [f"common words everywhere number{k % 7} plain text" for k in range(200)]
    rows = [(1, "write to Quentin Zarathust at q.z@example.org for common things"), (2, "again Zarathust, q.z@example.org common text"), (3, "plain a.b@example.org words"),
            (4, "common words c.d@example.org plain"), (5, "text about Zarathust alone"), (6, None), (None, "q.z@example.org Zarathust")]
    rows += [(100 + i, t) for i, t in enumerate(filler)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    spans = {r.doc_id: [(s.kind, rows[[x[0] for x in rows].index(r.doc_id)][1][s.start : s.end]) for s in r.spans if s.kind >= 4] for r in find_private(docs).collect() if r.doc_id != 6}
    assert [w for _, w in spans[1]] == ["Zarathust"] and [w for _, w in spans[2]] == ["Zarathust"] and [w for _, w in spans[None]] == ["Zarathust"]
    assert not spans[3] and not spans[4] and not spans[5] and not any(spans[100 + i] for i in range(200))
    clean = {r.doc_id: r.text for r in sanitise(docs, remove=1.5).collect()}
    assert clean[1] == "write to Quentin [NAME] at [EMAIL] for common things" and clean[6] is None and clean[5] == rows[4][1]
    assert sanitise(docs.limit(0)).count() == 0 and sanitise(docs).columns == docs.columns
    overlap = spark.createDataFrame([(1, "call +4111 1111 1111 1111 now \U0001f600 1.2.3.4")], "doc_id long, text string")
    assert sanitise(overlap).first().text == "call [PHONE][CARD] now \U0001f600 [IP]" or "1111" not in sanitise(overlap).first().text


def test_sanitised_texts_stay_with_their_rows(spark):
    """After a shuffle, with a wide further column that find_private does not read, which changes how partitions are merged."""
    rows = [(i, f"row {i} of many, write to user{i}@example.org now", "x" * 400) for i in range(1_500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, wide string").repartition(40, "doc_id")
    got = {r.doc_id: r.text for r in sanitise(docs, generalise=2.0, remove=2.0).collect()}
    assert got == {i: f"row {i} of many, write to [EMAIL] now" for i in range(1_500)}


def test_words_that_disclose_are_found_anywhere(spark):
    """Far from the entity, at every place, in quotes, short or with digits, and for an entity of one document."""
    far = "common words everywhere plain text " * 20
    text = f"Zarathust ({far}) 'Qu7-x' a.b@example.org {far} \"Zarathust\" Ono example"
    rows = [(1, text), (2, "Zarathust without one"), (3, "example of others")] + [(100 + i, f"{far} example ono") for i in range(200)]
    found = {r.doc_id: [(s.kind, rows[0][1][s.start : s.end]) for s in r.spans] for r in find_private(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    share = lambda n_t: 1 - math.log(n_t) / math.log(len(rows))
    assert share(2) < 0.9 < share(1) and share(201) < 0.6
    assert found.pop(1) == [(0, "a.b@example.org"), (4, "Zarathust"), (4, "Zarathust"), (5, "Qu7-x")]
    assert not any(found.values())


def is_train(i):
    return zlib.crc32(str(i).encode()) % 7 != 2


@pytest.mark.parametrize("small", [False, True])
def test_scores(spark, sf_dir, monkeypatch, small):
    if small:  # several buckets and groups, and many words that count as hot
        monkeypatch.setattr(pitmanyor, "BUCKET_TOKENS", 9_000)
        monkeypatch.setattr(pitmanyor, "GROUP_TOKENS", 5_000)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(9001, None), (9002, ""), (9003, "Zzyzx unknown qqqqq"), (None, "the of"), (rows[0][0], rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2).collect()
    tokens = lambda t: [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(t or "")] + [None]
    count = Counter(w for i, t in rows if i is not None and is_train(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    texts = {i: t for i, t in rows}
    assert len(got) == len(rows)
    for r in got:
        own = tokens(texts[r.doc_id])
        assert r.held_out == (r.doc_id is None or not is_train(r.doc_id))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(w in count for w in own), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9, abs_tol=1e-9)
        assert r.score < 0
    held = [r for r in got if r.held_out and r.doc_id is not None]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert score_texts(docs.limit(0), F.lit(True)).count() == 0
    assert score_texts(docs.limit(2), F.lit(False)).filter("base_score <> 0").count() == 0


def test_each_context_has_its_own_restaurant(spark):
    """Two words whose hashes agree in the 16 bits that once chose a restaurant; what follows them is told apart all the same."""
    seen, pair = {}, None
    for k in range(5_000):
        word = f"w{k}"
        short = (pitmanyor._word(word.encode()) * 0x9E3779B97F4A7C15 & (2**64 - 1)) >> 48
        if short in seen:
            pair = (seen[short], word)
            break
        seen[short] = word
    rows = [(i, f"{pair[i % 2]} {'ab'[i % 2]}", True) for i in range(2_000)] + [(5_000, f"{pair[0]} a", False), (5_001, f"{pair[1]} a", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(3)
    score = {r.doc_id: r.score for r in score_texts(docs, F.col("train")).filter("doc_id >= 5000").collect()}
    assert -0.32 < score[5_000] < -0.29  # a half for the first word; then it is nearly certain
    assert score[5_001] < -2


def test_no_bucket_grows_with_the_number_of_texts(spark, tmp_path, monkeypatch):
    """The end is dealt by context like other hot words, and a pair that stands in every text is one entry a group."""
    monkeypatch.setattr(pitmanyor, "BUCKET_TOKENS", 1_000)
    docs = spark.createDataFrame([(i, f"common last{i}", True) for i in range(4_000)], "doc_id long, text string, train boolean").repartition(2)
    hot, total = pitmanyor._hot_words(docs.select("text"))
    assert total == 12_000 and pitmanyor._END in hot
    rows = docs.mapInArrow(pitmanyor._gather(hot, 12, f"file://{tmp_path}"), pitmanyor._ROW).filter("bucket >= 0").collect()
    ends, common = Counter(), []
    for r in rows:
        sent = pitmanyor._unpack(bytes(r.data))
        word = np.repeat(sent["words"], sent["runs"])
        ends[r.bucket] += int((word == pitmanyor._END).sum())
        common += sent["cnt"][word == pitmanyor._word(b"common")].tolist()
    assert sum(ends.values()) == 4_000 and max(ends.values()) < 600
    assert len(common) == 2 and sum(common) == 4_000


def test_seating_has_the_right_mean():
    """A dish alone in its restaurant, with p = 1: the mean number of tables of the two-parameter process."""
    rng = np.random.default_rng(0)
    for c in (2, 5, 30, 200):
        discount, strength = 0.5, 1.0
        t = sample_tables(np.full(20_000, c), np.ones(20_000), np.zeros(20_000), discount, strength, rng)
        mean = strength / discount * (math.exp(math.lgamma(strength + discount + c) + math.lgamma(strength) - math.lgamma(strength + c) - math.lgamma(strength + discount)) - 1)
        assert abs(t.mean() - mean) < 0.03 * mean + 0.02
