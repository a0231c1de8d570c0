import functools
import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from filingloom.llm.common import Stage
from filingloom.llm.crc32c import crc32c, masked
from filingloom.llm.packing import best_fit, bin_number, pack_documents
from filingloom.llm.records import _unframe, frame, read_back, read_record, write_records
from filingloom.llm.tokens import TextEncoder, encoder


def encoder_path(name):
    import public_tokenizers

    return public_tokenizers.path(name)


KINDS = [("byte_bpe_50k.json", "bytes"), ("word_bpe_49k.json", "words")]
TRICKY = st.text(alphabet=st.sampled_from(list("aZé ñß\n\n\t\r  .,'s!0123中  \x1ćΣ<|>e")), max_size=60)


@functools.cache
def fresh(name):
    """The tokenizer as its file has it, with nothing set by the library under test."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(encoder_path(name))


def whole(name, kind, text):
    return fresh(name).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("name", "kind"), KINDS)
def test_added_tokens_inside_a_text(name, kind):
    added = [t.content for t in fresh(name).get_added_tokens_decoder().values()]
    assert added
    for token in added:
        for text in (token, f"a {token} b", f"one{token}two", f"line\n{token}\n", f"{token} {token.upper()}  x"):
            (ids,) = encoder(name, kind).encode_many([text])
            assert np.frombuffer(ids, "<u4").tolist() == whole(name, kind, text), text


def test_bin_numbers_do_not_meet():
    numbers = [bin_number(r, t, m) for r in (1, 2, 31) for t in (0, 1, 2**22 - 1) for m in (0, 255 << 24, 300 << 24, 2**35)]
    assert len(set(numbers)) == len(numbers) and max(numbers) < 2**63
    for bad in ((32, 0, 0), (1, 2**22, 0), (1, 0, 2**36)):
        with pytest.raises(OverflowError):
            bin_number(*bad)


@pytest.mark.parametrize(("name", "kind"), KINDS)
def test_parts_give_the_ids_of_the_whole_text(name, kind):
    @settings(max_examples=600, deadline=None)
    @given(TRICKY)
    def check(text):
        (ids,) = encoder(name, kind).encode_many([text])
        assert np.frombuffer(ids, "<u4").tolist() == whole(name, kind, text)

    check()


def test_marks_and_line_ends_are_parts_of_their_own():
    """A word counts once in the memory, with whatever marks and lines after it."""
    enc = TextEncoder(encoder_path("byte_bpe_50k.json"), "bytes")
    words = ["apple", "éclair", "straße", "zebra"]
    text = " ".join(f"{w} {w}, {w}. {w}.\n{w}\n{v}, x" for w in words for v in words)
    (ids,) = enc.encode_many([text])
    assert np.frombuffer(ids, "<u4").tolist() == whole("byte_bpe_50k.json", "bytes", text)
    assert len(enc.words.new) <= 3 + len(words) * 2 + 1, sorted(enc.words.new)


def test_texts_of_marks_lines_and_the_sign_of_a_cut():
    enc = TextEncoder(encoder_path("byte_bpe_50k.json"), "bytes")

    @settings(max_examples=1500, deadline=None)
    @given(st.lists(st.text(alphabet=st.sampled_from(list("ab²½é5_,,..'!\n\n  \x01\t\u0301")), max_size=40), max_size=4))
    def check(texts):
        for text, ids in zip(texts, enc.encode_many(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole("byte_bpe_50k.json", "bytes", text)

    check()


@pytest.mark.parametrize(("name", "kind"), KINDS)
def test_ids_of_the_given_documents(spark, sf_dir, name, kind):
    texts = [row.text for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    for text, ids in zip(texts, encoder(name, kind).encode_many(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole(name, kind, text)


def test_words_are_forgotten_and_learned_again(monkeypatch):
    monkeypatch.setattr("filingloom.llm.tokens.CACHE_WORDS", 3)
    monkeypatch.setattr("filingloom.llm.tokens.CACHE_CHARS", 4)
    for name, kind in KINDS:
        enc = TextEncoder(encoder_path(name), kind)
        for text in ["one two three four", "one, five\nsix seventy eight.", "one two", "three\nfour", "İstanbul ǅ ß one"] * 3:
            (ids,) = enc.encode_many([text])
            assert np.frombuffer(ids, "<u4").tolist() == whole(name, kind, text)


def slow_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_crc32c_against_bit_by_bit():
    random.seed(5)
    strings = [b"", b"123456789", b"\0" * 200, *(random.randbytes(random.randrange(400)) for _ in range(60))]
    assert crc32c(strings).tolist() == [slow_crc32c(s) for s in strings]
    assert crc32c([b"123456789"])[0] == 0xE3069283
    assert masked(np.array([0], np.uint32))[0] == 0xA282EAD8


def test_damage_is_found():
    records = frame([b"abcdef", b""])
    block = b"".join(records)
    offsets, sizes = [0, len(records[0])], [len(r) for r in records]
    assert _unframe(block, offsets, sizes) == [b"abcdef", b""]
    for at in range(len(block)):
        broken = block[:at] + bytes([block[at] ^ 4]) + block[at + 1 :]
        with pytest.raises(ValueError, match="damaged"):
            _unframe(broken, offsets, sizes)


ROWS = [(5, "five five", "x"), (1, None, "x"), (2, "", None), (None, "no id", "x"), (5, "again", "x"), (9, "word " * 30_000, "x"), (7, "seven\n\n is  odd ", "x")]


def test_records_round_trip(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, start string")
    manifest = Stage(spark).write(write_records(docs, f"file://{tmp_path}/records", shards=3), "m")
    got = read_back(spark, manifest).collect()
    expected, start = [], 0
    for doc_id, text, _ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*whole(*KINDS[0], text or ""), 0]
        expected.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got if r.doc_id is not None) == sorted(e for e in expected if e[0] is not None)
    assert [(r.start, r.n_tokens) for r in sorted(got, key=lambda r: r.start)] == [e[1:3] for e in expected]
    paths = {m.shard: m.path for m in manifest.collect()}
    for r in got:  # a single record is found through the index
        assert zlib.crc32(read_record(paths[r.shard], r.record_offset, r.n_tokens).astype("<u4").tobytes()) == r.ids_crc32
    assert read_back(spark, write_records(docs.limit(0), f"file://{tmp_path}/none")).count() == 0


def check_packing(rows, texts, capacity):
    per_doc, per_seq = {}, {}
    for r in rows:
        per_doc.setdefault(r.doc_id, []).append(r)
        per_seq.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in texts.items():
        ids = [*whole(*KINDS[1], text or ""), 1]
        pieces = sorted(per_doc.pop(doc_id), key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // capacity)))
        for r in pieces:
            own = ids[r.piece * capacity : (r.piece + 1) * capacity]
            assert (r.start, r.length, r.ids_crc32) == (r.piece * capacity, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own)))
    assert not per_doc
    for pieces in per_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(per_seq)


def test_packing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(6)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pack_documents(docs, fan_in=2, max_items=30).collect()
    used = check_packing(rows, texts, 4096)
    assert used <= 1.02 * sum(r.length for r in rows) / 4096 + 2


def test_packing_edges(spark):
    docs = spark.createDataFrame([r for r in ROWS if r[0] not in (None, 5)], "doc_id long, text string, offset string")
    rows = pack_documents(docs, capacity=8).collect()
    check_packing(rows, {r[0]: r[1] for r in ROWS if r[0] not in (None, 5)}, 8)
    assert pack_documents(docs.limit(0)).count() == 0
    same = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, "a b"), (3, "a b")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.length) for r in pack_documents(same).collect()) == [(False, 3)] * 2 + [(True, 3)] * 2


def test_best_fit_is_tight():
    random.seed(2)
    sizes = np.array([random.choice([1, 7, 100, 900, 2048, 3000, 4096]) for _ in range(3000)])
    bins, offsets = best_fit(sizes, 4096)
    filled = {}
    for b, o, s in sorted(zip(bins.tolist(), offsets.tolist(), sizes.tolist(), strict=True)):
        assert filled.get(b, 0) == o
        filled[b] = o + s
    assert max(filled.values()) <= 4096
    assert len(filled) <= 1.12 * sizes.sum() / 4096 + 1
