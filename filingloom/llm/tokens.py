"""Ids of whole texts, by the tokenizers library, with the ids of the words remembered.

A byte-level vocabulary never joins a character that is not white space with a space after it, and a space
belongs to what follows it unless that is white space too. So a text may be cut before every space
that no white space follows, and the parts encoded alone. A lower-casing word vocabulary drops
white space, so it may be cut at every space and line end. Words that are not yet remembered are
encoded many at a time, as one text, and told apart by the tokens that begin (or end) a word.
For a byte-level vocabulary a single line end between words, and a comma or full stop between a letter and a space, are
parts of their own, so that a word is remembered once and not with each mark after it and each line that follows.
"""

from __future__ import annotations

import os
import re

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE_WORDS = 600_000  # words in each of the memory's two halves, in one Python worker, for a byte-level vocabulary
CACHE_SHARE = {"bytes": 1, "words": 2 / 3}  # of that
CACHE_CHARS = 48  # longer parts are not remembered
GROUP_CHARS = {"bytes": 2_400_000, "words": 400_000}  # texts encoded together
_JOINED = 2_000  # words encoded as one text
WHOLE = ("", [])  # stands for a text that is encoded as it is
_OPEN = re.compile(r" (?!\S)")  # a space before white space or the end
_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")
_CUT = "\x01"  # begins a part that no space stands before; a text that holds one is cut at its spaces alone
_LINE_END = re.compile(r"\n(?<=\S\n)(?=\S)")
_COMMA, _STOP = (re.compile(rf"{m}(?<=[^\W\d_]{m})(?= )") for m in (",", r"\."))
_MARKED = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-^`{-~]+)")  # letters, then ASCII marks other than the apostrophe


def _cut(text: str) -> str:
    """The text with a space and a sign before and after each part of its own."""
    text = _LINE_END.sub(f" {_CUT}\n {_CUT}", text)
    return _STOP.sub(f" {_CUT}.", _COMMA.sub(f" {_CUT},", text))


class _Memory:
    """Ids by word. When the newer half is full it becomes the older one; what is used again moves up."""

    def __init__(self, share: float) -> None:
        self.share = share
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.long: list[str] = []  # words to forget after the group

    def missing(self, words: set[str]) -> list[str]:
        words = words.difference(self.new)
        self.long += [w for w in words if len(w) > CACHE_CHARS]
        if not self.old:
            return list(words)
        out, old = [], self.old
        for w in words:
            if (ids := old.get(w)) is None:
                out.append(w)
            else:
                self.new[w] = ids
        return out

    def settle(self) -> None:
        """Between groups of texts only, as a group needs all its words."""
        if len(self.new) > CACHE_WORDS * self.share:
            self.old, self.new = self.new, {}
        for w in self.long:
            self.new.pop(w, None)
        self.long = []


class TextEncoder:
    """Encodes whole texts to ids as little-endian unsigned 32-bit integers.

    kind: "bytes" for a byte-level vocabulary, "words" for one that drops white space and marks the ends of words.
    A text that holds an added token of the vocabulary, in upper or lower case, is encoded whole.
    """

    def __init__(self, path: str, kind: str) -> None:
        from tokenizers import Tokenizer

        if kind not in ("bytes", "words"):
            raise ValueError(kind)
        self.tokenizer, self.kind = Tokenizer.from_file(path), kind
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        # the longest run of marks in each: a text without any of them needs no closer look ("" is in every text)
        self.marks = {max(re.split(r"[^\W_]+", t), key=len) for t in added}
        self.prefix = " " if kind == "bytes" else ""
        self.edge = np.zeros(self.tokenizer.get_vocab_size(), bool)  # tokens that begin, or end, a word
        for token, at in self.tokenizer.get_vocab().items():
            self.edge[at] = token.startswith("Ġ") if kind == "bytes" else token.endswith("</w>")
        self.line_end = int(np.frombuffer(self._encode("\n"), "<u4")[0]) if kind == "bytes" else -1
        self.words, self.starts = _Memory(CACHE_SHARE[kind]), _Memory(CACHE_SHARE[kind])  # after a space (or anywhere, for words), and at the start of a line

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn_plain(self, words: list[str]) -> None:
        """Words of letters only, encoded as one text."""
        for at in range(0, len(words), _JOINED):
            some = words[at : at + _JOINED]
            joined = " ".join(some)
            (coded,) = self.tokenizer.encode_batch_fast([" " + joined], add_special_tokens=False)
            ids = np.array(coded.ids, dtype="<u4")
            edges = np.flatnonzero(self.edge[ids]).tolist()
            if len(edges) == len(some) and (self.kind == "words" or edges[0] == 0):
                data = ids.tobytes()
                cuts = [*edges, len(ids)] if self.kind == "bytes" else [0, *(e + 1 for e in edges)]
                for word, a, b in zip(some, cuts, cuts[1:], strict=False):
                    self.words.new[word] = data[4 * a : 4 * b]
            else:  # letters that the vocabulary's normalizer turns into something else
                for word in some:
                    self.words.new[word] = self._encode(self.prefix + word)

    def _learn(self, parts: set[str]) -> None:
        """Remember the ids of parts that stand after a space, or anywhere for a word vocabulary."""
        todo = self.words.missing(parts)
        plain: set[str] = set()
        marked, lines, odd, cut = [], [], [], []
        for part in todo:
            if part.isalpha():
                plain.add(part)
            elif part.startswith(_CUT):
                cut.append(part)
            elif m := _MARKED.fullmatch(part):
                marked.append((part, m[1], m[2]))
            elif "\n" in part:
                lines.append(part)
            else:
                odd.append(part)
        self._learn_plain([*plain, *self.words.missing({m[1] for m in marked} - plain)])
        new = self.words.new
        for part in odd:
            new[part] = self._encode(self.prefix + part)
        self._learn_starts({p[1:] for p in cut})
        for part in cut:
            new[part] = self._start(part[1:])
        for part, stem, marks in marked:
            new[part] = new[stem] + self._start(marks)
        split = [p.split("\n") for p in lines]
        self._learn_starts({x for own in split for x in own[1:]})
        self._learn_firsts({s[0] for s in split})
        for part, own in zip(lines, split, strict=True):
            if any(not x or x[0].isspace() or x[-1].isspace() for x in own):
                new[part] = self._encode(self.prefix + part)
            else:
                new[part] = self._start("\n").join([new[own[0]], *map(self._start, own[1:])])

    def _learn_firsts(self, parts: set[str]) -> None:
        if parts:
            self._learn({p for p in parts if p})

    def _learn_starts(self, parts: set[str]) -> None:
        """Words that begin a line, encoded as one text of lines."""
        words = [w for w in self.starts.missing(parts) if w.isalpha()]
        for at in range(0, len(words), _JOINED):
            some = words[at : at + _JOINED]
            (coded,) = self.tokenizer.encode_batch_fast(["\n".join(some)], add_special_tokens=False)
            ids = np.array(coded.ids, dtype="<u4")
            ends = np.flatnonzero(ids == self.line_end).tolist()
            if len(ends) == len(some) - 1:
                data = ids.tobytes()
                for word, a, b in zip(some, [0, *(e + 1 for e in ends)], [*ends, len(ids)], strict=True):
                    self.starts.new[word] = data[4 * a : 4 * b]

    def _start(self, part: str) -> bytes:
        """The ids of a part without white space around it that stands at the start of a line or after a letter."""
        if (ids := self.starts.new.get(part)) is None:
            ids = self.starts.old.get(part)
            self.starts.new[part] = ids = self._encode(part) if ids is None else ids
            if len(part) > CACHE_CHARS:
                self.starts.long.append(part)
        return ids

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of some texts; give about as much text at a time as GROUP_CHARS says, or one longer text."""
        split: list[tuple[str, list[str]] | None] = []
        for text in texts:
            if any(m in text for m in self.marks) and self.added.search(text):
                split.append(WHOLE)
            elif self.kind == "words":
                split.append(("", text.replace("\n", " ").split(" ")))
            elif _OPEN.search(text) or _CUT in text:
                split.append(None)
            else:
                first, *rest = _cut(text).split(" ")
                split.append((first, rest))
        parts = set().union(*(s[1] for s in split if s)) | ({""} if self.kind == "words" else set())
        self._learn(parts)
        get, out = self.words.new.__getitem__, []
        for text, s in zip(texts, split, strict=True):
            if s is WHOLE:
                out.append(self._encode(text))
            elif s is None:
                out.append(b"".join(map(self._start, _SAFE_CUT.split(text))))
            else:
                first = self._first(s[0]) if s[0] else b""
                out.append(first + b"".join(map(get, s[1])))
        self.words.settle()
        self.starts.settle()
        return out

    def _first(self, part: str) -> bytes:
        lines = part.split("\n")
        if len(lines) > 1 and not any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
            return self._start("\n").join(map(self._start, lines))
        return self._start(part)


_ENCODERS: dict[tuple[str, str], TextEncoder] = {}


def encoder(name: str, kind: str) -> TextEncoder:
    """The worker's encoder for a public vocabulary file, by name, or a file by absolute path."""
    if (name, kind) not in _ENCODERS:
        if os.path.isabs(name):
            path = name
        else:
            import public_tokenizers

            path = public_tokenizers.path(name)
        _ENCODERS[name, kind] = TextEncoder(path, kind)
    return _ENCODERS[name, kind]


def encoded(batches, name: str, kind: str):
    """(id, ids) of each row of batches of an id and a text column; a null text is empty. Texts go in groups."""
    enc = encoder(name, kind)
    for batch in batches:
        keys, group, size = [], [], 0
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            keys.append(key)
            group.append(text.as_py() or "")
            size += len(group[-1])
            if size >= GROUP_CHARS[kind]:
                yield from zip(keys, enc.encode_many(group), strict=True)
                keys, group, size = [], [], 0
        if group:
            yield from zip(keys, enc.encode_many(group), strict=True)
