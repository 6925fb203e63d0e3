"""BPE encoding and decoding over a trie of distinct words.

The words of a batch (pieces of the tokenizer's pre-split) are inserted into a trie in the form of a sorted list, whose
common prefixes are the inner nodes. A depth-first walk keeps, for each prefix on the current path, the last token of
its encoding; a prefix that several words share is encoded once. The last token of a longer prefix is the one token t,
among those that end there, that may follow the last token of what stands before it: BPE encodes a string as "..., s, t"
exactly if s and t stay apart and the rest is encoded so. Which tokens end at a place, longest first, follows from the
state of an automaton over the vocabulary, which the walk keeps for each prefix too. Whether two tokens stay apart is
decided along the seam, from the order in which merges consume the pieces on either side.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, id_and_text, prepare, record, trim, trimmed

_NEVER = 1 << 60
_FIELDS = "doc_id long, ids binary, n_tokens long, decoded string"
#: Bytes of words and ids that a Python worker remembers between batches, the longest word remembered, and pairs of tokens
#: whose seam it remembers; results do not depend on them.
REMEMBERED, LONGEST, PAIRS = 64 << 20, 256, 1 << 19
#: Characters whose words are held as strings at once; a longer text is held alone.
AT_ONCE = 2 << 20


#: Characters that go through the tokenizers library at once when its classes are asked; it keeps some hundred bytes for each.
CLASS_PART = 1 << 14
#: Fixed value: the public pre-split of byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=1)
def split_patterns() -> tuple[str, str]:
    """The pre-split with its classes spelled out, and the set of characters for which SPLIT does not do.

    Unicode versions differ between libraries, so the classes are asked of the tokenizers library: each class as the regex
    package has it goes through that library's pre-split as one string, and a piece of it belongs to the class with whose
    members it joins. Texts without characters of another class there can be split by SPLIT, which is faster.
    """
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    every = np.delete(np.arange(0x110000, dtype="<u4"), slice(0xD800, 0xE000)).tobytes().decode("utf-32-le")
    kind, odd = np.zeros(0x110000, np.uint8), np.zeros(0x110000, bool)  # a byte a code point: an object for each would stay with the driver
    for guess, which in ((r"\p{L}+", "a"), (r"\p{N}+", "1"), (r"\s+", " "), (r"[^\s\p{L}\p{N}]+", "!")):
        members = "".join(m[0] for m in regex.finditer(guess, every))
        for at in range(0, len(members), CLASS_PART):
            part = members[at : at + CLASS_PART]
            for _, (low, high) in split(part):
                piece = part[low:high]
                joins = next((before for before in "a1!" if len(split(before + piece[0])) == 1), " ")
                points = np.frombuffer(piece.encode("utf-32-le"), np.uint32)
                kind[points] = ord(joins)
                odd[points] = joins != which

    def ranges(member: np.ndarray) -> str:
        edges = np.flatnonzero(np.diff(member.astype(np.int8), prepend=0, append=0))
        return "".join(f"\\U{low:08x}-\\U{end - 1:08x}" for low, end in edges.reshape(-1, 2).tolist())

    letter, number, space = (ranges(kind == ord(which)) for which in "a1 ")
    spelled = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    if odd[:256].any():
        raise ValueError("the pre-splits differ below U+0100")
    out = spelled, f"[{ranges(odd)}]" if odd.any() else r"(?!)"
    del every, members, part, kind, odd
    trim()
    return out


def read_definition(path: str) -> str:
    """A tokenizers JSON file, refused if it holds steps that this encoder has no counterpart for."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    d = json.loads(text)
    pre, model = d.get("pre_tokenizer") or {}, d["model"]
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    tokens = all(not any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized")) for t in d["added_tokens"])
    if not plain or not tokens or d.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        raise ValueError(f"{path}: only byte-level BPE with the usual pre-split and no normalizer is supported")
    return text


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones stand for themselves, the rest follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in set(printable))
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class TrieTokenizer:
    """Byte-level BPE from a tokenizers JSON file given as text; patterns are those of split_patterns."""

    def __init__(self, definition: str, patterns: tuple[str, str] | None = None):
        d, letters = json.loads(definition), byte_letters()
        spell = lambda s: bytes(letters[c] for c in s)
        named = d["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        vocab = {spell(s): i for s, i in named.items() if s not in self.special}
        self.bytes = {i: b for b, i in vocab.items()} | {i: s.encode() for s, i in self.special.items()}
        self.rank, self.split, self.born = {}, {}, {}
        for n, pair in enumerate(d["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b, whole = named[a], named[b], named[a + b]
            self.rank[a, b] = n
            if whole not in self.split:
                self.split[whole], self.born[whole] = (a, b), n
        self.plain, (self.spelled, self.odd) = regex.compile(SPLIT), map(re.compile, patterns or split_patterns())
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._right, self._left, self._apart, self._whole = {}, {}, {}, {}
        self.known: dict[str | int, bytes] = {}
        self._held = 0
        self._build({b: i for b, i in vocab.items() if self.reachable(i)})

    def _build(self, vocab: dict[bytes, int]) -> None:
        """The automaton: step by byte, where to go on if there is no step, and the longest token that ends in a state."""
        self.step, self.fail, self.token, self.depth = {}, [0], [-1], [0]
        for word, i in vocab.items():
            at = 0
            for c in word:
                to = self.step.get(at << 8 | c)
                if to is None:
                    to = self.step[at << 8 | c] = len(self.token)
                    self.token.append(-1)
                    self.fail.append(0)
                    self.depth.append(self.depth[at] + 1)
                at = to
            self.token[at] = i
        below: list[list[tuple[int, int]]] = [[] for _ in self.token]
        for key, to in self.step.items():
            below[key >> 8].append((key & 255, to))
        self.ends = [0] * len(self.token)
        self.shorter = [0] * len(self.token)
        queue = deque([0])
        while queue:
            at = queue.popleft()
            self.shorter[at] = self.ends[self.fail[at]]
            self.ends[at] = at if self.token[at] >= 0 else self.shorter[at]
            for c, to in below[at]:
                self.fail[to] = self._next(self.fail[at], c) if at else 0
                queue.append(to)

    def _next(self, state: int, c: int) -> int:
        step, fail = self.step, self.fail
        while (to := step.get(state << 8 | c)) is None:
            if not state:
                return 0
            state = fail[state]
        return to

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces that lie at one edge of a token while it is built, from byte to token, each with the rank of the merge that consumes it."""
        memo = (self._left, self._right)[side]
        if token not in memo:
            out, until = [], _NEVER
            while True:
                out.append((token, until))
                if token not in self.split:
                    break
                token, until = self.split[token][side], self.born[token]
            memo[out[0][0]] = out[::-1]
            return out[::-1]
        return memo[token]

    def apart(self, s: int, t: int) -> bool:
        """Whether the bytes of s and t together are encoded as s, t."""
        key = s << 32 | t
        known = self._apart.get(key)
        if known is not None:
            return known
        if len(self._apart) >= PAIRS:
            self._apart.clear()
        xs, ys, i, j = self._spine(s, 1), self._spine(t, 0), 0, 0
        while True:
            (x, x_until), (y, y_until) = xs[i], ys[j]
            m = self.rank.get((x, y))
            if m is not None and m < x_until and m <= y_until:
                ok = False
                break
            if x_until == y_until == _NEVER:
                ok = True
                break
            if x_until <= y_until:
                i += 1
            else:
                j += 1
        self._apart[key] = ok
        return ok

    def reachable(self, token: int) -> bool:
        """Whether the bytes of a token are encoded as that token."""
        if token not in self._whole:
            a, b = self.split.get(token, (None, None))
            if a is None:
                ok = len(self.bytes[token]) == 1
            else:  # each half is built as if alone unless a merge across the seam comes first
                xs, ys, i, j, ok = self._spine(a, 1), self._spine(b, 0), 0, 0, self.reachable(a) and self.reachable(b)
                while ok and (xs[i][0], ys[j][0]) != (a, b):
                    m = self.rank.get((xs[i][0], ys[j][0]))
                    if m is not None and m < xs[i][1] and m <= ys[j][1]:
                        ok = False
                    if xs[i][1] <= ys[j][1]:
                        i += 1
                    else:
                        j += 1
            self._whole[token] = ok
        return self._whole[token]

    def encode_words(self, words: list[bytes]) -> list[array]:
        """The token ids of sorted distinct words, by a depth-first walk of their trie."""
        step, fail, token, depth, ends, shorter, seams, apart, out = self.step, self.fail, self.token, self.depth, self.ends, self.shorter, self._apart, self.apart, []
        last, back, states, before = [0], [0], [0], b""
        for word in words:
            shared = len(commonprefix((before, word)))
            del last[shared + 1 :], back[shared + 1 :], states[shared + 1 :]
            state, end = states[-1], shared
            for c in word[shared:]:
                end += 1
                while (to := step.get(state << 8 | c)) is None and state:
                    state = fail[state]
                states.append(state := to or 0)
                at = ends[state]
                while at:
                    begin, t = end - depth[at], token[at]
                    if not begin:
                        break
                    s = last[begin]
                    stays = seams.get(s << 32 | t)
                    if stays or stays is None and apart(s, t):
                        break
                    at = shorter[at]
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
                last.append(t)
                back.append(begin)
            ids, end = [], len(word)
            while end:
                ids.append(last[end])
                end = back[end]
            out.append(array("I", ids[::-1]))
            before = word
        return out

    def words(self, text: str) -> list[str]:
        """The pre-split of a text without special tokens."""
        try:  # the first 256 code points are of one class everywhere
            text.encode("latin-1")
        except UnicodeEncodeError:
            return (self.spelled if self.odd.search(text) else self.plain).findall(text)
        return self.plain.findall(text)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out, low, held = [], 0, 0
        for high, text in enumerate(texts, 1):
            held += len(text)
            if held >= AT_ONCE or high == len(texts):
                out += self._encode(texts[low:high])
                low, held = high, 0
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        known, split = self.known, self.words
        if self._held > REMEMBERED:
            known.clear()
            self._held = 0
        for i in self.special.values():
            known[i] = i.to_bytes(4, "little")
        parts = []
        for text in texts:
            pieces, at = [], 0
            for m in self.cut.finditer(text) if self.cut else ():
                pieces += split(text[at : m.start()])
                pieces.append(self.special[m[0]])
                at = m.end()
            parts.append(pieces + split(text[at:]) if at else split(text))
        fresh = {w.encode(): w for pieces in parts for w in set(pieces) if w not in known}
        ordered, long = sorted(fresh), []
        for word, ids in zip(ordered, self.encode_words(ordered)):
            known[fresh[word]] = ids.tobytes()
            self._held += len(word) + 4 * len(ids) + 200
            if len(word) > LONGEST:
                long.append(word)
        out = [b"".join(map(known.__getitem__, pieces)) for pieces in parts]
        for word in long:
            self._held -= len(word) + len(known.pop(fresh[word])) + 200
        return out

    def forget(self) -> None:
        """Drops what is remembered, so that an idle worker does not hold it."""
        for memo in (self.known, self._apart, self._left, self._right):
            memo.clear()
        self._held = 0
        trim()

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.bytes.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


_tokenizers: dict[str, TrieTokenizer] = {}


def _shared(docs: DataFrame, tokenizer_path: str):
    """What workers build the tokenizer from: a file of fixed size and the pre-split, read on the driver and broadcast."""
    return prepare(docs.sparkSession).sparkContext.broadcast((read_definition(tokenizer_path), split_patterns()))


def _tokenizer(shared) -> TrieTokenizer:
    """One per worker and definition, with what it remembers."""
    definition, patterns = shared.value
    key = hashlib.sha256("\0".join((definition, *patterns)).encode()).hexdigest()
    if key not in _tokenizers:
        _tokenizers[key] = TrieTokenizer(definition, patterns)
    return _tokenizers[key]


def _code(shared):
    schema = arrow_schema(_FIELDS)

    @trimmed
    def code(batches):
        t = _tokenizer(shared)
        for batch in batches:
            ids = t.encode_batch(batch.column(1).to_pylist())
            yield record(schema, len(ids), doc_id=batch.column(0), ids=ids, n_tokens=[len(x) // 4 for x in ids], decoded=[t.decode(x) for x in ids])
        t.forget()

    return code


def encode_and_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (packed little-endian unsigned 32-bit), n_tokens, decoded: one row per input row.

    tokenizer_path is read on the driver; files with other steps than byte-level BPE are refused. Null text is empty and has
    no tokens. An empty table gives no rows. Strings of special tokens are encoded as those tokens. Words are distinct per batch, so repeated rows cost
    little; a long text is one word list, so memory follows the longest text. Row order, ties and other columns play no part.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(_code(_shared(docs, tokenizer_path)), _FIELDS)


def with_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """The columns of docs, with ids (packed little-endian unsigned 32-bit), n_tokens and round_trip: whether decoding gives the text again.

    Columns of these names give way. Null text is empty; rows stay as they are, repeated ones and those without an id too.
    """
    shared = _shared(docs, tokenizer_path)

    @F.pandas_udf("ids binary, n_tokens long, round_trip boolean")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        t = _tokenizer(shared)
        for batch in batches:
            texts = batch.tolist()
            ids = t.encode_batch(texts)
            yield pd.DataFrame({"ids": ids, "n_tokens": [len(x) // 4 for x in ids], "round_trip": [t.decode(x) == y for x, y in zip(ids, texts)]})
        t.forget()

    out = docs.withColumn("__coded", coded(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    return out.withColumns({c: F.col(f"__coded.{c}") for c in ("ids", "n_tokens", "round_trip")}).drop("__coded")


def digests(coded: DataFrame) -> DataFrame:
    """What a comparison needs of encode_and_decode."""
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
