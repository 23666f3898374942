"""Encoding of whole texts with a public tokenizer, many documents at a time inside a task."""

from __future__ import annotations

import hashlib
import json
import os
import re
import string
from collections.abc import Iterable
from functools import partial, reduce
from itertools import batched, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from hustings.llm.common import kept

#: Chunks kept in a worker's dictionary, and the longest chunk that is kept, in bytes.
CACHE_CHUNKS, CACHE_LENGTH = 200_000, 48
#: Closing marks that tell whether marks are looked up apart from the word before them, all that then may be, and how many
#: different runs of those are kept.
MARKS, RUNS, CACHE_RUNS = b".,;:!?", string.punctuation.replace("'", "").encode(), 10_000
#: Words that are put together in one go.
BLOCK = 1 << 18
_encoders: dict[str, WordEncoder] = {}


def vocabulary(path: str | None = None) -> str:
    """The tokenizer's JSON, by default the installed public word-level BPE of 49k ids."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


# Normalizers that handle a text's characters one by one or in groups without white space, and
# pre-tokenizers that part texts at all white space.
LOCAL = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents", "BertNormalizer", "Nmt"}
PARTING = {"Whitespace", "WhitespaceSplit", "BertPreTokenizer"}
# Normalizers that leave words of a-z as they are ("Replace" is one that squeezes white space where parts_at_blanks holds).
PLAIN = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents", "Replace"}
LETTERS = string.ascii_lowercase
BLANKS = "a b\tc\nd\x0be\x0cf\rg  h, 1 2.\n\n3 'x y' é ö"


def _steps(part: dict | None, name: str) -> list[dict]:
    if part is None:
        return []
    return [s for p in part[name] for s in _steps(p, name)] if part["type"] == "Sequence" else [part]


def parts_at_blanks(config: dict) -> bool:
    """Whether a tokenizer's normalizer and pre-tokenizer treat white-space-parted chunks each by itself: only local
    normalizers, or one that makes single blanks of white space, and first a pre-tokenizer that parts at white space, be it
    by a pattern of whose matches none has white space in it. In doubt no."""
    for n in _steps(config.get("normalizer"), "normalizers"):
        squeezed = n["type"] == "Replace" and n.get("pattern") == {"Regex": r"\s+"} and n.get("content") == " "
        if n["type"] not in LOCAL and not squeezed:
            return False
    steps = _steps(config.get("pre_tokenizer"), "pretokenizers")
    if not steps or any(s["type"] in ("Metaspace", "ByteLevel") and s.get("add_prefix_space") for s in steps) or any(t.get("lstrip") or t.get("rstrip") or set(" \t\n") & set(t["content"]) for t in config.get("added_tokens", [])):
        return False
    first = steps[0]
    if first["type"] == "Split":
        pattern = first["pattern"].get("Regex")
        return bool(pattern and first["behavior"] == "Removed" and first["invert"]) and not any(regex.search(r"\s", m[0]) for m in regex.finditer(pattern, BLANKS))
    return first["type"] in PARTING


def lowers_first(config: dict) -> bool:
    """Whether lowering A-Z before a tokenizer's normalizer changes nothing, but where a mark composes with a letter: it
    lowers letters itself, and before that it only composes or decomposes or makes single blanks of white space."""
    kinds = [n["type"] for n in _steps(config.get("normalizer"), "normalizers")]
    return "Lowercase" in kinds and set(kinds[: kinds.index("Lowercase")]) <= {"NFC", "NFD", "Replace"}


class WordEncoder:
    """Ids of texts for tokenizers that never join characters across ASCII white space.

    Such a tokenizer gives a text the ids of its white-space-parted chunks one after the other, so each distinct chunk
    is encoded once by the tokenizers library and looked up afterwards. All others get their texts whole; the tokenizer's
    own description tells which kind it is. Whether closing marks are parted from the word before them is tried out.
    """

    def __init__(self, vocabulary: str, end_id: int):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, config = Tokenizer.from_str(vocabulary), json.loads(vocabulary)
        self.width = "<u2" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        self.end = np.array([end_id], self.width).tobytes()
        self.by_chunk = parts_at_blanks(config)
        self.lowers = self.by_chunk and lowers_first(config)
        self.added = [t["content"].encode().lower() for t in config.get("added_tokens", [])]
        alone = {w: self._ids([w])[0] for w in ("three", *MARKS.decode())}
        self.by_mark = all(self._ids([f"three{m}"])[0] == alone["three"] + alone[m] for m in MARKS.decode())
        self.runs: dict[bytes, bool] = {}
        self.bare, self.ending, self.letters = None, None, None
        self._without_offsets(config)
        self.known: dict[bytes, bytes] = {b"": b""}

    def _without_offsets(self, config: dict) -> None:
        """Where the model marks ids that end a word, words of letters need no offsets to be parted: sets ending, which ids
        those are, letters, which words these are (it is tried out that a letter doesn't part a word), and bare, the model
        alone, for words of a-z where neither normalizer nor pre-tokenizer may change them."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        suffix = config["model"].get("end_of_word_suffix")
        if not self.by_chunk or config["model"].get("type") != "BPE" or not suffix or any(t.decode().isalpha() for t in self.added):
            return
        told, normal, parted = [c for c in map(chr, range(0x250)) if c.isalpha()], self.tokenizer.normalizer, self.tokenizer.pre_tokenizer.pre_tokenize_str
        whole = [c for c in told if len(parted(normal.normalize_str(f"a{c}a") if normal else f"a{c}a")) == 1]
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ending = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ending[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.letters = re.compile(f"[{''.join(whole)}]+").fullmatch if whole else None
        words = [*LETTERS, *map("".join, pairwise(LETTERS)), LETTERS * 20, LETTERS[::-1], "three"]
        if {n["type"] for n in _steps(config.get("normalizer"), "normalizers")} <= PLAIN and [w for w, _ in parted(" ".join(words))] == words:
            self.bare = Tokenizer(self.tokenizer.model)
            self.bare.pre_tokenizer = CharDelimiterSplit(" ")

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _packed(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, self.width).tobytes() for ids in self._ids(texts)]

    def _cut(self, ids: list[int], ends: Iterable[int]) -> list[bytes]:
        packed, width = np.array(ids, self.width).tobytes(), np.dtype(self.width).itemsize
        return [packed[a * width : b * width] for a, b in pairwise(ends)]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk. Many are encoded as one text, as a call costs more than a word; offsets part them again."""
        starts = np.cumsum([0, *(len(c) + 1 for c in chunks)])
        made = self.tokenizer.encode("\n".join(chunks), add_special_tokens=False)
        return self._cut(made.ids, np.searchsorted([a for a, _ in made.offsets], starts).tolist())

    def _words(self, words: list[str], tokenizer=None) -> list[bytes]:
        """Ids of each word of letters; ids that end a word part them again."""
        ids = (tokenizer or self.tokenizer).encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids
        ends = np.flatnonzero(self.ending[ids]) + 1
        return self._cut(ids, [0, *ends.tolist()]) if len(ends) == len(words) else self._chunks(words)

    def _marks(self, chunk: bytes) -> int:
        """How many closing marks are a token run of their own after the word, as they are after another word."""
        stem = chunk.rstrip(RUNS)
        run = chunk[len(stem) :]
        if not stem[-1:].isalpha() or len(run) > 8:
            return 0
        if run not in self.runs:
            three, alone, both = self._ids(["three", run.decode(), f"three{run.decode()}"])
            self.runs[run] = both == three + alone
        return len(run) if self.runs[run] else 0

    def _fresh(self, missing: list[bytes]) -> dict[bytes, bytes]:
        known = self.known
        text = b" ".join(missing).lower()
        by_mark = self.by_mark and not any(t in text for t in self.added)
        marked = {c: n for c in missing if c[-1] in RUNS and (n := self._marks(c))} if by_mark else {}
        parts = set(missing).difference(marked).union(c[:-n] for c, n in marked.items()).union(c[-n:] for c, n in marked.items()).difference(known)
        plain = [c for c in parts if c.isalpha() and c.islower()] if self.bare else []
        others = [c.decode() for c in parts.difference(plain)]
        worded = [c for c in others if self.letters(c)] if self.letters else []
        fresh: dict[bytes, bytes] = {}
        for encode, some in ((partial(self._words, tokenizer=self.bare), [c.decode() for c in plain]), (self._words, worded), (self._chunks, set(others).difference(worded))):
            for few in batched(some, 1_000):
                fresh.update(zip((c.encode() for c in few), encode(few), strict=True))
        for c, n in marked.items():
            stem, run = c[:-n], c[-n:]
            fresh[c] = (fresh[stem] if stem in fresh else known[stem]) + (fresh[run] if run in fresh else known[run])
        return fresh

    def _looked_up(self, chunks: list[bytes]) -> list[bytes]:
        known = self.known
        packed = list(map(known.get, chunks))
        fresh = self._fresh([c for c, p in zip(chunks, packed, strict=True) if p is None])
        packed = [fresh[c] if p is None else p for c, p in zip(chunks, packed, strict=True)]
        short = ((c, p) for c, p in fresh.items() if len(c) <= CACHE_LENGTH)
        known.update(islice(short, max(0, CACHE_CHUNKS - len(known))))
        if len(self.runs) > CACHE_RUNS:
            self.runs.clear()
        return packed

    def _lowered(self, texts: pa.Array) -> pa.Array:
        """The texts with A-Z lowered where the tokenizer does that anyway: not where a mark (U+0300 to U+037F) might compose
        with a letter or where an added token may stand, which is matched before."""
        if not self.lowers:
            return texts
        low = pc.ascii_lower(texts)
        plain = low.cast(pa.binary())
        found = (pc.match_substring(plain, pattern=x) for x in (b"\xcc", b"\xcd", *self.added))
        return pc.if_else(reduce(pc.or_, found), texts, low)

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (strings without nulls) one after the other, the end id after each text's, and where each
        text's begin; at last their number."""
        if not self.by_chunk:
            packed = [x + self.end for x in self._packed(texts.to_pylist())]
            lengths = np.fromiter(map(len, packed), np.int64) // np.dtype(self.width).itemsize
            return np.frombuffer(b"".join(packed), self.width), np.concatenate([[0], np.cumsum(lengths)])
        split = pc.ascii_split_whitespace(self._lowered(texts))
        words = split.flatten().dictionary_encode()
        packed = self._looked_up(words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())
        packed.append(self.end)
        sizes = np.fromiter(map(len, packed), np.int64) // np.dtype(self.width).itemsize
        held, starts = np.frombuffer(b"".join(packed), self.width), np.cumsum(sizes) - sizes
        last = np.cumsum(pc.list_value_length(split).to_numpy())
        codes = np.insert(words.indices.to_numpy(), last, len(packed) - 1)
        at = np.concatenate([[0], np.cumsum(sizes[codes])])
        ids = np.empty(at[-1], self.width)
        for a in range(0, len(codes), BLOCK):
            some, to = codes[a : a + BLOCK], at[a : a + BLOCK + 1]
            n = np.diff(to)
            ids[to[0] : to[-1]] = held[np.repeat(starts[some] - to[:-1], n) + np.arange(to[0], to[-1])]
        return ids, np.concatenate([[0], at[last + np.arange(1, len(last) + 1)]])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Per text its ids and the end id, as little-endian integers of self.width."""
        ids, at = self.flat(pa.array(texts, pa.binary()).cast(pa.string()))
        return [ids[a:b].tobytes() for a, b in pairwise(at.tolist())]


def encoder(vocabulary: str, end_id: int) -> WordEncoder:
    """One encoder for each worker process and vocabulary."""
    key = f"{hashlib.sha256(vocabulary.encode()).hexdigest()} {end_id}"
    if key not in _encoders:
        _encoders[key] = WordEncoder(vocabulary, end_id)
    kept["tokens"] = _encoders.clear
    return _encoders[key]
