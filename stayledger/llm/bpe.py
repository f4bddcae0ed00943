"""BPE encoding and decoding by dynamic programming over prefixes.

The encoding of a prefix has one last token, and for every prefix it is found from shorter ones:
of the tokens that end there, all matched by one automaton with suffix links, it is the one
whose predecessor, the last token of the prefix before it, is compatible. Two tokens are
compatible if merging their bytes together gives just these two. The last tokens are stored and
followed back from the end.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stayledger.llm.common import pieces, texts, tokenizer_path
from stayledger.llm.tokens import _OTHER, _SPLIT

#: Words and pairs kept by a task; at this number it starts anew.
KEPT = 400_000


def byte_letters() -> dict[str, int]:
    """The byte for each letter of a byte-level vocabulary: printable Latin-1 characters stand
    for themselves, the other bytes for the characters from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """A byte-level vocabulary file with its merges, automaton and special tokens."""

    def __init__(self, name: str = "byte_bpe_50k.json", folder: str | None = None):
        import ahocorasick
        import public_tokenizers
        import regex

        with open(tokenizer_path(name, folder), encoding="utf-8") as f:
            data = json.load(f)
        letters, ids = byte_letters(), data["model"]["vocab"]
        raw = {i: bytes(map(letters.__getitem__, t)) for t, i in ids.items() if all(c in letters for c in t)}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        raw.update((i, t.encode()) for t, i in self.special.items())
        self.bytes = [raw.get(i, b"") for i in range(max(raw) + 1)]
        self.merges, self.parts = {}, {}
        for rank, m in enumerate(data["model"]["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            a, b, whole = ids[left], ids[right], ids[left + right]
            self.merges[a, b] = rank
            self.parts.setdefault(whole, (a, b, rank))
        self.edges: dict[tuple[int, bool], list[tuple[int, float]]] = {}
        self.words: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        special = set(self.special.values())
        for i, b in raw.items():
            if i not in special and (len(b) == 1 or i in self.parts):
                self.automaton.add_word(b.decode("latin-1"), (i, len(b)))
        self.automaton.make_automaton()
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.split, self.any_split = _SPLIT[name].findall, regex.compile(public_tokenizers.PATTERN).findall

    def edge(self, token: int, right: bool) -> list[tuple[int, float]]:
        """Tokens that stand at one edge of ``token`` while its bytes are merged, each with the
        rank of the merge that takes it up."""
        if (found := self.edges.get((token, right))) is None:
            found, at, until = [], token, float("inf")
            while True:
                found.append((at, until))
                if at not in self.parts:
                    break
                a, b, until = self.parts[at]
                at = b if right else a
            self.edges[token, right] = found
        return found

    def compatible(self, a: int, b: int) -> bool:
        """Whether no merge across the border comes first. Merges go by rank, then from the left:
        one of the same rank inside ``a`` comes before it, one inside ``b`` after it."""
        if (known := self.pairs.get((a, b))) is None:
            known, merges = True, self.merges
            for x, until in self.edge(a, True):
                for y, before in self.edge(b, False):
                    rank = merges.get((x, y))
                    if rank is not None and rank < until and rank <= before:
                        known = False
            self.pairs[a, b] = known
        return known

    def word(self, word: str) -> bytes:
        """Ids of one word, as little-endian unsigned 32-bit integers."""
        data = word.encode()
        n = len(data)
        last, size = [-1] * (n + 1), [0] * (n + 1)
        for at, (token, length) in self.automaton.iter(data.decode("latin-1")):
            if last[at + 1] < 0:
                before = at + 1 - length
                if not before or last[before] >= 0 and self.compatible(last[before], token):
                    last[at + 1], size[at + 1] = token, length
        ids, at = [], n
        while at:
            ids.append(last[at])
            at -= size[at]
        return np.array(ids[::-1], "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if len(self.words) > KEPT:
            self.words.clear()
        if len(self.pairs) > KEPT:
            self.pairs.clear()
        out = []
        for part in self.cut.split(text) if self.special else [text]:
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
                continue
            for w in (self.any_split if _OTHER.search(part) else self.split)(part):
                if (ids := self.words.get(w)) is None:
                    ids = self.words[w] = self.word(w)
                out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(name: str, folder: str | None = None) -> Vocabulary:
    """One vocabulary for each Python worker; it outlives a task."""
    return Vocabulary(name, folder)


def encode(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", folder: str | None = None,
           id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of whole texts; ``ids`` are little-endian unsigned 32-bit integers. Strings
    of special tokens become those, as the library has it.

    Null and empty texts have no ids; a null id is an id like any other; repeated rows are
    returned as often; other columns play no part; no rows give no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(tokenizer, folder)
        for whole in batches:
            for batch in pieces(whole):
                yield pa.record_batch({"doc_id": batch["doc_id"], "ids": pa.array(
                    [vocab.encode(x.decode()) for x in batch["text"].to_pylist()], pa.binary())})

    return texts(docs, id, text, without_id=True).mapInArrow(run, "doc_id long, ids binary")


def decode(coded: DataFrame, tokenizer: str = "byte_bpe_50k.json", folder: str | None = None) -> DataFrame:
    """(doc_id, ids, text) of (doc_id, ids): the bytes of all tokens, special ones included;
    what is no UTF-8 becomes the replacement character. Null ids give null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(tokenizer, folder)
        for whole in batches:
            for batch in pieces(whole):
                yield pa.record_batch({
                    "doc_id": batch["doc_id"], "ids": batch["ids"].cast(pa.binary()), "text": pa.array(
                        [None if x is None else vocab.decode(x) for x in batch["ids"].to_pylist()], pa.string())})

    return coded.mapInArrow(run, "doc_id long, ids binary, text string")
