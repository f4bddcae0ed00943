"""Token ids of whole texts by the ``tokenizers`` library, each distinct word encoded once.

A BPE vocabulary splits text into words before it merges anything, and words repeat. A task
splits each text and has the library encode the words that it has not met; a word alone has the
ids that it has inside a text. Texts with characters outside ``PLAIN``, for which the split is
not spelled out here, or with strings of special tokens go to the library whole.

A byte-level vocabulary has no word that goes on over a space after something else. There texts are
cut before spaces, and parts take the place of words: each distinct one of a batch is looked up
among those met before, all at once, and the library encodes the new ones.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stayledger.llm.common import tokenizer_path

#: Letters, numbers and white space among the characters up to U+00FF.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
#: Found in texts that the library takes whole: all but U+0000 to U+00FF and some punctuation.
_OTHER = re.compile("[^\\x00-\xff–—‘’“”…•€]")
#: The same for Arrow.
_OTHER_RE2 = r"[^\x{00}-\x{ff}–—‘’“”…•€]"
#: Found in texts that are not cut at spaces: one inside white space, which may be a word with it.
_INSIDE_RE2 = r"[\t-\r \x{85}\x{a0}] (?:[\t-\r \x{85}\x{a0}]|\z)"
#: Fixed patterns of the two public vocabularies over those characters.
_SPLIT = {
    "byte_bpe_50k.json": re.compile(
        f"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"),
    "word_bpe_49k.json": re.compile(f"'(?:[stmd]|re|ve|ll)|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+"),
}
#: Words kept by a task; at this number they become the older ones, of which those that are
#: met again stay.
KEPT = 300_000
#: Parts of texts kept by a task; at this number those of the last batch stay.
KEPT_PARTS = 1_000_000


class Encoder:
    """Ids of texts as little-endian unsigned 16-bit integers."""

    def __init__(self, name: str, folder: str | None = None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_path(name, folder))
        self.library.no_truncation()
        self.library.no_padding()
        self.find, self.lower = _SPLIT[name].findall, name.startswith("word")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.size = self.library.get_vocab_size()
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.parts, self.codes = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        if not self.lower:
            from stayledger.llm.bpe import byte_letters

            letters = byte_letters()
            self.bytes = np.zeros(self.size, np.int64)  # of each token
            for token, i in self.library.get_vocab(with_added_tokens=True).items():
                self.bytes[i] = len(token.encode() if token in self.special else bytes(map(letters.__getitem__, token)))

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u2").tobytes() for x in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of single words, as many as possible in one text, which the library cuts into the
        same words: behind spaces where white space is dropped, else those that begin with a
        space and a letter."""
        if self.lower:
            return self._in_one_text(words, " ") or self._whole(words)
        joined = [i for i, w in enumerate(words) if w[0] == " " and w[1:2].isalpha()]
        alone = sorted(set(range(len(words))).difference(joined))
        out: list = [None] * len(words)
        for i, ids in zip(alone, self._whole([words[i] for i in alone])):
            out[i] = ids
        for i, ids in zip(joined, self._in_one_text([words[i] for i in joined], "")):
            out[i] = ids
        return out

    def _in_one_text(self, words: list[str], glue: str) -> list[bytes]:
        """Ids of the words of one text; none if the library counts other words."""
        found = self.library.encode(glue.join(words), add_special_tokens=False)
        of = np.array(found.word_ids, np.int64)
        if len(of) and of[-1] != len(words) - 1:
            return []
        ids, at, out = np.array(found.ids, "<u2").tobytes(), 0, []
        for end in (np.searchsorted(of, np.arange(len(words)), "right") * 2).tolist():
            out.append(ids[at:end])
            at = end
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list = [None] * len(texts)
        whole, split, new = [], [], set()
        if len(self.words) > KEPT:
            self.words, self.older = {}, self.words
        for i, text in enumerate(texts):
            if _OTHER.search(text) or any(x in text for x in self.special):
                whole.append(i)
            else:
                words = self.find(text.lower() if self.lower else text)
                split.append((i, words))
                new.update(words)
        new = new.difference(self.words)
        self.words.update({w: self.older[w] for w in new.intersection(self.older)})
        if new := list(new.difference(self.older)):
            self.words.update(zip(new, self._words(new)))
        get = self.words.__getitem__
        for i, words in split:
            out[i] = b"".join(map(get, words))
        for i, ids in zip(whole, self._whole([texts[i] for i in whole])):
            out[i] = ids
        return out


    def _new_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of parts that begin with a space: many in one text, cut at their bytes; alone where
        they end with white space."""
        joined = [i for i, x in enumerate(parts) if not x[-1:].isspace()]
        alone = sorted(set(range(len(parts))).difference(joined))
        groups = [joined[at:at + 1024] for at in range(0, len(joined), 1024)]
        found = self.library.encode_batch_fast(["".join([parts[i] for i in g]) for g in groups], add_special_tokens=False)
        out: list = [None] * len(parts)
        for g, x in zip(groups, found):
            ids = np.array(x.ids, "<u2")
            ends, stops = np.cumsum(self.bytes[ids]), np.cumsum([len(parts[i].encode()) for i in g])
            cut = np.searchsorted(ends, stops)
            if not (cut < len(ends)).all() or (ends[cut] != stops).any():
                alone += g
                continue
            data, at = ids.tobytes(), 0
            for i, end in zip(g, (2 * cut + 2).tolist()):
                out[i] = data[at:end]
                at = end
        for i, ids in zip(alone, self._whole([parts[i] for i in alone])):
            out[i] = ids
        return out

    def _cut(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts that are cut before each space, by their distinct parts."""
        split = pc.split_pattern(texts, " ")
        bounds, coded = split.offsets.to_numpy(), split.flatten().dictionary_encode()
        distinct, first = coded.dictionary, bounds[:-1]  # the first part of a text has no space before it
        known = pc.index_in(distinct, value_set=self.parts)
        new = distinct.filter(pc.is_null(known))
        codes = pa.array(self._new_parts([" " + x for x in new.to_numpy(zero_copy_only=False).tolist()]), pa.large_binary())
        place = known.fill_null(0).to_numpy().astype(np.int64)
        place[pc.is_null(known).to_numpy(zero_copy_only=False)] = len(self.parts) + np.arange(len(new))
        all_ = pa.concat_arrays([self.codes, codes])
        starts = self._whole(distinct.take(coded.indices.take(pa.array(first))).to_pylist())
        at = place[coded.indices.to_numpy()]
        at[first] = len(all_) + np.arange(len(first))
        ids = pa.concat_arrays([all_, pa.array(starts, pa.large_binary())]).take(pa.array(at))
        if len(all_) > KEPT_PARTS:
            self.parts, self.codes = distinct, all_.take(pa.array(place))
        else:
            self.parts, self.codes = pa.concat_arrays([self.parts, new]), all_
        _, ends, data = ids.buffers()
        ends, data = np.frombuffer(ends, np.int64)[ids.offset:][bounds].tolist(), memoryview(data or b"")
        return [bytes(data[a:z]) for a, z in zip(ends, ends[1:])]

    def encode_array(self, texts: pa.Array) -> list[bytes]:
        """``encode`` of an array without nulls."""
        if self.lower:
            return self.encode(texts.to_pylist())
        texts = texts.cast(pa.large_string())
        left = pc.or_(pc.match_substring_regex(texts, _OTHER_RE2), pc.match_substring_regex(texts, _INSIDE_RE2))
        for x in self.special:
            left = pc.or_(left, pc.match_substring(texts, x))
        out: list = [None] * len(texts)
        for kind, ids in ((left, lambda t: self.encode(t.to_pylist())), (pc.invert(left), self._cut)):
            own = np.nonzero(kind.to_numpy(zero_copy_only=False))[0].tolist()
            for i, x in zip(own, ids(texts.filter(kind)) if own else []):
                out[i] = x
        return out


@lru_cache(maxsize=2)
def encoder(name: str, folder: str | None = None) -> Encoder:
    """One encoder for each Python worker; it outlives a task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
    return Encoder(name, folder)
