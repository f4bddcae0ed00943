"""Alignment of two tokenizers over the same bytes, by an associative monoid of fragments.

Both tokenizations cover the bytes of a space and the text. Offsets where tokens of both end cut
them into groups. The tokens that end in a byte range make a fragment: an open prefix up to the
first cut, closed groups, an open suffix after the last cut. Composing two neighbours closes one
group, that of the left suffix and the right prefix, so any bracketing gives the same result.
Short documents are one fragment. Those of long ones are composed in a tree over Spark tasks; the
text of their groups never is: it stays in rows that are digested in order.

Every range between two neighbouring ends lies in one token of each side, and is one link. Links
are counted by document: counts are sums over tasks, and go back to the documents in blocks of a
bucket of pairs, so neither the counts nor the links of all documents meet in one place.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm.bpe import byte_letters
from stayledger.llm.common import small_batches, store, tokenizer_path

#: Bytes of a fragment, fragments that one task composes, bytes of text that a task aligns at once.
CHUNK, FAN, AT_ONCE = 1 << 16, 16, 1 << 21
#: Counted pairs of a bucket, links of documents that meet one copy of a bucket, and of a block.
PAIRS, LINKS, BLOCK = 1 << 17, 1 << 20, 1 << 14
#: Pairs that a task counts before it hands them on.
COUNTED = 1 << 21
#: Words kept by a task; at this number they become the older ones, of which those met again stay.
KEPT = 300_000
SPACE = "▁"


class Words:
    """Ids of texts on several sides, by pieces whose ids do not depend on what stands beside them."""

    def __init__(self, split, *encode):
        self.split, self.encode = split, encode
        self.new: list[dict[str, bytes]] = [{} for _ in encode]
        self.old: list[dict[str, bytes]] = [{} for _ in encode]

    def __call__(self, texts: list[str]) -> list[list[np.ndarray]]:
        if len(self.new[0]) > KEPT:
            self.new, self.old = [{} for _ in self.encode], self.new
        words = [self.split(t) for t in texts]
        missing = set().union(*words).difference(self.new[0])
        again = missing.intersection(self.old[0])
        missing = list(missing.difference(again))
        for new, old, encode in zip(self.new, self.old, self.encode):
            new.update((w, old[w]) for w in again)
            if missing:
                new.update(zip(missing, encode(missing)))
        return [[np.frombuffer(b"".join(map(new.__getitem__, w)), "<u2") for w in words] for new in self.new]


class Sides:
    """Both tokenizers of a Python worker: ids of texts, and the bytes of every id."""

    def __init__(self, a: str, b: str, folder: str | None = None):
        import sentencepiece
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(tokenizer_path(a, folder))
        library.encode_special_tokens = True
        library.no_truncation()
        library.no_padding()
        letters = byte_letters()
        names = {i: t for t, i in library.get_vocab(with_added_tokens=True).items()}
        added = {i: t.content.encode() for i, t in library.get_added_tokens_decoder().items()}
        self.a_bytes = [added.get(i) or bytes(map(letters.__getitem__, names[i])) for i in range(len(names))]
        model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(b, folder))
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.b_bytes = [bytes([int(t[3:5], 16)]) if model.is_byte(i) else t.replace(SPACE, " ").encode()
                        for i, t in enumerate(names)]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << 16:
            raise ValueError("vocabularies of at most 65536 ids")
        self.tables = [pa.array(s, pa.large_binary()) for s in (self.a_bytes, self.b_bytes)]
        self.a_size, self.b_size = (np.array([len(x) for x in s], np.int64) for s in (self.a_bytes, self.b_bytes))

        def a_alone(texts: list[str]) -> list[bytes]:
            return [np.array(x.ids, "<u2").tobytes() for x in library.encode_batch_fast(texts, add_special_tokens=False)]

        def b_alone(texts: list[str]) -> list[bytes]:
            """Of pieces that begin with a space, which the model adds itself."""
            bare = [t for t in texts if t.strip(" ")]
            found = dict(zip(bare, model.encode([t[1:] for t in bare], num_threads=1)))
            head = model.encode("a", num_threads=1)
            for t in texts:
                if t not in found:  # spaces only: the model would see nothing after taking one off
                    found[t] = model.encode("a" + t, num_threads=1)[len(head):]
            return [np.array(found[t], "<u2").tobytes() for t in texts]

        def together(texts: list[str], encode, alone, size: np.ndarray) -> list[bytes]:
            """Ids of pieces that stand one after the other in one text, cut at their bytes; alone
            where they end with white space, or where the bytes do not add up."""
            out: list = [None] * len(texts)
            safe = [i for i, t in enumerate(texts) if not t[-1:].isspace()]
            for at in range(0, len(safe), 256):
                own = safe[at:at + 256]
                ids = np.array(encode("".join([texts[i] for i in own])), "<u2")
                stops = np.cumsum([len(texts[i].encode()) for i in own])
                ends = np.cumsum(size[ids])
                cut = np.searchsorted(ends, stops)
                if len(ends) and ends[-1] == stops[-1] and (ends[cut] == stops).all():
                    data, low = ids.tobytes(), 0
                    for i, high in zip(own, (2 * cut + 2).tolist()):
                        out[i] = data[low:high]
                        low = high
            left = [i for i, x in enumerate(out) if x is None]
            for i, x in zip(left, alone([texts[i] for i in left])):
                out[i] = x
            return out

        def by_a(texts: list[str]) -> list[bytes]:
            return together(texts, lambda t: library.encode_batch_fast([t], add_special_tokens=False)[0].ids, a_alone, self.a_size)

        def by_b(texts: list[str]) -> list[bytes]:
            return together(texts, lambda t: model.encode(t[1:], num_threads=1), b_alone, self.b_size)

        # no token of either side holds a space after something else, so both may be cut there
        crossing = re.compile(rf"[^{SPACE}]{SPACE}")
        apart = not any(map(crossing.search, names))
        split = re.compile(r" ++[^ ]*+(?:(?<=[^\S ]) ++[^ ]*+)*+" if apart else r"(?s).+").findall
        self.encode = Words(split, *((by_a, by_b) if apart else (a_alone, b_alone)))
        self.written = [np.array([str(i).encode() + sep for i in range(len(s)) for sep in (b",", b"|", b";")], object)
                        for s in (self.a_bytes, self.b_bytes)]


    def gives(self, a: np.ndarray, b: np.ndarray, data: bytes) -> bool:
        """Whether the tokens of either side, one after the other, are these bytes."""
        for table, size, ids in zip(self.tables, (self.a_size, self.b_size), (a, b)):
            if size[ids].sum() != len(data) or data and table.take(pa.array(ids)).buffers()[2][:len(data)] != data:
                return False
        return True


@lru_cache(maxsize=2)
def sides(a: str, b: str, folder: str | None = None) -> Sides:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
    return Sides(a, b, folder)


Tokens = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # ids and ends of both sides


def both_ends(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Ends of tokens of either side, and those of both, the cuts; ends ascend on each side."""
    ends = np.concatenate([t[1], t[3]])
    ends.sort(kind="stable")
    twice = ends[1:] == ends[:-1]
    return ends[np.append(True, ~twice)[:len(ends)]], ends[1:][twice]


def links(t: Tokens, width: int, ends: np.ndarray | None = None) -> np.ndarray:
    """Pair of ids, as one number, of each link between the tokens; they begin and end together."""
    a, a_end, b, b_end = t
    ends = both_ends(t)[0] if ends is None else ends
    return a[np.searchsorted(a_end, ends)].astype(np.int64) * width + b[np.searchsorted(b_end, ends)]


def cuts(t: Tokens) -> np.ndarray:
    return both_ends(t)[1]


def groups(t: Tokens, at: np.ndarray, side: Sides) -> list[bytes]:
    """The written ids in the order of groups, A before B, each with the mark that follows it.
    The tokens end with the last of the cuts ``at``."""
    a, a_end, b, b_end = t
    a_group, b_group = np.searchsorted(at, a_end), np.searchsorted(at, b_end)
    a_before = np.searchsorted(a_group, np.arange(len(at) + 1))  # tokens in earlier groups
    b_before = np.searchsorted(b_group, np.arange(len(at) + 1))
    mark = np.zeros(len(a), np.int64)
    mark[a_before[1:] - 1] = 1
    out = np.empty(len(a) + len(b), object)
    out[np.arange(len(a)) + b_before[a_group]] = side.written[0][a.astype(np.int64) * 3 + mark]
    mark = np.zeros(len(b), np.int64)
    mark[b_before[1:] - 1] = 2
    out[np.arange(len(b)) + a_before[b_group + 1]] = side.written[1][b.astype(np.int64) * 3 + mark]
    return out.tolist()


def distinct(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, ascending, and how often they occur."""
    if times is None:
        keys = np.sort(keys)
        first = np.nonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])[0]
        return keys[first], np.diff(first, append=len(keys))
    found, back = np.unique(keys, return_inverse=True)
    return found, np.bincount(back, weights=times, minlength=len(found)).astype(np.int64)


def part(t: Tokens, low: int, high: int) -> Tokens:
    """The tokens that end after ``low`` and not after ``high``."""
    a, b = (slice(*np.searchsorted(end, [low, high], "right")) for end in (t[1], t[3]))
    return t[0][a], t[1][a], t[2][b], t[3][b]


def join(x: Tokens, y: Tokens) -> Tokens:
    return tuple(np.concatenate(p) for p in zip(x, y))


_NOTHING: Tokens = (np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.uint16), np.zeros(0, np.int64))


class Fragment:
    """Tokens of a byte range: ``prefix`` up to the first cut, what the closed groups add up to,
    ``suffix`` after the last one. Without a cut all tokens are in ``prefix``. ``last`` numbers
    the chunk of the last cut; ``texts`` holds closed groups as (place, written)."""

    def __init__(self, prefix=_NOTHING, suffix=_NOTHING, last=-1, n_groups=0, n_links=0,
                 pairs=np.zeros(0, np.int64), times=np.zeros(0, np.int64)):
        self.prefix, self.suffix, self.last = prefix, suffix, last
        self.n_groups, self.n_links, self.pairs, self.times = n_groups, n_links, pairs, times
        self.texts: list[tuple[int, bytes]] = []

    def close(self, t: Tokens, at: np.ndarray, place: int, side: Sides) -> None:
        """Take in groups that end at the cuts ``at``."""
        if not len(at):
            return
        keys = links(t, len(side.b_bytes))
        self.n_groups, self.n_links = self.n_groups + len(at), self.n_links + len(keys)
        new, times = distinct(keys)
        self.pairs, self.times = distinct(np.concatenate([self.pairs, new]), np.concatenate([self.times, times]))
        self.texts.append((place, b"".join(groups(t, at, side))[:-1]))

    def then(self, other: Fragment, side: Sides) -> Fragment:
        """The fragment of this range and the one that follows it."""
        if self.last < 0:
            out = Fragment(join(self.prefix, other.prefix), other.suffix, other.last)
        elif other.last < 0:
            out = Fragment(self.prefix, join(self.suffix, other.prefix), self.last)
        else:
            out = Fragment(self.prefix, other.suffix, other.last)
        out.n_groups, out.n_links = self.n_groups + other.n_groups, self.n_links + other.n_links
        out.pairs, out.times = distinct(np.concatenate([self.pairs, other.pairs]), np.concatenate([self.times, other.times]))
        out.texts = self.texts + other.texts
        if self.last >= 0 and other.last >= 0:
            middle = join(self.suffix, other.prefix)
            out.close(middle, cuts(middle), 2 * self.last + 1, side)
        return out

    def whole(self, side: Sides) -> Fragment:
        """Of all ranges of a document: its start and end are cuts, so nothing stays open."""
        out = Fragment(last=self.last, n_groups=self.n_groups, n_links=self.n_links, pairs=self.pairs, times=self.times)
        out.texts = list(self.texts)
        out.close(self.prefix, cuts(self.prefix), -1, side)
        return out


def fragment(t: Tokens, chunk: int, side: Sides) -> Fragment:
    """The fragment of the tokens that end in the byte range number ``chunk``."""
    at = cuts(t)
    if not len(at):
        return Fragment(t)
    out = Fragment(part(t, -1, at[0]), part(t, at[-1], 1 << 62), chunk)
    out.close(part(t, at[0], at[-1]), at[1:], 2 * chunk, side)
    return out


_ROW = ("row long, doc_id long, chunk long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs binary, times binary, last long, a binary, a_end binary, b binary, b_end binary, "
        "a2 binary, a2_end binary, b2 binary, b2_end binary, place long, text binary, kind int")
#: Kinds of rows: finished documents, fragments, text of closed groups.
DONE, OPEN, TEXT = 0, 1, 2
_NAMES = [c.split()[0] for c in _ROW.split(", ")]
_KINDS = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}
                     [c.split()[1]]) for c in _ROW.split(", ")])
_OPEN = ("a", "a_end", "b", "b_end")


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], _KINDS.field(c).type) for c in _NAMES], schema=_KINDS)


def _fields(f: Fragment) -> dict:
    """A fragment as values of a row."""
    out = {"n_groups": f.n_groups, "n_links": f.n_links, "last": f.last, "pairs": f.pairs.astype("<u4").tobytes(),
           "times": f.times.astype("<u4").tobytes()}
    for name, p, s in zip(_OPEN, f.prefix, f.suffix):
        kind = "<i8" if name.endswith("end") else "<u2"
        out[name], out[name.replace("_", "2_") if "_" in name else name + "2"] = p.astype(kind).tobytes(), s.astype(kind).tobytes()
    return out


def _fragment(r: dict) -> Fragment:
    prefix, suffix = (tuple(np.frombuffer(r[n], "<i8" if n.endswith("end") else "<u2") for n in names)
                      for names in (_OPEN, ("a2", "a2_end", "b2", "b2_end")))
    return Fragment(prefix, suffix, r["last"], r["n_groups"], r["n_links"],
                    np.frombuffer(r["pairs"], "<u4").astype(np.int64), np.frombuffer(r["times"], "<u4").astype(np.int64))


def _texts_of(f: Fragment, row: int) -> list[dict]:
    return [{"kind": TEXT, "row": row, "place": place, "text": text} for place, text in f.texts]


def _short(docs: list[tuple], side: Sides) -> list[dict]:
    """Finished rows of documents that are one fragment each: (row, doc_id, a, b)."""
    sizes_a, sizes_b = (np.array([len(d[k]) for d in docs]) for k in (2, 3))
    a, b = (np.concatenate([d[k] for d in docs]) for k in (2, 3))
    t = (a, np.cumsum(side.a_size[a]), b, np.cumsum(side.b_size[b]))
    ends, at = both_ends(t)
    written = groups(t, at, side)
    a_stop, b_stop = np.cumsum(sizes_a), np.cumsum(sizes_b)
    stops = t[1][a_stop - 1]  # every document ends with a cut
    link_stop, cut_stop = np.searchsorted(ends, stops) + 1, np.searchsorted(at, stops) + 1
    which = np.repeat(np.arange(len(docs)), np.diff(link_stop, prepend=0))
    keys, times = distinct((which << 32) + links(t, len(side.b_bytes), ends))
    key_stop = np.searchsorted(keys, np.arange(1, len(docs) + 1) << 32)
    pairs, times = (keys & 0xFFFFFFFF).astype("<u4"), times.astype("<u4")
    out, w, p, c, k = [], 0, 0, 0, 0
    for i, (row, doc, *_) in enumerate(docs):
        end = int(a_stop[i] + b_stop[i])
        out.append({"kind": DONE, "row": row, "doc_id": doc, "n_a": int(sizes_a[i]), "n_b": int(sizes_b[i]),
                    "n_groups": int(cut_stop[i]) - c, "n_links": int(link_stop[i]) - k,
                    "groups_sha256": hashlib.sha256(b"".join(written[w:end])[:-1]).hexdigest(),
                    "pairs": pairs[p:key_stop[i]].tobytes(), "times": times[p:key_stop[i]].tobytes()})
        w, p, c, k = end, int(key_stop[i]), int(cut_stop[i]), int(link_stop[i])
    return out


def _aligned(docs: DataFrame, a: str, b: str, folder: str | None, chunk: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        side, row = sides(a, b, folder), TaskContext.get().partitionId() << 40
        for batch in batches:
            at, sizes = 0, np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False))
            while at < batch.num_rows:  # some bytes of text at once, or one text
                stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + AT_ONCE, "right")))
                texts = [" " + x.decode() if x else "" for x in batch["text"][at:stop].to_pylist()]
                ids = side.encode(texts)
                short, out = [], []
                for doc, text, x, y in zip(batch["doc_id"][at:stop].to_pylist(), texts, *ids):
                    row += 1
                    data = text.encode()
                    if not data or not side.gives(x, y, data):
                        out.append({"kind": DONE, "row": row, "doc_id": doc, "groups_sha256": "", "pairs": b"", "times": b""} | dict.fromkeys(
                            ("n_a", "n_b", "n_groups", "n_links"), 0))
                    elif len(data) <= chunk:
                        short.append((row, doc, x, y))
                    else:
                        tokens = x, np.cumsum(side.a_size[x]), y, np.cumsum(side.b_size[y])
                        for c in range(-(-len(data) // chunk)):
                            own = part(tokens, c * chunk, (c + 1) * chunk)
                            f = fragment(own, c, side)
                            out.append({"kind": OPEN, "row": row, "doc_id": doc, "chunk": c, "n_a": len(own[0]),
                                        "n_b": len(own[2])} | _fields(f))
                            out += _texts_of(f, row)
                if short:
                    out += _short(short, side)
                yield _batch(out)
                at = stop

    return docs.mapInArrow(run, _ROW)


def _composed(parts: DataFrame, fan: int, a: str, b: str, folder: str | None, last: bool) -> DataFrame:
    """Fragments of neighbouring ranges as one, and the text of the groups that this closes."""
    def run(group: pa.Table) -> pa.Table:
        rows, side = group.sort_by("chunk").to_pylist(), sides(a, b, folder)
        total = _fragment(rows[0])
        for r in rows[1:]:
            total = total.then(_fragment(r), side)
        if last:
            total = total.whole(side)
        sums = {c: sum(r[c] for r in rows) for c in ("n_a", "n_b")}
        one = {"kind": OPEN, "row": rows[0]["row"], "doc_id": rows[0]["doc_id"], "chunk": rows[0]["chunk"] // fan} | sums | _fields(total)
        return pa.Table.from_batches([_batch([one, *_texts_of(total, rows[0]["row"])])])

    return parts.select(*_NAMES).withColumn("up", F.floor(F.col("chunk") / fan)).groupBy("row", "up").applyInArrow(
        lambda group: run(group.drop_columns(["up"])), _ROW)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the group texts of each document, which come in order, joined by ``;``."""
    now = state = None
    for batch in batches:
        out = []
        for row, text in zip(batch["row"].to_pylist(), batch["text"].to_pylist()):
            if row != now:
                if now is not None:
                    out.append((now, state.hexdigest()))
                now, state = row, hashlib.sha256(text)
            else:
                state.update(b";")
                state.update(text)
        yield pa.record_batch({"row": pa.array([x for x, _ in out], pa.int64()), "sha": pa.array([x for _, x in out], pa.string())})
    if now is not None:
        yield pa.record_batch({"row": pa.array([now], pa.int64()), "sha": pa.array([state.hexdigest()])})


def _numbers(column: pa.Array) -> np.ndarray:
    """The 32-bit numbers of all values of a binary column, one after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u4")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each pair, summed in the task."""
    pairs, times, open_ = [], [], 0

    def table() -> tuple[np.ndarray, np.ndarray]:
        return distinct(np.concatenate(pairs), np.concatenate(times))

    for batch in batches:
        found, n = np.unique(_numbers(batch["pairs"]), return_counts=True)
        pairs.append(found.astype(np.int64))
        times.append(n)
        open_ += len(found)
        if open_ > 2 * COUNTED:
            p, n = table()
            if len(p) > COUNTED:
                yield pa.record_batch({"pair": p, "n": n})
                pairs, times, open_ = [], [], 0
            else:
                pairs, times, open_ = [p], [n], len(p)
    if pairs:
        p, n = table()
        yield pa.record_batch({"pair": p, "n": n})


_BLOCK = "bucket int, copy int, part int, rows binary, sizes binary, pairs binary, values binary, best binary"


def _mixed(pairs: np.ndarray) -> np.ndarray:
    """Pairs in a mixed order, so that buckets of them are alike in size."""
    return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of some documents that hold about ``most`` pairs together."""
    sizes, at = np.cumsum(pc.binary_length(batch["pairs"]).to_numpy(zero_copy_only=False) // 4), 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def _dealt(buckets: int, copies: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        copy = TaskContext.get().partitionId()
        for batch in (part for whole in batches for part in _slices(whole, BLOCK * buckets)):
            pairs, times = _numbers(batch["pairs"]), _numbers(batch["times"])
            sizes = pc.binary_length(batch["pairs"]).to_numpy(zero_copy_only=False) // 4
            which = np.repeat(np.arange(len(sizes)), sizes)
            bucket = (_mixed(pairs) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            stops = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows, out = batch["row"].to_numpy(), []
            for k in range(buckets):
                own = order[stops[k]:stops[k + 1]]
                if len(own):
                    docs, n = np.unique(which[own], return_counts=True)
                    copy += 1
                    out.append((k, copy % copies, 1, rows[docs].astype("<i8").tobytes(), n.astype("<u4").tobytes(),
                                pairs[own].tobytes(), times[own].tobytes(), None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                    zip(*out), (*[pa.int32()] * 3, *[pa.binary()] * 5))], [c.split()[0] for c in _BLOCK.split(", ")])

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each document over the links of a block; the counts of a bucket come first."""
    now, tables, counts = None, [], None
    for batch in batches:
        for r in batch.to_pylist():
            if r["part"] == 0:
                if now != (r["bucket"], r["copy"]) or counts is not None:
                    now, tables, counts = (r["bucket"], r["copy"]), [], None
                tables.append([np.frombuffer(r[c], k) for c, k in (("pairs", "<u4"), ("values", "<i8"), ("best", np.uint8))])
                continue
            if counts is None:
                counts = [np.concatenate(x) for x in zip(*tables)]
                order = np.argsort(counts[0])
                counts = [x[order] for x in counts]
            at = np.searchsorted(counts[0], np.frombuffer(r["pairs"], "<u4"))
            times = np.frombuffer(r["values"], "<u4").astype(np.int64)
            starts = np.cumsum(np.frombuffer(r["sizes"], "<u4"), dtype=np.int64) - np.frombuffer(r["sizes"], "<u4")
            yield pa.record_batch({
                "row": np.frombuffer(r["rows"], "<i8"), "count_sum": np.add.reduceat(counts[1][at] * times, starts),
                "n_best": np.add.reduceat(counts[2][at] * times, starts)})


def _tables(buckets: int):
    """Counts as blocks of one bucket each."""
    def blocks(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        pair, n, best = (np.concatenate([r[c].to_numpy(zero_copy_only=False) for r in rows]) for c in ("pair", "n", "best"))
        bucket = (_mixed(pair) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        found, starts = np.unique(bucket[order], return_index=True)
        own = np.split(order, starts[1:])
        return pa.record_batch({"bucket": pa.array(found, pa.int32())} | {c: pa.array(
            [x[k].astype(kind).tobytes() for k in own], pa.binary()) for c, x, kind in (
                ("pairs", pair, "<u4"), ("values", n, "<i8"), ("best", best, np.uint8))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held, size = [*held, batch], size + batch.num_rows
            if size > COUNTED:
                yield blocks(held)
                held, size = [], 0
        if size:
            yield blocks(held)

    return run


def align(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", folder: str | None = None,
          chunk: int = CHUNK, fan: int = FAN, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row.

    Links are pairs of an A and a B token whose bytes overlap; the count of a pair of ids is the
    number of rows with such a link. ``n_best`` counts links whose count is the highest of their A
    id, ``count_sum`` adds up counts over links. ``groups_sha256`` digests the ids of the groups as
    ``a1,a2|b1;a3|b2``. Null and empty texts, and those that a tokenizer does not give back byte
    by byte, have zeros and an empty digest. A null id is an id like any other, repeated rows are
    documents of their own; other columns play no part; no rows give no rows.
    """
    if not (chunk > 0 and fan > 1):
        raise ValueError("chunk: 1 at least; fan: 2 at least")
    small_batches(docs.sparkSession)
    given = docs.select(F.col(id).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    rows = store(_aligned(given, a, b, folder, chunk), "aligned", by=["kind"])
    parts, written = rows.where(F.col("kind") == OPEN), rows.where(F.col("kind") == TEXT).select("row", "place", "text")
    width = (parts.agg(F.max("chunk")).first()[0] or 0) + 1
    while width:  # one level of the tree for each round, the last one closes the documents
        width = 0 if width <= fan else -(-width // fan)
        level = store(_composed(parts, fan, a, b, folder, not width), "composed", by=["kind"])
        parts = level.where(F.col("kind") == OPEN)
        written = written.unionByName(level.where(F.col("kind") == TEXT).select("row", "place", "text"))
    digests = written.repartition("row").sortWithinPartitions("row", "place").mapInArrow(_digests, "row long, sha string")
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    short = rows.where(F.col("kind") == DONE)
    whole = short.select("row", "doc_id", *numbers, "groups_sha256").unionByName(
        parts.join(digests, "row").select("row", "doc_id", *numbers, F.col("sha").alias("groups_sha256")))
    found = short.where("n_links > 0").select("row", "pairs", "times").unionByName(parts.select("row", "pairs", "times"))
    counts = store(found.select("pairs").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n")), "counts")
    size = counts.count()
    total = found.agg(F.sum(F.length("pairs"))).first()[0] or 0
    buckets = -(-size // PAIRS) or 1
    copies = -(-total // (4 * LINKS * buckets)) or 1
    width = len(sides(a, b, folder).b_bytes)
    best = counts.groupBy(F.floor(F.col("pair") / width).alias("a")).agg(F.max("n").alias("most"))
    tables = counts.withColumn("a", F.floor(F.col("pair") / width)).join(best, "a").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))

    blocks = tables.mapInArrow(_tables(buckets), "bucket int, pairs binary, values binary, best binary").select(
        "bucket", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), F.lit(0).alias("part"),
        F.lit(None).cast("binary").alias("rows"), F.lit(None).cast("binary").alias("sizes"), "pairs", "values", "best")
    met = blocks.unionByName(found.mapInArrow(_dealt(buckets, copies), _BLOCK)).repartition("bucket", "copy").sortWithinPartitions(
        "bucket", "copy", "part").mapInArrow(_met, "row long, count_sum long, n_best long")
    sums = met.groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    return whole.join(sums, "row", "left").select("doc_id", *numbers, F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce(
        "count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
