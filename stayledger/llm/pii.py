"""Personal data by rules and by boosted trees over candidates, in DataFrame functions only.

Rules find the base spans. They take the longest run of characters, so a number beside another
one is lost with it. Therefore generators of high recall propose spans that may overlap: cards
and phone numbers in groups, addresses, names before an ``@``. Boosted trees judge each candidate
by its format and by the characters beside it; they learn from all candidates that the rules
decide, in all texts. These are counted by format and context first, so what the trees pass over
again and again has a row for each of these, with the count as its weight, and not one for each candidate.
A threshold for each kind is calibrated on candidates that the trees have not seen. What reaches
it, and overlaps no base span and no better candidate, is added; base spans always stay.

The trees become column expressions: a document is read once, in one stage without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.llm.common import store

KINDS = ("email", "ip", "card", "phone")
TREES, DEPTH, PRECISION = 12, 4, 0.99

_LOCAL, _DOMAIN = "A-Za-z0-9._%+-", "A-Za-z0-9-"
#: Base patterns. A run of characters is entered at its start or where the match before ended, and
#: is never given back, so the time is linear; the matches are those of the plain patterns.
_BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[{_DOMAIN}]++(?:\.[{_DOMAIN}]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]"}
#: What a text must hold for a base pattern or a generator of the kind to be tried.
_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": "[0-9][ ().-]*[0-9]"}
#: Generators: the candidate is what may follow a position.
_CANDIDATES = {
    "email": [rf"(?<![{_LOCAL}])(?=([{_LOCAL}]{{1,64}}+@[{_DOMAIN}]{{1,63}}+(?:\.[{_DOMAIN}]{{1,63}}+){{0,8}}+)"],
    "ip": [r"(?<![0-9])(?=([0-9]{1,4}(?:\.[0-9]{1,4}){3})(?![0-9])"],
    "card": [r"(?<![0-9])(?=([0-9]{4}(?:[ -]?[0-9]{4}){3})(?![0-9])",
             r"(?<![0-9])(?=([0-9](?:[ -]?[0-9]){11,18})(?![0-9])"],
    "phone": [r"(?=(\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2})(?![0-9])",
              r"(?=(\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){3})(?![0-9])",
              r"(?<![0-9+])(?=(\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9])",
              r"(?<![0-9])(?=([0-9]{3}[ .-][0-9]{4})(?![0-9])"]}

_OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
_SPAN = "array<struct<kind:int,start:int,stop:int,score:double>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often functions in it read it."""
    return F.transform(F.array(value), use)[0]


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda s, x: s + x)


def _luhn(digits: Column) -> Column:
    """Whether a short string of digits passes the check sum of card numbers."""
    def total(reverse: Column) -> Column:
        def add(s: Column, i: Column) -> Column:
            x = F.substr(reverse, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
            return s + x - F.when(x > 9, 9).otherwise(0)

        return F.aggregate(F.sequence(F.lit(1), F.length(reverse)), F.lit(0), add) % 10 == 0

    return _let(F.reverse(digits), total)


def _class(char: Column) -> Column:
    """Kind of a neighbouring character; none: 0."""
    return (F.when(char == "", 0).when(char.rlike("[0-9]"), 3).when(char.rlike(r"\s"), 1)
            .when(char.rlike(r"\p{L}"), 2).otherwise(4))


def _features(c: Column) -> Column:
    """Format and context of a candidate as numbers."""
    value, before, after, n = c.value, c.before, c.after, F.length(c.digits)
    return F.array(*[x.cast("double") for x in (
        c.kind, F.length(value), n, c.luhn, value.rlike(_OCTETS), value.startswith("+"), F.length(value) - n,
        F.length(F.regexp_replace(value, r"[^.]", "")), value.contains("@"), value.contains("("),
        _class(before), _class(after))])


def _judged(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``text``), ``base``: all matches of the base patterns as array<struct<kind,
    start, stop, valid>>, and ``candidates``: array<struct<kind, start, stop, features>>.

    A text is split where a pattern matches; running lengths of the parts are the places. They
    are summed in blocks, so that a text with very many matches stays cheap.
    """
    sources = [(k, name, _BASE[name], True) for k, name in enumerate(KINDS)]
    sources += [(k, name, pattern + r"([\s\S]?))", False) for k, name in enumerate(KINDS) for pattern in _CANDIDATES[name]]
    text, names = F.col("text"), [f"x{i}" for i in range(len(sources))]
    rows = rows.withColumns({x: F.when(text.rlike(_HINT[name]), F.struct(
        F.split(text, pattern, -1).alias("parts"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0 if base else 1)).alias("value"),
        (F.array().cast("array<string>") if base else F.regexp_extract_all(text, F.lit(pattern), F.lit(2))).alias("after")))
        for x, (_, name, pattern, base) in zip(names, sources)})
    # what lies between matches; splitting by empty matches leaves out an empty first part
    gaps = {x: F.slice(F.when(F.size(f"{x}.parts") > F.size(f"{x}.value"), F.col(f"{x}.parts")).otherwise(
        F.concat(F.array(F.lit("")), F.col(f"{x}.parts"))), F.lit(1), F.size(f"{x}.value")) for x in names}
    rows = rows.withColumns({f"before_{x}": g for x, g in gaps.items()})
    lengths = [F.zip_with(f"before_{x}", f"{x}.value", (lambda p, v: F.length(p) + F.length(v)) if base else (
        lambda p, v: F.length(p))) for x, (*_, base) in zip(names, sources)]
    block, none = 64, F.array().cast("array<int>")
    rows = rows.withColumn("lengths", F.array(*[F.coalesce(x, none) for x in lengths]))
    rows = rows.withColumn("blocks", F.transform("lengths", lambda all_: F.when(F.size(all_) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / block).cast("int")),
        lambda b: F.slice(all_, b * block + 1, F.lit(block)))).otherwise(F.array().cast("array<array<int>>"))))
    rows = rows.withColumn("sums", F.transform("blocks", lambda all_: F.transform(all_, _sum)))
    rows = rows.withColumn("places", F.zip_with("blocks", "sums", lambda all_, sums: F.flatten(F.transform(
        all_, lambda part, b: _let(_sum(F.slice(sums, F.lit(1), b)), lambda before: F.transform(
            part, lambda x, i: before + _sum(F.slice(part, F.lit(1), i + 1))))))))
    matches, proposals = [], []
    for i, (x, (kind, _, _, base)) in enumerate(zip(names, sources)):
        zipped = F.arrays_zip(F.col(f"{x}.value").alias("value"), F.col(f"{x}.after").alias("after"),
                              F.col(f"before_{x}").alias("before"), F.col("places")[i].alias("place"))
        back = -1 if base else 0  # places of base matches are their ends
        found = F.transform(zipped, lambda c: F.struct(
            F.lit(kind).alias("kind"), (c.place + back * F.length(c.value)).alias("start"),  # noqa: B023
            (c.place + (back + 1) * F.length(c.value)).alias("stop"), c.value.alias("value"),  # noqa: B023
            F.right(c.before, F.lit(1)).alias("before"), F.coalesce(c.after, F.lit("")).alias("after"),
            F.regexp_replace(c.value, "[^0-9]", "").alias("digits")))
        (matches if base else proposals).append(F.coalesce(found, F.array().cast(
            "array<struct<kind:int,start:int,stop:int,value:string,before:string,after:string,digits:string>>")))
    rows = rows.select("doc_id", "text", F.concat(*matches).alias("matches"), F.concat(*proposals).alias("proposals"))
    rows = rows.withColumns({c: F.transform(c, lambda m: m.withField("luhn", F.when(
        F.length(m.digits).between(12, 19), _luhn(m.digits)).otherwise(False))) for c in ("matches", "proposals")})

    def valid(m: Column) -> Column:
        size = F.length(m.digits)
        return (F.when(m.kind == 0, True).when(m.kind == 1, m.value.rlike(_OCTETS))
                .when(m.kind == 2, size.between(16, 19) & m.luhn).otherwise(size.between(8, 15)))

    return rows.select(
        "doc_id", "text",
        F.transform("matches", lambda m: F.struct(m.kind, m.start, m.stop, valid(m).alias("valid"))).alias("base"),
        F.transform("proposals", lambda c: F.struct(c.kind, c.start, c.stop, _features(c).alias("features"))).alias("candidates"))


def _texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def _blocks(spans: str, wanted: Callable[[Column], Column]) -> Column:
    """The ``wanted`` spans in blocks, about as many as one holds, with the range of each, so that
    texts with very many spans stay cheap."""
    def cut(all_: Column, size: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(all_) / size).cast("int")), lambda b: _let(
            F.slice(all_, b * size + 1, size), lambda part: F.struct(
                F.array_min(F.transform(part, lambda x: x.start)).alias("start"),
                F.array_max(F.transform(part, lambda x: x.stop)).alias("stop"), part.alias("part"))))

    return _let(F.filter(spans, wanted), lambda all_: _let(
        F.greatest(F.ceil(F.sqrt(F.size(all_))), F.lit(16)).cast("int"), lambda size: cut(all_, size)))


def _overlaps(blocks: Column, c: Column) -> Column:
    """Whether a candidate overlaps a span of ``_blocks``."""
    def over(x: Column) -> Column:
        return (x.start < c.stop) & (x.stop > c.start)

    return F.exists(blocks, lambda b: over(b) & F.exists(b.part, over))


def labelled(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(kind, features, label, held_out, n): how many candidates that the rules decide have these
    features, over all texts.

    A candidate that is a base span of its kind is a case; one that overlaps a base span of its
    kind, or no match of a rule at all, is none; one inside a match that a rule has dropped is
    left out.
    """
    rows = _texts(docs, id, text).where(F.col("text").rlike("[0-9@]"))  # without these, no candidates
    # stored, so that no filter or generator on top is judged in place of what it reads
    found = store(_judged(rows).select(F.pmod(F.xxhash64("text"), F.lit(4)).alias("fold"), "base", "candidates"), "judged")

    def valid(kind: int) -> Callable[[Column], Column]:
        return lambda b: b.valid & (b.kind == kind)

    def label(c: Column, spans: Column) -> Column:
        def exact(b: Column) -> Column:
            return (b.start == c.start) & (b.stop == c.stop)

        own, dropped = spans[c.kind], spans[len(KINDS)]
        case = F.exists(own, lambda b: (b.start <= c.start) & (b.stop >= c.stop) & F.exists(b.part, exact))
        return F.when(case, 1.0).when(_overlaps(own, c), 0.0).when(
            _overlaps(dropped, c) & _plausible(c), None).otherwise(0.0)

    blocks = F.array(*[_blocks("base", valid(k)) for k in range(len(KINDS))], _blocks("base", lambda b: ~b.valid))
    labels = _let(blocks, lambda spans: F.transform("candidates", lambda c: F.struct(
        c.kind.alias("kind"), c.features.alias("features"), label(c, spans).alias("label"))))
    # an outer explode, as Spark filters by what a plain one reads and so computes it twice
    decided = found.where(F.size("candidates") > 0).select((F.col("fold") == 0).alias("held_out"), F.explode_outer(labels).alias("c"))
    return decided.select("c.*", "held_out").where("label IS NOT NULL").groupBy(
        "kind", "features", "label", "held_out").agg(F.count("*").alias("n"))


def _plausible(c: Column) -> Column:
    """Whether the format of a candidate alone would pass the rule of its kind."""
    digits = c.features[2]
    return (F.when(c.kind == 0, True).when(c.kind == 1, c.features[4] == 1)
            .when(c.kind == 2, digits.between(16, 19) & (c.features[3] == 1))
            .otherwise(digits.between(8, 15) & (c.features[5] == 1)))


def _expression(tree: list[tuple[int, str]], features: Column) -> Column:
    """A tree of the model's printed form as nested conditions."""
    depth, line = tree[0]
    if line.startswith("Predict"):
        return F.lit(float(line.split(":")[1]))
    number, bound = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    other = next(i for i, (d, _) in enumerate(tree) if d == depth and i)
    return F.when(features[int(number)] <= float(bound), _expression(tree[1:other], features)).otherwise(
        _expression(tree[other + 1:], features))


class Trees:
    """Boosted trees, and the score from which on each kind of candidate counts."""

    def __init__(self, printed: str = "", thresholds: dict[int, float] | None = None):
        self.trees: list[tuple[float, list[tuple[int, str]]]] = []
        self.thresholds = thresholds or {}
        for line in printed.split("\n")[1:]:
            if head := re.match(r"\s*Tree \d+ \(weight (\S+)\)", line):
                self.trees.append((float(head[1]), []))
            elif line.strip():
                self.trees[-1][1].append((len(line) - len(line.lstrip()), line.strip()))

    def score(self, features: Column) -> Column:
        margin = sum((F.lit(weight) * _expression(tree, features) for weight, tree in self.trees), F.lit(0.0))
        return 1 / (1 + F.exp(-2 * margin))

    def accepts(self, kind: Column, score: Column) -> Column:
        enough = F.lit(False)
        for k, bound in self.thresholds.items():
            enough = F.when(kind == k, score >= bound).otherwise(enough)
        return enough


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text") -> Trees:
    """Trees learnt from three quarters of all labelled candidates (those of three quarters of the
    texts), and for each kind the lowest score, in hundredths and from 0.5 on, at which the share
    of cases among all other candidates from there on is ``PRECISION``. Without cases, or without
    others, nothing is accepted."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    rows = store(labelled(docs, id, text), "candidates")
    train = rows.where("NOT held_out")
    if train.agg(F.countDistinct("label")).first()[0] < 2:
        return Trees()
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=7, featuresCol="v", weightCol="n").fit(
        train.select("label", "n", array_to_vector("features").alias("v")))
    trees = Trees(model.toDebugString)
    bins = rows.where("held_out").groupBy("kind", F.floor(trees.score(F.col("features")) * 100).alias("bin")).agg(
        F.sum(F.col("label") * F.col("n")).alias("cases"), F.sum("n").alias("n")).collect()  # 4 kinds, 101 bins
    for kind in range(len(KINDS)):
        cases = n = 0
        for r in sorted((r for r in bins if r.kind == kind and r.bin >= 50), key=lambda r: -r.bin):
            cases, n = cases + r.cases, n + r.n
            if cases >= PRECISION * n:
                trees.thresholds[kind] = r.bin / 100
    return trees


def _added(rows: DataFrame, trees: Trees) -> DataFrame:
    """``added``: candidates that the trees accept, without those that overlap a base span or a
    better candidate, in order of their starts."""
    rows = rows.withColumn("good", F.transform("candidates", lambda c: F.struct(
        c.kind, c.start, c.stop, trees.score(c.features).alias("score"))))
    rows = rows.withColumn("good", F.filter("good", lambda c: trees.accepts(c.kind, c.score)))

    def pack(end: Column, done: Column, kept: Column, best: Column) -> Column:
        return F.struct(end.alias("end"), done.alias("done"), kept.alias("kept"), best.alias("best"))

    def step(s: Column, c: Column) -> Column:
        own, full = c.span, F.size(s.kept) >= 256  # full arrays are set aside, so that appending stays cheap
        return (F.when(c.rank == 0, pack(F.greatest(s.end, own.stop), s.done, s.kept, F.filter(s.best, lambda b: b.stop <= own.start)))
                .when(own.start < s.end, s)
                .when(F.exists(s.best, lambda b: b.stop > own.start), F.when(
                    F.exists(s.best, lambda b: b.score < own.score), pack(s.end, s.done, s.kept, F.array(own))).otherwise(s))
                .when(full, pack(s.end, F.concat(s.done, F.array(s.kept)), s.best, F.array(own)))
                .otherwise(pack(s.end, s.done, F.concat(s.kept, s.best), F.array(own))))

    none, nothing = F.array().cast(_SPAN), F.array().cast(f"array<{_SPAN}>")
    ranked = F.array_sort(F.concat(*[F.transform(c, lambda x: F.struct(
        x.start.alias("start"), F.lit(rank).alias("rank"), x.alias("span")))  # noqa: B023
        for rank, c in enumerate(("base", "good"))]))
    return rows.withColumn("added", F.when(F.size("good") > 0, F.aggregate(
        ranked, pack(F.lit(-1), nothing, none, none), step,
        lambda s: F.concat(F.flatten(s.done), s.kept, s.best))).otherwise(none))


def find(docs: DataFrame, trees: Trees, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, base, added) for each row: array<struct<kind, start, stop, score>> of the
    base spans, by kind in the order of ``KINDS`` and then by start, and of added ones by start.
    Starts and stops count code points, the stop is exclusive; the score of a base span is 1.

    Null texts are empty and hold no spans; rows without an id and repeated rows are rows like
    any other; other columns play no part; no rows give no rows.
    """
    rows = _judged(_texts(docs, id, text)).withColumn("base", F.transform(F.filter("base", lambda m: m.valid), lambda m: F.struct(
        m.kind, m.start, m.stop, F.lit(1.0).alias("score"))))
    return _added(rows, trees).select("doc_id", "text", "base", "added")


def personal_data(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``find`` by trees that are fitted on the same documents."""
    return find(docs, fit(docs, id, text), id, text)


def redacted(found: DataFrame) -> DataFrame:
    """``found``, as ``find`` returns it, with the text in ``redacted``: every span, and what
    overlapping spans cover together, is replaced by the kind of the first in square brackets."""
    spans = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(s.start, s.stop, s.kind)))
    names = F.array(*[F.lit(k) for k in KINDS])

    def step(s: Column, x: Column) -> Column:
        apart = F.struct(F.greatest(s.at, x.stop).alias("at"), F.concat(s.out, F.array(
            F.substr(F.col("text"), s.at + 1, x.start - s.at), F.concat(F.lit("["), names[x.kind], F.lit("]")))).alias("out"))
        return F.when(x.start >= s.at, apart).otherwise(F.struct(F.greatest(s.at, x.stop).alias("at"), s.out.alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return found.withColumn("redacted", F.aggregate(spans, start, step, lambda s: F.concat(
        F.array_join(s.out, ""), F.substr(F.col("text"), s.at + 1))))


def printed(spans: Column) -> Column:
    """Spans as kind:start:stop, by kind and start, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(s.kind, s.start, s.stop))), lambda s: F.concat_ws(
        ":", names[s.kind], s.start.cast("string"), s.stop.cast("string"))), ",")
