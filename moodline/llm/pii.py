"""Personal data: candidate spans, boosted trees, calibrated thresholds. DataFrame functions only.

High-recall generators propose spans that may overlap. Some pass the exact rules of a kind (e-mail
address, IP address, card number, phone number); they are base spans and always stay. Boosted trees
score every candidate by its format and context, with "touches a base span of its kind" as label.
Being labelled is not the same as being personal data: a card number with one wrong digit looks like
a card number. So scores are set in relation to the mean score of a kind's labelled candidates
(Elkan & Noto 2008), and a candidate is selected from half of that on. Selected ones that touch no base
span are added, of overlapping ones the first, of equal starts the longest.

All features are small integers, so the whole corpus' candidates make a table of distinct feature
rows with counts, whose size doesn't grow with the corpus; the trees are grown on it and become a SQL
expression. Texts are read once; nothing of theirs is shuffled.

A null or empty text has no spans. Repeated rows and ties get equal results. Positions are code
points, ends exclusive. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.session import stage

KINDS = ("email", "ip", "card", "phone")

#: The patterns of base spans. They match what the stated rules match, written without
#: backtracking: a word without @ is passed in one step, however long it is.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
DIGITS = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

#: Wider generators: written-out or spaced addresses, phone numbers without a country code.
EMAIL_WIDE = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|[\[({] ?at ?[\])}]) ?"
    r"[A-Za-z0-9-]++(?: ?(?:\.|[\[({] ?dot ?[\])}]) ?[A-Za-z0-9-]++)*+"
)
PHONE_WIDE = r"(?<![0-9A-Za-z])(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]{0,2}[0-9]{2,4}){2,4}(?![0-9A-Za-z])"

#: Context: words that go with personal data, and with other numbers.
CUE = r"(?i)\b(?:e-?mail|mail|phone|tel|telephone|mobile|call|fax|contact|card|visa|ip|host|address)\b"
OTHER = r"(?i)(?:\b(?:version|token|key|order|invoice|isbn|sku|build|page|id|no)\b|[=#\"])"
BEFORE, AFTER = 24, 1  # characters of context

FEATURES = ("kind", "digits", "marks", "left", "right", "cue", "other", "form")
ROUNDS, DEPTH, RATE, SMOOTH = 16, 3, 0.5, 1.0
SELECT = 0.5  # of the mean score of labelled candidates
CHUNK = 256


def _scan(values: Column, start: Column) -> Column:
    """start and all running sums after it."""
    return F.aggregate(
        values, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
    )


def running_starts(values: Column) -> Column:
    """Sum of all values before each one, in chunks: a scan copies its array at every step."""
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")),
        lambda k: F.slice(values, k * CHUNK + 1, F.lit(CHUNK)),
    )
    sums = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x))
    starts = _scan(sums, F.lit(0))
    return F.flatten(
        F.transform(chunks, lambda c, k: F.slice(_scan(c, F.element_at(starts, k + 1)), F.lit(1), F.size(c)))
    )


SPAN = "struct<kind:int,start:int,end:int,value:string,before:string,after:string>"


def _spans(found: Column, gaps: Column, starts: Column, kind: int) -> Column:
    """kind, start, end, value, before, after of the matches ``found``.

    ``gaps`` is the text split by the pattern; ``starts`` are where each gap begins. All three are
    columns of the row: an expression would be evaluated anew for every match.
    """
    def span(v: Column, i: Column) -> Column:
        gap = F.get(gaps, i)
        begin = F.get(starts, i) + F.length(gap)
        return F.struct(
            F.lit(kind).alias("kind"),
            begin.alias("start"),
            (begin + F.length(v)).alias("end"),
            v.alias("value"),
            F.substring(gap, -BEFORE, BEFORE).alias("before"),
            F.substring(F.get(gaps, i + 1), 1, AFTER).alias("after"),
        )

    return F.when(F.size(found) > 0, F.transform(found, span)).otherwise(F.array().cast(f"array<{SPAN}>"))


def _steps(found: Column, gaps: Column) -> Column:
    """Lengths of each gap with the match after it."""
    return F.transform(found, lambda v, i: F.length(F.get(gaps, i)) + F.length(v))


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        double = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, double).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(c: Column) -> Column:
    """The rule of a base candidate's kind."""
    digits = _only_digits(c["value"])
    n = F.length(digits)
    card = F.when(n.between(16, 19), _luhn(digits)).otherwise(False)
    return (
        F.when(c["kind"] == 0, True)
        .when(c["kind"] == 1, c["value"].rlike(rf"\A{OCTET}(?:\.{OCTET}){{3}}\z"))
        .when(c["kind"] == 2, card)
        .otherwise(n.between(8, 15))
    )


def _char_class(char: Column) -> Column:
    return (
        F.when(char == "", 0)
        .when(char.rlike(r"\A\s"), 1)
        .when(char.rlike(r"\A\p{L}"), 2)
        .when(char.rlike(r"\A[0-9]"), 3)
        .otherwise(4)
    )


def _form(c: Column) -> Column:
    v = c["value"]
    return (
        F.when(v.rlike(r"\A[^ @]+@[^ @]+\.[^ @]+\z"), 1)
        .when(v.contains("@"), 2)
        .when(v.rlike(r"[\[({] ?at"), 3)
        .when(v.rlike(r"\A[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}\z"), 4)
        .when(v.rlike(r"\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}\z"), 5)
        .when(v.rlike(r"\A[0-9]{1,3}(?:\.[0-9]{1,3}){3}\z"), 6)
        .otherwise(0)
    )


def _featured(c: Column, base: Column) -> Column:
    n = F.length(_only_digits(c["value"]))
    size = (
        F.when(n < 7, 0).when(n < 8, 1).when(n < 10, 2).when(n < 13, 3).when(n < 16, 4).when(n == 16, 5)
        .when(n < 20, 6).otherwise(7)
    )
    mark = [F.when(c["value"].contains(m), 1 << k).otherwise(0) for k, m in enumerate(" .(-")]
    return F.struct(
        c["kind"].alias("kind"),
        c["start"].alias("start"),
        c["end"].alias("end"),
        base.alias("base"),
        size.alias("digits"),
        (mark[0] + mark[1] + mark[2] + mark[3]).alias("marks"),
        _char_class(F.substring(c["before"], -1, 1)).alias("left"),
        _char_class(c["after"]).alias("right"),
        c["before"].rlike(CUE).cast("int").alias("cue"),
        c["before"].rlike(OTHER).cast("int").alias("other"),
        _form(c).alias("form"),
    )


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``found``: every candidate of a document with its features, by start."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    patterns = {"email": (EMAIL, 0), "ip": (IP, 1), "card": (DIGITS, 2), "phone": (PHONE, 3)}
    wide = {"email_wide": (EMAIL_WIDE, 0), "phone_wide": (PHONE_WIDE, 3)}
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    generators = {**patterns, **wide}
    # step by step: each result is a column before its many uses
    rows = rows.select("id", "text", *[F.regexp_extract_all("text", F.lit(p), 0).alias(g) for g, (p, _) in generators.items()])
    gaps = {g: F.when(F.size(g) > 0, F.split("text", p, -1)).alias(f"{g}_gaps") for g, (p, _) in generators.items()}
    rows = rows.select("id", *generators, *gaps.values())
    rows = rows.select("*", *[_steps(F.col(g), F.col(f"{g}_gaps")).alias(f"{g}_steps") for g in generators])
    rows = rows.select("*", *[running_starts(F.col(f"{g}_steps")).alias(f"{g}_starts") for g in generators])
    spans = rows.select(
        "id",
        *[
            _spans(F.col(g), F.col(f"{g}_gaps"), F.col(f"{g}_starts"), kind).alias(g)
            for g, (_, kind) in generators.items()
        ],
    )
    ruled = F.concat(*[F.transform(name, lambda c: _featured(c, _valid(c))) for name in patterns])
    extra = F.concat(*[F.transform(name, lambda c: _featured(c, F.lit(False))) for name in wide])
    # numbers of few digits are no candidates
    long_enough = F.filter(F.concat(ruled, extra), lambda c: c["base"] | (c["kind"] < 2) | (c["digits"] > 0))
    return spans.select("id", F.array_sort(long_enough, _by_start).alias("found"))


def _by_start(a: Column, b: Column) -> Column:
    """Order by start, base first, longer first, then kind."""
    keys = [(a["start"], b["start"]), (b["base"].cast("int"), a["base"].cast("int")), (b["end"], a["end"]), (a["kind"], b["kind"])]
    out = F.lit(0)
    for x, y in reversed(keys):
        out = F.when(x < y, -1).when(x > y, 1).otherwise(out)
    return out


def touching(found: Column) -> Column:
    """Each candidate with ``touch``: the kinds, as bits, of base spans that it overlaps.

    Two sweeps by start: from the left for base spans that begin before it, from the right for
    those that begin in it. Each remembers the furthest end, or nearest start, of every kind.
    """
    empty = "array<struct<c:struct<{}>,touch:int>>"
    fields = "kind:int,start:int,end:int,base:boolean,digits:int,marks:int,left:int,right:int,cue:int,other:int,form:int"
    empty = empty.format(fields)

    def sweep(spans: Column, item, limit: int, seen, hits) -> Column:
        def step(acc: Column, x: Column) -> Column:
            c, touch = item(x)
            ends = [acc[f"e{k}"] for k in range(4)]
            bits = touch
            for k in range(4):
                bits = bits.bitwiseOR(F.when(hits(c, ends[k]), 1 << k).otherwise(0))
            new = [F.when(c["base"] & (c["kind"] == k), seen(c, ends[k])).otherwise(ends[k]) for k in range(4)]
            return F.struct(
                *[v.alias(f"e{k}") for k, v in enumerate(new)],
                F.concat(acc["out"], F.array(F.struct(c.alias("c"), bits.alias("touch")))).alias("out"),
            )

        start = F.struct(*[F.lit(limit).alias(f"e{k}") for k in range(4)], F.array().cast(empty).alias("out"))
        return F.aggregate(spans, start, step, lambda acc: acc["out"])

    right = sweep(
        found, lambda x: (x, F.lit(0)), -1,
        lambda c, e: F.greatest(c["end"], e), lambda c, e: c["start"] < e,
    )
    left = sweep(
        F.reverse(right), lambda x: (x["c"], x["touch"]), 2**31 - 1,
        lambda c, e: F.least(c["start"], e), lambda c, e: c["end"] > e,
    )
    return F.reverse(left)


# --- boosted trees over a table of distinct feature rows ---------------------------------


def grow(rows: list[tuple[tuple[int, ...], float, float]]) -> tuple[float, list]:
    """Trees on (features, number of candidates, number labelled); ``rows`` are distinct.

    A tree is a leaf's value or (feature, value, tree if equal, tree if not).
    """
    total, hits = sum(n for _, n, _ in rows), sum(y for _, _, y in rows)
    rate = min(max(hits / total, 1e-6), 1 - 1e-6) if total else 0.5
    start = math.log(rate / (1 - rate))
    score = [start] * len(rows)
    trees = []
    for _ in range(ROUNDS if rows else 0):
        slope, curve = [], []
        for (_, n, y), s in zip(rows, score, strict=True):
            p = 1 / (1 + math.exp(-s))
            slope.append(y - n * p)
            curve.append(n * p * (1 - p))
        tree = _node(rows, slope, curve, list(range(len(rows))), DEPTH)
        trees.append(tree)
        score = [s + _leaf(tree, x) for s, (x, _, _) in zip(score, rows, strict=True)]
    return start, trees


def _node(rows, slope, curve, here, depth):
    g, h = sum(slope[i] for i in here), sum(curve[i] for i in here)
    best, cut = 1e-6, None
    for f in range(len(FEATURES)) if depth else ():
        sums: dict[int, list[float]] = {}
        for i in here:
            s = sums.setdefault(rows[i][0][f], [0.0, 0.0])
            s[0] += slope[i]
            s[1] += curve[i]
        for v in sorted(sums) if len(sums) > 1 else ():
            a, b = sums[v]
            gain = a * a / (b + SMOOTH) + (g - a) ** 2 / (h - b + SMOOTH) - g * g / (h + SMOOTH)
            if gain > best + 1e-9:
                best, cut = gain, (f, v)
    if cut is None:
        return RATE * g / (h + SMOOTH)
    f, v = cut
    same = [i for i in here if rows[i][0][f] == v]
    rest = [i for i in here if rows[i][0][f] != v]
    return f, v, _node(rows, slope, curve, same, depth - 1), _node(rows, slope, curve, rest, depth - 1)


def _leaf(tree, x: tuple[int, ...]) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] == tree[1] else tree[3]
    return tree


def _expression(tree, c: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    f, v, same, rest = tree
    return F.when(c[FEATURES[f]] == v, _expression(same, c)).otherwise(_expression(rest, c))


class Selector:
    """Trees with a threshold for each kind."""

    def __init__(self, rows: list[tuple[tuple[int, ...], float, float]]):
        self.start, self.trees = grow(rows)
        self.thresholds = []
        for kind in range(len(KINDS)):
            own = [(x, y) for x, _, y in rows if x[0] == kind and y]
            labelled = sum(y for _, y in own)
            mean = sum(self.probability(x) * y for x, y in own) / labelled if labelled else 2.0
            self.thresholds.append(SELECT * mean)

    def probability(self, x: tuple[int, ...]) -> float:
        return 1 / (1 + math.exp(-self.start - sum(_leaf(t, x) for t in self.trees)))

    def selected(self, c: Column) -> Column:
        score = F.lit(self.start)
        for tree in self.trees:
            score = score + _expression(tree, c)
        least = F.lit(2.0)
        for kind, t in enumerate(self.thresholds):
            least = F.when(c["kind"] == kind, t).otherwise(least)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-score)) >= least


def _added(marked: Column, selector: Selector) -> Column:
    """Selected candidates beside all base spans, of overlapping ones the first."""
    free = F.transform(
        F.filter(marked, lambda x: ~x["c"]["base"] & (x["touch"] == 0) & selector.selected(x["c"])),
        lambda x: x["c"],
    )

    def step(acc: Column, c: Column) -> Column:
        takes = c["start"] >= acc["end"]
        span = F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
        return F.struct(
            F.when(takes, c["end"]).otherwise(acc["end"]).alias("end"),
            F.when(takes, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<kind:int,start:int,end:int>>").alias("out"))
    return F.aggregate(free, start, step, lambda acc: acc["out"])


def _joined(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end; spans hold base and added ones)."""
    found = stage(candidates(docs, id_col, text_col), "pii-candidates")
    marked = stage(found.select("id", touching(F.col("found")).alias("marked")), "pii-marked")
    one = marked.select(F.explode("marked").alias("x")).select("x.touch", "x.c.*")
    own = F.expr("shiftleft(1, kind)").bitwiseAND(F.col("touch")) > 0
    # at most one row for each combination of the features' values, a few thousand
    table = (
        one.groupBy(*FEATURES)
        .agg(F.count(F.lit(1)).alias("n"), F.sum((own | F.col("base")).cast("int")).alias("hits"))
        .orderBy(*FEATURES)
        .collect()
    )
    selector = Selector([(tuple(r[f] for f in FEATURES), float(r["n"]), float(r["hits"])) for r in table])
    base = F.transform(
        F.filter("marked", lambda x: x["c"]["base"]),
        lambda x: F.struct(x["c"]["kind"].alias("kind"), x["c"]["start"].alias("start"), x["c"]["end"].alias("end")),
    )
    spans = marked.select(
        F.col("id").alias("doc_id"), base.alias("base"), _added(F.col("marked"), selector).alias("added")
    )
    return spans.select("doc_id", "base", F.concat("base", "added").alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base spans by kind, their hash, and all spans as text."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
