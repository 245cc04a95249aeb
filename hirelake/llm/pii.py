"""Personal data: overlapping candidates, judged by boosted trees; DataFrame
functions only.

* Rules find the certain spans (``base``): e-mail addresses, IPv4 addresses,
  card numbers (12 to 19 digits, Luhn), phone numbers with a plus (9 to 15
  digits).  These always stay.
* High-recall generators propose more, overlapping each other and the rules'
  spans: addresses written with "at" and "dot", bare runs of digits, grouped
  numbers.  A number is proposed as a card and as a phone.
* Each candidate has features of its format (digits, groups, separators,
  checksum, how an address is joined) and of its context (characters and words
  around it).  Boosted trees give its score.  Thresholds by kind are calibrated
  on values held out from the trees: the least score from where on at least
  ``target`` of the candidates are right.
* A proposed span is selected if its score reaches its kind's threshold, it
  overlaps no span of a rule, and no selected one with a better score.

The trees learn from the corpus: the rules' spans and their other spellings
(no country code, regrouped, "at" for @) are right; matches that fail their
rule, the same values as another kind, card numbers with a changed digit and
prose around "at" are wrong.  Labelled rows are counted by features over all
documents, and all counts are fitted: on the driver up to ``cells`` (a
parameter) of them, and beyond that by sums that tasks make for each split.

Everything about a document is one projection over its row: no shuffle, so a
hot value or a long text stays with its row.  Patterns are linear in the text
(possessive, bounded or anchored at the start of a run), and offsets are
running sums in two levels, not one per match.

Nulls: a null text is empty, a null doc_id passes through.  Repeated rows get
the same spans each.  Without labelled rows of a kind it gets no further spans.
Other columns pass through where asked for.  An empty table stays empty.
Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common

# FIXED VALUES: the kinds in order, and what the rules take, as (pattern, what a
# match has ahead of it).  Starts are anchored to the start of a run, and runs are
# possessive, which finds the same matches.  An address is looked for at its @,
# which few texts have: it needs a name ahead that the match before has not taken.
KINDS = ("email", "ip", "card", "phone")
RULES = {
    "email": (r"(?=@)(?<=[A-Za-z0-9._%+-])(?!\G)@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\z"),
    "ip": (r"(?=[0-9])(?<![0-9])[0-9]++(?:\.[0-9]++){3}", None),
    "card": (r"[0-9](?:[ -]?[0-9])++", None),
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", None),
}
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

#: The generators: (kinds that it proposes, pattern, what a match has ahead of it).
AT = r"(?=[ (\[{<@＠])(?: [aA][tT] | ?(?:[(\[{<][aA][tT][)\]}>]|[@＠]) ?)"
DOT = r"(?: ?(?:[(\[{][dD][oO][tT][)\]}]) ?| [dD][oO][tT] |\. ?)"
GENERATORS = {
    "address": (("email",), AT + r"[A-Za-z0-9][A-Za-z0-9-]{0,62}(?:" + DOT + r"[A-Za-z0-9-]{2,63}){1,4}(?![\w@-])",
                r"(?<![\w.%+@-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}\z"),
    "digits": (("card", "phone"), r"(?=[0-9])(?<![\w@%+.-])[0-9]{7,19}(?![\w@%-]|\.[0-9])", None),
    "grouped": (("card", "phone"), r"(?=[+(0-9])(?<![\w@%.-])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[ ./-]{0,2}\(?[0-9]{2,5}\)?){1,6}(?![\w@%-]|\.[0-9])", None),
}
#: Words that announce a kind.
CUES = {"email": "mail|contact|write to|address", "ip": "ip|host|server", "card": "card|visa|credit|pay",
        "phone": "phone|tel|call|fax|mobil|number"}
CONTEXT, NEIGHBOURS, STRIDE = 40, 8, 256
FEATURES = ["kind", "digits", "groups", "last", "plus", "paren", "dash", "space", "point", "luhn", "before", "after", "cue",
            "near", "at", "dot", "ending"]
SPAN = "array<struct<start:bigint,end:bigint,value:string,left:string,right:string>>"


# ---------------------------------------------------------------- expressions
def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda s, x: s + x)


def running(values: Column) -> Column:
    """Running sums of an array of longs: by blocks, then within the block."""
    def sums(v):
        last = F.floor((F.size(v) - 1) / STRIDE).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: _sum(F.slice(v, b * STRIDE + 1, F.lit(STRIDE))))
        return bound(blocks, lambda bs: bound(
            F.transform(F.sequence(F.lit(0), last), lambda b: _sum(F.slice(bs, F.lit(1), b))),
            lambda ahead: F.transform(v, lambda _, i: F.get(ahead, F.floor(i / STRIDE).cast("int")) + _sum(
                F.slice(v, i - i % STRIDE + 1, i % STRIDE + 1)))))

    return bound(values, lambda v: F.when(F.size(v) > 0, sums(v)).otherwise(F.array().cast("array<bigint>")))


def spans(text: Column, pattern: str, ahead: str | None = None) -> Column:
    """All matches with their offsets and the text around them: what lies
    between matches gives the offsets.  ``ahead``: a pattern for the end of what
    lies before a match; its match is the span's first part, and a span without
    one is none."""
    def span(value, end, before, after):
        return F.struct((end - F.length(value)).alias("start"), end.alias("end"), value.alias("value"),
                        F.right(before, F.lit(CONTEXT)).alias("left"), F.left(after, F.lit(CONTEXT)).alias("right"))

    def one(m, i, ends, between):
        before, after = F.get(between, i), F.get(between, i + 1)
        if ahead is None:
            return span(m, F.get(ends, i), before, after)
        return bound(F.regexp_extract(before, ahead, 0), lambda lead: F.when(lead != "", span(
            F.concat(lead, m), F.get(ends, i), F.left(before, F.length(before) - F.length(lead)), after)))

    def made(found, between):
        sizes = F.transform(found, lambda m, i: (F.length(F.get(between, i)) + F.length(m)).cast("long"))
        return bound(running(sizes), lambda ends: F.transform(found, lambda m, i: one(m, i, ends, between)))

    every = bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(
        F.size(found) > 0, bound(F.split(text, pattern, -1), lambda between: made(found, between))).otherwise(F.array().cast(SPAN)))
    return every if ahead is None else F.filter(every, lambda x: x.isNotNull())


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether 12 to 19 digits have the right check digit."""
    def weighed(i):
        d = F.ascii(F.substring(digits, F.length(digits) - i, F.lit(1))) - 48
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d).cast("long")

    total = _sum(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), weighed))
    return F.when(F.length(digits).between(12, 19), total % 10 == 0).otherwise(False)


def passes(kind: str, value: Column) -> Column:
    """Whether a match of a rule meets the rest of it."""
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}\z")
    if kind == "card":
        return luhn(F.regexp_replace(value, "[ -]", ""))
    if kind == "phone":
        return F.length(only_digits(value)).between(9, 15)
    return F.lit(True)


def _char(c: Column) -> Column:
    """Class of the character next to a span: none or blank, quote or bracket,
    other mark, letter or digit."""
    return (F.when((c == "") | c.rlike(r"\s"), 0).when(c.rlike("[\"'()<>|\\[\\]:;,]"), 1).when(c.rlike(r"[\w]"), 3).otherwise(2))


def features(kind: Column, value: Column, left: Column, right: Column) -> Column:
    """Small whole numbers, in the order of FEATURES."""
    around = F.lower(F.concat(left, F.lit(" "), right))
    own = F.lit(False)
    for k, words in CUES.items():
        own |= (kind == KINDS.index(k)) & around.rlike(words)
    cue = F.when(own, 2).when(around.rlike("|".join(CUES.values())), 1).otherwise(0)
    number = kind != KINDS.index("email")

    def has(pattern):
        return value.rlike(pattern).cast("int")

    def made(groups):
        digits = F.array_join(groups, "")
        of_number = {
            "digits": F.least(F.length(digits), F.lit(20)), "groups": F.least(F.size(groups), F.lit(7)),
            "last": F.when(F.size(groups) > 0, F.least(F.length(F.element_at(groups, -1)), F.lit(8))).otherwise(0),
            "plus": has(r"^(?:\+|00)"), "paren": has(r"\("), "dash": has("-"), "point": has("[./]"), "luhn": luhn(digits).cast("int"),
        }
        values = {
            "kind": kind, **{c: F.when(number, v).otherwise(0) for c, v in of_number.items()}, "space": has(" "),
            "before": _char(F.right(left, F.lit(1))), "after": _char(F.left(right, F.lit(1))), "cue": cue,
            "near": F.right(left, F.lit(3)).rlike("[0-9]").cast("int") + F.left(right, F.lit(3)).rlike("[0-9]").cast("int"),
            # of an address
            "at": F.when(number, 0).when(value.rlike(r"\S@\S"), 1).when(value.rlike(r"(?i)[(\[{<]at[)\]}>]|＠"), 2)
            .when(value.contains("@"), 3).otherwise(4),
            "dot": F.when(number, 0).when(value.rlike(r"(?i)[(\[{]dot[)\]}]"), 2).when(value.rlike(r"(?i) dot "), 3)
            .when(value.rlike(r"\. "), 4).otherwise(1),
            "ending": F.when(number, 0).otherwise(F.least(F.length(F.regexp_extract(value, r"([A-Za-z]*)$", 1)), F.lit(8))),
        }
        return F.struct(*(values[f].cast("int").alias(f) for f in FEATURES))

    return bound(F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0)), made)


# ------------------------------------------------------------ boosted trees
@dataclass
class Model:
    """margin = start + the leaves of all trees; a tree is a leaf's value or
    (feature, limit, tree if feature <= limit, tree if not)."""

    start: float = 0.0
    trees: list = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)

    def margin(self, row: tuple) -> float:
        return self.start + sum(_leaf(t, row) for t in self.trees)

    def column(self, f: Column) -> Column:
        """The score (0 to 1) of a struct of features."""
        total = F.lit(self.start)
        for tree in self.trees:
            total = total + _when(tree, f)
        return 1 / (1 + F.exp(-total))


def _leaf(tree, row: tuple) -> float:
    while isinstance(tree, tuple):
        feature, limit, low, high = tree
        tree = low if row[feature] <= limit else high
    return tree


def _when(tree, f: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    feature, limit, low, high = tree
    return F.when(f[FEATURES[feature]] <= limit, _when(low, f)).otherwise(_when(high, f))


def _chance(margin: float) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, margin))))


#: What speaks for a candidate can't count against it: no split where a higher
#: value of these lowers the score.
RISING = {FEATURES.index(f) for f in ("luhn", "cue")}


def _split(by: list[dict[int, list[float]]], g: float, h: float) -> tuple[int, int] | None:
    """The best (feature, limit), from sums of gradient and curvature by value of each feature."""
    best = (1e-6, None)
    for feature, held in enumerate(by):
        left_g = left_h = 0.0
        for limit in sorted(held)[:-1]:
            left_g, left_h = left_g + held[limit][0], left_h + held[limit][1]
            if feature in RISING and (left_g - g) / (h - left_h + 1) < -left_g / (left_h + 1):
                continue
            gain = left_g ** 2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g ** 2 / (h + 1)
            if gain > best[0] + 1e-9:
                best = (gain, (feature, limit))
    return best[1]


def _grown(rows: list[tuple[tuple, float, float]], depth: int, rate: float):
    """A tree of second-order steps on (features, gradient, curvature)."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    by: list[dict[int, list[float]]] = [{} for _ in FEATURES] if depth else []
    for feature, sums in enumerate(by):
        for row, gradient, curvature in rows:
            held = sums.setdefault(row[feature], [0.0, 0.0])
            held[0] += gradient
            held[1] += curvature
    best = _split(by, g, h)
    if best is None:
        return -rate * g / (h + 1)
    feature, limit = best
    return (feature, limit, *(_grown([r for r in rows if (r[0][feature] <= limit) == low], depth - 1, rate) for low in (True, False)))


def boosted(cells: list[tuple[tuple, float, float]], rounds: int = 24, depth: int = 3, rate: float = 0.4) -> Model:
    """Trees for cells (features, right, wrong), each a step from those before."""
    right, wrong = (sum(c[i] for c in cells) for i in (1, 2))
    if not right or not wrong:
        return Model()
    model = Model(start=math.log(right / wrong))
    margins = [model.start] * len(cells)
    for _ in range(rounds):
        rows = []
        for (row, yes, no), m in zip(cells, margins, strict=True):
            p = _chance(m)
            rows.append((row, (yes + no) * p - yes, (yes + no) * p * (1 - p)))
        tree = _grown(rows, depth, rate)
        model.trees.append(tree)
        margins = [m + _leaf(tree, c[0]) for m, c in zip(margins, cells, strict=True)]
    return model


def pooled(pools: list[list[float]], score: float, yes: float, no: float) -> None:
    """Add the next higher score to pools whose chances rise."""
    pools.append([score, yes, no])
    while len(pools) > 1 and pools[-2][1] * sum(pools[-1][1:]) >= pools[-1][1] * sum(pools[-2][1:]):
        _, yes, no = pools.pop()
        pools[-1][1] += yes
        pools[-1][2] += no


def least_good(pools: list[list[float]], target: float) -> float | None:
    """The least score whose chance (with one wrong row added) reaches ``target``."""
    return min((score for score, yes, no in pools if yes / (yes + no + 1) >= target), default=None)


def calibrated(model: Model, held: list[tuple[tuple, float, float]], target: float) -> dict[int, float]:
    """Threshold of each kind: pooled so that chances rise with the score, the
    least good score, half way down to the greatest that is not good enough."""
    out = {}
    for kind in {c[0][0] for c in held}:
        pools: list[list[float]] = []
        by: dict[float, list[float]] = {}
        for row, yes, no in (c for c in held if c[0][0] == kind):
            got = by.setdefault(round(_chance(model.margin(row)), 9), [0.0, 0.0])
            got[0] += yes
            got[1] += no
        for score in sorted(by):
            pooled(pools, score, *by[score])
        good = least_good(pools, target)
        if good is not None:
            out[kind] = (good + max((score for score in by if score < good), default=0.0)) / 2
    return out


# --------------------------------------------- the same from sums that tasks make
#: Sums are of whole numbers, so that they don't depend on the order of the tasks.
UNIT = float(1 << 24)


def _tree_of(nodes: dict, at: int = 1):
    node = nodes[at]
    return (*node, _tree_of(nodes, 2 * at), _tree_of(nodes, 2 * at + 1)) if isinstance(node, tuple) else node


def _sums(cells: DataFrame, nodes: dict, leaves: list[int]) -> dict[int, list[dict[int, list[float]]]]:
    """Gradient and curvature by node, feature and value: as many rows as small
    whole numbers make, however many cells there are.  Node n has the nodes 2n
    and 2n + 1 below it; ``leaves`` are those not split so far.  ``margin``: that
    of the trees before."""
    places = _when(_tree_of({**nodes, **{n: n if n in leaves else 0 for n in {*nodes, *leaves} if not isinstance(nodes.get(n), tuple)}}), F.col("f"))
    weighed = cells.select("f", F.log1p("yes").alias("yes"), F.log1p("no").alias("no"), (1 / (1 + F.exp(-F.col("margin")))).alias("p"), places.cast("int").alias("node"))
    g, h = ((F.col("yes") + F.col("no")) * F.col("p") - F.col("yes"), (F.col("yes") + F.col("no")) * F.col("p") * (1 - F.col("p")))
    found = (weighed.where("node > 0")
             .select("node", *(F.round(x * UNIT).cast("long").alias(n) for n, x in (("g", g), ("h", h))),
                     F.posexplode(F.array(*(F.col("f")[c] for c in FEATURES))).alias("feature", "value"))
             .groupBy("node", "feature", "value").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect())
    out: dict[int, list[dict[int, list[float]]]] = {n: [{} for _ in FEATURES] for n in leaves}
    for r in found:
        out[r.node][r.feature][r.value] = [r.g / UNIT, r.h / UNIT]
    return out


def boosted_by_tasks(scratch: common.Scratch, cells: DataFrame, rounds: int = 24, depth: int = 3, rate: float = 0.4) -> Model:
    """``boosted`` for cells (f, yes, no) of any number, with raw counts."""
    weight = {c: F.sum(F.round(F.log1p(c) * UNIT).cast("long")).alias(c) for c in ("yes", "no")}
    totals = cells.agg(*weight.values()).first()
    if not totals.yes or not totals.no:
        return Model()
    model = Model(start=math.log(totals.yes / totals.no))
    cells = scratch.write(cells.withColumn("margin", F.lit(model.start)), "margins-0")
    for tree in range(1, rounds + 1):
        nodes, leaves, known = {}, [1], {}
        for level in range(depth):
            sums, below = _sums(cells, nodes, leaves), []
            for n in leaves:
                by = sums[n]
                g, h = (sum(v[i] for v in by[0].values()) for i in (0, 1))
                known[n] = (g, h)
                best = _split(by, g, h)
                if best is None:
                    nodes[n] = -rate * g / (h + 1)
                    continue
                nodes[n] = best
                below += [2 * n, 2 * n + 1]
                low = [sum(v[i] for value, v in by[best[0]].items() if value <= best[1]) for i in (0, 1)]
                known[2 * n], known[2 * n + 1] = tuple(low), (g - low[0], h - low[1])
            leaves = below
            if not leaves:
                break
        nodes.update({n: -rate * known[n][0] / (known[n][1] + 1) for n in leaves})
        model.trees.append(_tree_of(nodes))
        cells = scratch.write(cells.withColumn("margin", F.col("margin") + _when(model.trees[-1], F.col("f"))), f"margins-{tree}")
        scratch.drop(f"margins-{tree - 1}")
    return model


def calibrated_by_tasks(scratch: common.Scratch, model: Model, held: DataFrame, target: float) -> dict[int, float]:
    """``calibrated`` for cells of any number.  Each range of scores is pooled
    where it is, and the pools of all ranges, which are few, on the driver."""
    def pool(batches):
        pools: dict[int, list[list[float]]] = {}
        for batch in batches:
            for kind, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pooled(pools.setdefault(kind, []), *row)
        rows = [(kind, *p) for kind, held in pools.items() for p in held]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            list(zip(*rows, strict=True)) or [[]] * 4, (pa.int32(), pa.float64(), pa.int64(), pa.int64()), strict=True)],
            names=["kind", "score", "yes", "no"])

    schema = "kind int, score double, yes long, no long"
    scores = scratch.write(held.select(F.col("f.kind").alias("kind"), F.round(model.column(F.col("f")), 9).alias("score"), "yes", "no")
                           .groupBy("kind", "score").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")), "scores")
    ranged = scores.repartitionByRange(common.partitions(held.sparkSession), "kind", "score").sortWithinPartitions("kind", "score")
    pools: dict[int, list[list[float]]] = {}
    for r in sorted(ranged.mapInArrow(pool, schema).collect(), key=lambda r: (r.kind, r.score)):
        pooled(pools.setdefault(r.kind, []), r.score, r.yes, r.no)
    out = {}
    for kind, own in pools.items():
        good = least_good(own, target)
        if good is not None:
            below = scores.where((F.col("kind") == kind) & (F.col("score") < good)).agg(F.max("score")).first()[0]
            out[kind] = (good + (below or 0.0)) / 2
    return out


# ------------------------------------------------------------------ the whole
def candidates(docs: DataFrame, keep: Iterable[str]) -> DataFrame:
    """(row, base, more): matches of the rules with ``ok``, and proposed spans
    with their features."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select(F.struct(*(F.col(c) for c in keep)).alias("row"), text.alias("text")).select(
        "row", *(spans(F.col("text"), *p).alias(f"r_{k}") for k, p in RULES.items()),
        *(spans(F.col("text"), *p).alias(f"g_{g}") for g, (_, *p) in GENERATORS.items()))

    def of_kind(kind, *more):
        return lambda x: F.struct(F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                                  x["value"].alias("value"), x["left"].alias("left"), x["right"].alias("right"),
                                  *(m(kind, x["value"]) for m in more))

    def judged(x):
        return F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                        features(x["kind"], x["value"], x["left"], x["right"]).alias("f"))

    ok = lambda kind, value: passes(kind, value).alias("ok")
    more = F.concat(*(F.transform(f"g_{g}", of_kind(k)) for g, (kinds, *_) in GENERATORS.items() for k in kinds))
    return found.select("row", F.concat(*(F.transform(f"r_{k}", of_kind(k, ok)) for k in RULES)).alias("base"),
                        F.transform(more, judged).alias("more"))


def labelled(found: DataFrame) -> DataFrame:
    """(f, right, held): features of labelled rows, and whether the value is
    held out for calibration."""
    email, ip, card, phone = range(4)
    x = F.col("x")
    value = x["value"]
    draw = F.pmod(F.xxhash64(value), F.lit(5))
    apart = ~x["left"].rlike(r"\w\z") & ~x["right"].rlike(r"^\w")
    digits = only_digits(value)
    other = F.concat(F.left(digits, F.length(digits) - 1), ((F.right(digits, F.lit(1)).cast("int") + 3) % 10).cast("string"))

    def fours(sep):
        return F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", f"$1{sep}")

    def spelt(at, dot):
        return F.regexp_replace(F.regexp_replace(value, "@", at), r"\.(?=[A-Za-z0-9-]+$)", dot)

    def case(kind, text, right):
        return F.struct(F.lit(kind).alias("kind"), text.alias("value"), F.lit(right).alias("right"))

    bare = F.regexp_replace(value, r"^\+[0-9]{1,3}[ .-]?", "")
    spelling = (F.when(draw == 0, spelt(" at ", " dot ")).when(draw == 1, spelt(" (at) ", " (dot) ")).when(draw == 2, spelt("[at]", "[dot]"))
                .when(draw == 3, spelt(" (at) ", ".")).otherwise(spelt(" @ ", ".")))
    nothing = F.array().cast("array<struct<kind:int,value:string,right:boolean>>")
    cases = (F.when((x["kind"] == email), F.array(case(email, value, True), case(email, spelling, True)))
             .when((x["kind"] == card) & x["ok"] & apart, F.array(
                 case(card, value, True), case(card, digits, True), case(card, F.when(draw < 3, fours(" ")).otherwise(fours("-")), True),
                 case(card, other, False), case(phone, value, False), case(phone, digits, False), case(phone, fours(" "), False)))
             .when(x["kind"] == card, F.when(x["ok"], nothing).otherwise(F.array(case(card, value, False))))
             .when((x["kind"] == phone) & x["ok"], F.array(case(phone, value, True), case(phone, bare, True), case(card, value, False)))
             .when(x["kind"] == phone, F.array(case(phone, value, False)))
             .when(x["kind"] == ip, F.array(case(phone, value, False), case(card, value, False))).otherwise(nothing))
    ruled = (found.select(F.explode("base").alias("x")).select(F.explode(cases).alias("c"), "x", draw.alias("draw"))
             .select(features(F.col("c.kind"), F.col("c.value"), x["left"], x["right"]).alias("f"), F.col("c.right").alias("right"),
                     (F.pmod(F.xxhash64(value, F.lit(1)), F.lit(4)) == 0).alias("held")))
    f = F.col("f")
    wrong = (((f["kind"] == email) & (f["at"] == 4) & f["dot"].isin(1, 4))
             | ((f["kind"] == card) & (f["luhn"] == 0))
             | ((f["kind"] == phone) & (~f["digits"].between(9, 15) | ((f["groups"] == 1) & (f["plus"] == 0)))))
    seen = found.select(F.explode("more").alias("x")).select(
        F.col("x.f").alias("f"), F.lit(False).alias("right"), (F.pmod(F.xxhash64("x"), F.lit(4)) == 0).alias("held")).where(wrong)
    return ruled.unionByName(seen)


def fit(found: DataFrame, cells: int = 20_000, target: float = 0.9) -> Model:
    """The trees and thresholds, from all labelled rows.  ``cells``: most counts
    of labelled rows with the same features that come to the driver; more are
    fitted where they are."""
    scratch = common.Scratch(found.sparkSession, "pii-fit")
    counts = scratch.write(labelled(found).groupBy("f", "held").agg(
        F.count_if("right").alias("yes"), F.count_if(~F.col("right")).alias("no")), "cells")
    if counts.count() > cells:
        apart = {held: counts.where(F.col("held") == held).select("f", "yes", "no") for held in (False, True)}
        model = boosted_by_tasks(scratch, apart[False])
        model.thresholds = calibrated_by_tasks(scratch, model, apart[True], target)
        return model
    rows = sorted((tuple(r.f), float(r.yes), float(r.no), r.held) for r in counts.collect())
    # a count weighs as its logarithm: one hot value is not the whole table
    model = boosted([(f, math.log1p(yes), math.log1p(no)) for f, yes, no, held in rows if not held])
    model.thresholds = calibrated(model, [(f, yes, no) for f, yes, no, held in rows if held], target)
    return model


def _selected(model: Model) -> Column:
    """The rules' spans and the selected ones, in order of start and kind."""
    score = model.column
    def span(x, base, value):
        return F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), F.lit(base).alias("base"), value.alias("score"))

    def reaches(x):
        out = F.lit(False)
        for kind, threshold in sorted(model.thresholds.items()):
            out |= (x["kind"] == kind) & (x["score"] >= threshold)
        return out

    ruled = F.transform(F.filter("base", lambda x: x["ok"]), lambda x: span(x, True, F.lit(1.0)))
    more = F.filter(F.transform("more", lambda x: span(x, False, score(x["f"]))), reaches)

    def once(every):  # two generators may propose the same: equal ones are neighbours
        return F.filter(every, lambda x, i: (i == 0) | (x != F.get(every, F.greatest(i - 1, F.lit(0)))))

    def stays(every):
        def beaten(x, i):
            near = F.slice(every, F.greatest(i - NEIGHBOURS + 1, F.lit(1)), F.lit(2 * NEIGHBOURS + 1))
            rank = lambda y: F.struct(y["score"], y["end"] - y["start"], -y["start"], -y["kind"])
            return ~x["base"] & F.exists(near, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]) & (
                y["base"] | (rank(y) > rank(x))))

        return F.filter(every, lambda x, i: ~beaten(x, i))

    return bound(bound(F.array_sort(F.concat(ruled, more)), once), stays)


def find(docs: DataFrame, keep: Iterable[str] = ("doc_id",), cells: int = 20_000, target: float = 0.9) -> DataFrame:
    """The columns ``keep`` of ``docs`` in a struct ``row``, and ``spans``: an
    array of (start, kind, end, base, score) in order, kind as its place in KINDS."""
    scratch = common.Scratch(docs.sparkSession, "pii")
    found = scratch.write(candidates(docs, keep), "candidates")
    return found.select("row", _selected(fit(found, cells, target)).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the rules' spans by kind, their SHA-256 and all spans as text."""
    name = F.array(*(F.lit(k) for k in KINDS))

    def written(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")

    base = F.filter("spans", lambda x: x["base"])

    def counted(k):
        return F.size(F.filter(base, lambda x: x["kind"] == k)).cast("long")

    return found.select("row.*", *(counted(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)),
                        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
