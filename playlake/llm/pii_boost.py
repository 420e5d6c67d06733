"""Personal data: candidate generators, gradient-boosted trees, calibrated thresholds.

Four strict rules (email, ip, card, phone) give the base spans, which always
stay. Looser generators then propose further, overlapping candidates: address-like
strings, and in number-like strings every part from one group of digits to another,
also in forms that the rules do not accept. Boosted trees score each candidate by
its format (lengths, groups, separators, check digit, octets) and its context
(neighbouring characters, words before it).

The trees are taught more than the rules know: positive examples are the base
spans and their variants in forms that the rules refuse (plus sign dropped, other
separators, ``(at)``), in their own context; negative ones are candidates that fail
a hard check (check digit, octets, dialling prefix, host name) and have no word of
personal data before them. Candidates in between teach nothing. The score that a
kind must reach is calibrated on held-out examples for a wanted precision, so a
kind without evidence adds nothing. All variants of a span are held out together.

Everything runs as DataFrame expressions: texts never leave their row, there is
no shuffle of texts, and the fitted trees are turned into one Column expression.
The work on a text grows in proportion to it: positions and contexts come from the
text between matches (``split``) and the matches (``regexp_extract_all``) of one
pattern, which use possessive groups and look-behind instead of backtracking; a
group of digits starts no candidate of more than ``_GROUPS`` groups; which candidates a
base span covers is found by one sort, and which of them stay by one pass.

Defined results
  * null or empty text: no spans, all counts 0; null ``doc_id``: as any other row;
  * repeated rows: equal results each; empty table: no rows and no model;
  * positions are code points, the end is exclusive; a text may have any length;
  * a candidate that overlaps a base span goes. Address-like candidates go before
    numbers; of overlapping numbers those stay that have the greatest sum of score
    times digits, of equal sums what ends sooner;
  * extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.llm._columns import let

#: The kinds in their order, and the rules as stated.
KINDS = ("email", "ip", "card", "phone")
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: The same matches in linear time: a match starts where its first run starts,
#: or right after the match before.
_LINEAR = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: High-recall generators: groups of digits with what separates them, addresses with @ or (at).
_GROUP = r"[+(]?[0-9]++[).\x20/-]*+(?:\((?![0-9])[().\x20/-]*+)*+"
_NUMBERS = r"[0-9][0-9().+\x20/-]{5,}[0-9]"
_PART = r"[^\s@,;:<>()\[\]\"']"
_ADDRESS = rf"(?<!{_PART}){_PART}++(?:@|\x20?[\[(](?:at|AT)[\])]\x20?){_PART}++"
_CONTEXT = r"(?i)(phone|tel|call|fax|mobile|mail|contact|card|visa|credit|host|addr|\bip\b|server|ssn|account)"

#: How a phone number begins that has an area or country code.
_PREFIX = r"^[+(0]"

#: Boosting rounds, depth, bins of a feature at least.
ROUNDS, DEPTH, LEAST_BINS = 10, 3, 32
#: Different examples in one task of the rounds, about.
PART_EXAMPLES = 50_000
#: Precision that a kind's threshold must show on held-out candidates, and the
#: fewest positive ones that count as evidence.
PRECISION, EVIDENCE = 0.95, 20
_BINS = 200
#: Most groups of digits, and digits, of a candidate: a card has up to 19 digits.
_GROUPS = 19
#: Characters of context before a span; elements of an array that are worked through at a time.
_BEFORE, _SCAN = 24, 512

FEATURES = (
    "is_email", "is_ip", "is_card", "is_phone", "length", "digits", "groups", "longest", "dots", "dashes",
    "spaces", "parens", "luhn", "octets", "joined_before", "joined_after", "context", "at_sign", "labels", "prefix",
)


@dataclass(frozen=True)
class Model:
    """Trees as nested (feature, threshold, low, high) or leaf values, with weights, and each kind's threshold."""

    trees: tuple = ()
    thresholds: dict = field(default_factory=dict)


def _blocks(x: Column) -> Column:
    """An array that is not empty, cut into arrays of ``_SCAN``."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / _SCAN).cast("int")), lambda i: F.slice(x, i * _SCAN + 1, _SCAN))


def _fold(a: Column, start: Column, step: Callable[[Column, Column], Column], out_type: str) -> Column:
    """One output per element, in order, of a state that goes from element to element.

    ``step(state, element)`` gives a struct of the next ``state`` and ``out``. In two
    levels, as an array grows by copying.
    """
    none, nested = F.array().cast(f"array<{out_type}>"), F.array().cast(f"array<array<{out_type}>>")

    def block(state: Column, part: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(state.alias("state"), none.alias("out")),
            lambda acc, v: let(
                step(acc["state"], v),
                lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], F.array(r["out"])).alias("out")),
            ),
        )

    def whole(x: Column) -> Column:
        return F.aggregate(
            _blocks(x),
            F.struct(start.alias("state"), nested.alias("out")),
            lambda acc, part: let(
                block(acc["state"], part),
                lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], F.array(r["out"])).alias("out")),
            ),
            lambda acc: F.flatten(acc["out"]),
        )

    return let(a, lambda x: F.when(F.size(x) == 0, none).otherwise(whole(x)))


def _scan(a: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Exclusive running result of ``op`` from 0, in two levels (an array grows by copying)."""
    none = F.array().cast("array<long>")

    def one(x: Column) -> Column:
        return F.aggregate(
            x,
            F.struct(F.lit(0).cast("long").alias("s"), none.alias("out")),
            lambda acc, v: F.struct(op(acc["s"], v).alias("s"), F.concat(acc["out"], F.array(acc["s"])).alias("out")),
            lambda acc: acc["out"],
        )

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0).cast("long"), op)

    return let(
        a,
        lambda x: F.when(F.size(x) == 0, none).otherwise(
            let(
                _blocks(x),
                lambda bs: let(
                    one(F.transform(bs, total)),
                    lambda first: F.flatten(F.transform(bs, lambda b, i: F.transform(one(b), lambda v: op(v, F.get(first, i))))),
                ),
            )
        ),
    )


_SPANS = "array<struct<start:bigint,end:bigint,found:string,before:string,after:string>>"


def _find(text: Column, pattern: str, trigger: str) -> Column:
    """Start, end (code points) and string of every match, what comes before it (since the match before) and the
    character after it (none if the next match follows at once); texts without ``trigger`` are skipped."""
    none = F.array().cast(_SPANS)

    def placed(found: Column) -> Column:
        return let(F.split(text, pattern, -1), lambda gap: among(found, gap))

    def among(found: Column, gap: Column) -> Column:
        lengths = F.transform(found, lambda m, i: (F.length(F.get(gap, i)) + F.length(m)).cast("long"))
        ends = let(
            lengths,
            lambda n: let(_scan(n, lambda a, b: a + b), lambda before: F.transform(before, lambda b, i: b + F.get(n, i))),
        )
        return let(
            ends,
            lambda e: F.transform(
                found,
                lambda m, i: F.struct(
                    (F.get(e, i) - F.length(m)).alias("start"), F.get(e, i).alias("end"), m.alias("found"),
                    F.right(F.get(gap, i), F.lit(_BEFORE)).alias("before"), F.left(F.get(gap, i + 1), F.lit(1)).alias("after"),
                ),
            ),
        ).cast(_SPANS)

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(
        F.regexp_like(text, F.lit(trigger)),
        let(hits, lambda found: F.when(F.size(found) == 0, none).otherwise(placed(found))),
    ).otherwise(none)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(c: Column, i: Column) -> Column:
        twice = 2 * c.cast("int")
        return F.when(i % 2 == 0, c.cast("int")).when(twice > 9, twice - 9).otherwise(twice)

    figures = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(F.transform(figures, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _octets(m: Column) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(F.when(F.length(p) <= 3, p).try_cast("int"), F.lit(0)) <= 255))


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return _octets(m)
    if kind == "card":
        return let(_digits(m), lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


_TRIGGER = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]{2}|[0-9][ -][0-9]", "phone": r"\+[0-9]"}


def _rules(text: Column) -> Column:
    """The rules' spans that pass their checks, sorted by start, then kind, with their context."""

    def of(rank: int, kind: str) -> Column:
        valid = F.filter(_find(text, _LINEAR[kind], _TRIGGER[kind]), lambda s: _valid(kind, s["found"]))
        return F.transform(valid, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), *_seen(s)))

    return F.sort_array(F.concat(*(of(rank, kind) for rank, kind in enumerate(KINDS))))


def _seen(c: Column) -> list[Column]:
    return [c[name].alias(name) for name in ("found", "before", "after")]


def _plain(spans: Column) -> Column:
    """(start, kind's rank, end, string): sorted spans are in the order of the result."""
    return F.transform(spans, lambda s: F.struct(*(s[name].alias(name) for name in ("start", "rank", "end", "found"))))


def base_spans(text: Column) -> Column:
    """The rules' spans that pass their checks, sorted by start, then kind."""
    return _plain(_rules(text))


def _covered(spans: Column, base: Column) -> Column:
    """For each of ``spans`` whether it overlaps one of ``base``: by one sort of both.

    Of the base spans that begin before a span's end, one reaches into the span if
    the greatest end does.
    """

    def mark(at: Column, order: int, reach: Column, i: Column) -> Column:
        names = ("at", "order", "reach", "i")
        return F.struct(*(v.cast("long").alias(n) for v, n in zip((at, F.lit(order), reach, i), names, strict=True)))

    marks = F.array_sort(
        F.concat(
            F.transform(spans, lambda c, i: mark(c["end"], 0, F.lit(0), i)),
            F.transform(base, lambda b: mark(b["start"], 1, b["end"], F.lit(-1))),
        )
    )
    reached = let(
        marks,
        lambda m: let(
            _scan(F.transform(m, lambda x: x["reach"]), lambda a, b: F.greatest(a, b)),
            lambda r: F.filter(F.transform(m, lambda x, j: F.struct(x["i"].alias("i"), F.get(r, j).alias("reach"))), lambda x: x["i"] >= 0),
        ),
    )
    by_place = F.transform(F.array_sort(reached), lambda x: x["reach"])
    none = F.transform(spans, lambda c: F.lit(False))
    return F.when(F.size(base) == 0, none).otherwise(let(by_place, lambda r: F.transform(spans, lambda c, i: F.get(r, i) > c["start"])))


def _kind_of(found: Column, digits: Column) -> Column:
    """The kind that a number's structure suggests."""
    return (
        F.when(F.regexp_like(found, F.lit(r"^[0-9]+(\.[0-9]+){3}$")), 1)
        .when(digits.between(12, 19) & F.regexp_like(found, F.lit(r"^[0-9 -]+$")), 2)
        .when(digits.between(9, 15), 3)
    )


_NUMBER_TYPE = "array<array<struct<groups:int,start:bigint,end:bigint,rank:int,digits:int,found:string,before:string,after:string>>>"


def _numbers(text: Column, base: Column) -> Column:
    """Per group of digits the candidates that end with it: from each of the groups before it that no base span covers."""

    def core(g: Column) -> Column:
        return F.regexp_extract(g, r"^[+(]?[0-9]+", 0)

    def described(groups: Column) -> Column:
        return F.transform(
            groups,
            lambda g, i: let(
                core(g["found"]),
                lambda c: F.struct(
                    g["start"].alias("start"),
                    (g["start"] + F.length(c)).alias("end"),
                    g["found"].alias("whole"),
                    c.alias("core"),
                    (F.length(c) - F.when(F.substring(c, 1, 1).isin("+", "("), 1).otherwise(0)).alias("digits"),
                    ((g["before"] != "") | (i == 0)).alias("first"),
                    F.right(F.concat(F.when(i == 0, F.lit("")).otherwise(F.get(groups, i - 1)["found"]), g["before"]), F.lit(_BEFORE)).alias("before"),
                    F.when(F.length(g["found"]) > F.length(c), F.substring(g["found"], F.length(c) + 1, F.lit(1)))
                    .when(g["after"] != "", g["after"])
                    .otherwise(F.coalesce(F.left(F.get(groups, i + 1)["found"], F.lit(1)), F.lit("")))
                    .alias("after"),
                ),
            ),
        )

    start_type = "struct<open:boolean,last_first:boolean,digits:int,tail:string,out:array<struct<groups:int,start:bigint,digits:int,found:string,before:string>>>"

    def ending(groups: Column, covered: Column, j: Column) -> Column:
        """Walk back from group j while the groups are joined, free and few."""
        first = F.greatest(j - (_GROUPS - 1), F.lit(0))
        back = F.reverse(F.sequence(first, j))

        def step(acc: Column, i: Column) -> Column:
            g = F.get(groups, i)
            digits = acc["digits"] + F.least(g["digits"], F.lit(99))
            go = acc["open"] & ~F.get(covered, i) & ((i == j) | ~acc["last_first"]) & (digits <= _GROUPS)
            found = F.when(i == j, g["core"]).otherwise(F.concat(g["whole"], acc["tail"]))
            item = F.struct(
                (j - i + 1).cast("int").alias("groups"), g["start"].alias("start"), digits.cast("int").alias("digits"),
                found.alias("found"), g["before"].alias("before"),
            )
            return F.when(
                go,
                F.struct(
                    go.alias("open"), g["first"].alias("last_first"), digits.cast("int").alias("digits"), found.alias("tail"),
                    F.concat(acc["out"], F.array(item)).alias("out"),
                ),
            ).otherwise(acc.withField("open", F.lit(False))).cast(start_type)

        zero = F.struct(
            F.lit(True).alias("open"), F.lit(False).alias("last_first"), F.lit(0).alias("digits"), F.lit("").alias("tail"),
            F.array().alias("out"),
        ).cast(start_type)
        last = F.get(groups, j)
        made = F.transform(
            F.aggregate(back, zero, step, lambda acc: acc["out"]),
            lambda c: F.struct(
                c["groups"].alias("groups"), c["start"].alias("start"), last["end"].alias("end"),
                _kind_of(c["found"], c["digits"]).alias("rank"), c["digits"].alias("digits"),
                c["found"].alias("found"), c["before"].alias("before"), last["after"].alias("after"),
            ),
        )
        return F.filter(made, lambda c: c["rank"].isNotNull())

    found = let(_find(text, _GROUP, _NUMBERS), described)
    return let(
        found,
        lambda groups: let(
            _covered(groups, base),
            lambda covered: F.transform(groups, lambda g, j: ending(groups, covered, j)),
        ),
    ).cast(_NUMBER_TYPE)


def _addresses(text: Column, base: Column) -> Column:
    """Address-like strings that no base span covers."""
    found = F.transform(
        _find(text, _ADDRESS, r"@|[\[(](?:at|AT)[\])]"),
        lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("rank"), s["end"].alias("end"), *_seen(s)),
    )
    return let(found, lambda f: let(_covered(f, base), lambda c: F.filter(f, lambda s, i: ~F.get(c, i))))


def _chosen(options: Column) -> Column:
    """The non-overlapping candidates with the greatest sum of score times digits.

    ``options``: per group of digits the candidates that end with it (``groups`` long).
    Forth: the best sum up to each group, of which only the last ``_GROUPS`` are looked
    back at, and the candidate that it takes there. Back: those that the best sum is made of.
    """

    def forth(best: Column, ending: Column) -> Column:
        most = F.aggregate(
            ending,
            F.struct(F.element_at(best, -1).alias("sum"), F.lit(0).alias("groups")),
            lambda m, c: let(
                c["score"] * c["digits"] + F.element_at(best, -c["groups"]),
                lambda v: F.when(v > m["sum"], F.struct(v.alias("sum"), c["groups"].alias("groups"))).otherwise(m),
            ),
        )
        return let(
            most,
            lambda m: F.struct(F.slice(F.concat(best, F.array(m["sum"])), 2, _GROUPS + 1).alias("state"), m["groups"].alias("out")),
        )

    def back(left: Column, groups: Column) -> Column:
        inside = left > 0
        return F.struct(
            F.when(inside, left - 1).otherwise(F.greatest(groups - 1, F.lit(0))).cast("int").alias("state"),
            F.when(inside, 0).otherwise(groups).cast("int").alias("out"),
        )

    start = F.array_repeat(F.lit(0.0), _GROUPS + 1)
    return let(
        F.reverse(_fold(F.reverse(_fold(options, start, forth, "int")), F.lit(0), back, "int")),
        lambda taken: F.flatten(F.transform(options, lambda o, j: F.filter(o, lambda c: c["groups"] == F.get(taken, j)))),
    )


def _features(c: Column) -> Column:
    m, kind = c["found"], c["rank"]
    runs = F.transform(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0)), F.length)
    digits = _digits(m)

    def of(x: Column) -> Column:
        return F.coalesce(x.cast("double"), F.lit(0.0))

    values = (
        kind == 0, kind == 1, kind == 2, kind == 3,
        F.length(m), F.length(digits), F.size(runs), F.array_max(runs),
        F.length(m) - F.length(F.translate(m, ".", "")),
        F.length(m) - F.length(F.translate(m, "-", "")),
        F.length(m) - F.length(F.translate(m, " ", "")),
        F.length(m) - F.length(F.translate(m, "()", "")),
        F.when(F.length(digits).between(12, 19), _luhn(digits)),
        F.when(kind == 1, _octets(m)),
        F.regexp_like(c["before"], F.lit(r"[\p{L}\p{N}_]$")),
        F.regexp_like(c["after"], F.lit(r"^[\p{L}\p{N}_]")),
        _in_context(c),
        F.contains(m, F.lit("@")),
        F.size(F.split(F.regexp_extract(m, r"(?:@|[\])])\x20?(.*)$", 1), r"\.")),
        F.regexp_like(m, F.lit(_PREFIX)),
    )
    return F.array(*(of(v) for v in values))


def _in_context(c: Column) -> Column:
    return F.regexp_like(c["before"], F.lit(_CONTEXT))


def _passes_hard_check(c: Column) -> Column:
    """What no span of the kind can lack, whatever its form."""
    m, digits = c["found"], _digits(c["found"])
    return (
        F.when(c["rank"] == 0, F.regexp_like(m, F.lit(r"(?:@|(?:at|AT)[\])]\x20?)[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$")))
        .when(c["rank"] == 1, _octets(m))
        .when(c["rank"] == 2, _luhn(digits))
        .otherwise(F.regexp_like(m, F.lit(_PREFIX)))
    )


def _variants(s: Column) -> Column:
    """A base span as found, and in forms that its rule does not accept."""
    m, digits = s["found"], _digits(s["found"])
    by_four = F.trim(F.regexp_replace(digits, "(.{4})", "$1 "))
    forms = (
        F.when(s["rank"] == 0, F.array(m, F.replace(m, F.lit("@"), F.lit("(at)")), F.replace(m, F.lit("@"), F.lit(" [at] "))))
        .when(s["rank"] == 2, F.array(m, digits, by_four, F.replace(by_four, F.lit(" "), F.lit("  ")), F.replace(by_four, F.lit(" "), F.lit(" - "))))
        .when(
            s["rank"] == 3,
            F.array(m, F.substring(m, 2, 10_000), F.concat(F.lit("00"), digits), F.regexp_replace(F.substring(m, 2, 10_000), "[ ()-]+", "."),
                    F.regexp_replace(m, "[ ()-]+", "/")),
        )
        .otherwise(F.array(m))
    )
    return F.transform(forms, lambda v: F.struct(s["rank"].alias("rank"), v.alias("found"), s["before"].alias("before"), s["after"].alias("after")))


def _scored(features: Column, model: Model) -> Column:
    """Probability of a candidate: the trees as one expression."""

    def walk(node) -> Column:
        if not isinstance(node, tuple):
            return F.lit(float(node))
        at, threshold, low, high = node
        return F.when(F.get(features, F.lit(at)) <= threshold, walk(low)).otherwise(walk(high))

    margin = F.lit(0.0)
    for weight, tree in model.trees:
        margin = margin + F.lit(float(weight)) * walk(tree)
    return 1.0 / (1.0 + F.exp(-2.0 * margin))


def _tree(node) -> tuple | float:
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    s = node.split()
    return (int(s.featureIndex()), float(s.threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


def fit(docs: DataFrame, text_col: str = "text", precision: float = PRECISION) -> Model:
    """Boosted trees over all examples of all documents, thresholds from all that are held out.

    The examples are counted by label, kind and features, which is all that the trees and the
    thresholds see of them: each different one is a row that weighs as often as it occurs.
    """
    _allow_depth(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))

    def example(label: float, c: Column, of: Column) -> Column:
        return F.struct(
            F.lit(label).alias("label"), c["rank"].alias("rank"), _features(c).cast("array<int>").alias("f"),
            (F.pmod(F.xxhash64(of["found"], of["rank"]), F.lit(3)) == 0).alias("held_out"),
        )

    def labelled(t: Column) -> Column:
        def of_rules(base: Column) -> Column:
            good = F.flatten(F.transform(base, lambda s: F.transform(_variants(s), lambda v: example(1.0, v, s))))
            other = F.concat(
                F.transform(_addresses(t, base), lambda c: F.struct(c["rank"].alias("rank"), *_seen(c))),
                F.transform(F.flatten(_numbers(t, base)), lambda c: F.struct(c["rank"].alias("rank"), *_seen(c))),
            )
            bad = F.filter(other, lambda c: ~_passes_hard_check(c) & ~_in_context(c))
            return F.concat(good, F.transform(bad, lambda c: example(0.0, c, c)))

        return let(_rules(t), of_rules)

    rows = docs.select(F.explode(let(text, labelled)).alias("c")).select("c.*")
    keys = ("label", "rank", "held_out", "f")
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("n")).persist()
    try:
        per_class = {(r["label"], r["held_out"]): r["rows"] for r in counted.groupBy("label", "held_out").agg(F.count(F.lit(1)).alias("rows")).collect()}
        taught = [per_class.get((label, False), 0) for label in (1.0, 0.0)]
        if min(taught) == 0:
            return Model()
        # In a fixed order, so that sums of fractions, and with them the trees, agree in every run.
        placed = counted.where(~F.col("held_out")).repartition(-(-sum(taught) // PART_EXAMPLES), *keys).sortWithinPartitions(*keys)
        flat = placed.select("label", "n", *(F.get("f", F.lit(i)).cast("double").alias(name) for i, name in enumerate(FEATURES)))
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(flat)
        # The classifier looks for splits in a sample of max(bins ** 2, 10,000) rows: with so many bins it is all of them.
        bins = max(LEAST_BINS, math.isqrt(sum(taught)) + 1)
        boosted = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, maxBins=bins, seed=1, stepSize=0.3, weightCol="n").fit(
            vectors.select("label", "n", "features")
        )
        trees = tuple((w, _tree(t._java_obj.rootNode())) for w, t in zip(boosted.treeWeights, boosted.trees, strict=True))
        model = Model(trees, {})
        score = let(F.col("f").cast("array<double>"), lambda f: _scored(f, model))
        binned = (
            counted.where("held_out")
            .withColumn("bin", F.floor(score * _BINS))
            .groupBy("rank", "bin")
            .agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n"))
            .collect()
        )
    finally:
        counted.unpersist()
    thresholds = {}
    for rank in range(len(KINDS)):
        good = n = 0.0
        mine = sorted((r for r in binned if r["rank"] == rank), key=lambda r: -r["bin"])
        bad = sum(r["n"] - r["good"] for r in mine)
        for row in mine:
            good, n = good + row["good"], n + row["n"]
            # there are more variants of a span than examples that are none: these are counted by themselves too
            if good >= EVIDENCE and good >= precision * n and n - good <= (1 - precision) * bad:
                thresholds[rank] = row["bin"] / _BINS
    return Model(trees, thresholds)


#: Rounds that the analyzer needs for expressions nested as deeply as these (its default is 100).
_ROUNDS = 1000


def _allow_depth(spark: SparkSession | None) -> None:
    """Let the session's analyzer take as many rounds as the nesting of ``find`` needs."""
    name = "spark.sql.analyzer.maxIterations"
    if spark is not None and int(spark.conf.get(name, "100")) < _ROUNDS:
        spark.conf.set(name, str(_ROUNDS))


def find(text: Column, model: Model) -> Column:
    """Struct of a text's ``base`` spans and ``all`` spans: (start, rank, end, found), sorted."""
    _allow_depth(SparkSession.getActiveSession())

    def scored(cands: Column) -> Column:
        """Candidates that reach their kind's threshold, with their score."""
        with_score = F.transform(cands, lambda c: c.withField("score", let(_features(c), lambda f: _scored(f, model))))
        return F.filter(with_score, lambda c: c["score"] >= _threshold(model, c["rank"]))

    def added(t: Column, base: Column) -> Column:
        if not model.thresholds:
            return F.array().cast("array<struct<start:bigint,rank:int,end:bigint,found:string>>")
        return let(
            scored(_addresses(t, base)),
            lambda addresses: let(
                F.transform(_numbers(t, F.concat(_plain(base), _plain(addresses))), scored),
                lambda options: F.concat(_plain(addresses), _plain(_chosen(options))),
            ),
        )

    return let(
        F.coalesce(text, F.lit("")),
        lambda t: let(
            _rules(t),
            lambda base: F.struct(_plain(base).alias("base"), F.sort_array(F.concat(_plain(base), added(t, base))).alias("all")),
        ),
    )


def _threshold(model: Model, rank: Column) -> Column:
    """The score that a kind must reach; more than any score where it has no threshold."""
    least = F.lit(2.0)
    for of, threshold in model.thresholds.items():
        least = F.when(rank == of, F.lit(float(threshold))).otherwise(least)
    return least


def spans_string(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    kind = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kind, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first names the whole run."""
    kind = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))

    def joined(s: Column) -> Column:
        return let(
            _scan(F.transform(s, lambda x: x["end"]), lambda a, b: F.greatest(a, b)),
            lambda done: F.concat(
                F.array_join(
                    F.transform(
                        s,
                        lambda x, i: F.when(x["start"] >= F.get(done, i), F.concat(
                            F.substring(text, (F.get(done, i) + 1).cast("int"), (x["start"] - F.get(done, i)).cast("int")),
                            F.get(kind, x["rank"]),
                        )).otherwise(F.lit("")),
                    ),
                    "",
                ),
                F.substring(text, (F.array_max(F.transform(s, lambda x: x["end"])) + 1).cast("int"), F.length(text)),
            ),
        )

    return F.when(F.size(spans) > 0, let(spans, joined)).otherwise(text)


def scan(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: its id, ``base`` and ``all`` spans and the redacted text."""
    _allow_depth(docs.sparkSession)
    found = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"), find(F.col(text_col), model).alias("_f"))
    return found.select("doc_id", "_f.base", "_f.all", redact(F.col("_t"), F.col("_f.all")).alias("redacted"))
