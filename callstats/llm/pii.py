"""Personal data: candidate spans, boosted trees and calibrated thresholds.

DataFrame functions only. Base findings always count. High-recall generators
propose further, overlapping spans; gradient boosted trees judge their format
and context, and a threshold per generator selects what is redacted. The
trees are trained with Spark's own GBTClassifier and compiled to a column
expression, so documents are judged in place: no shuffle, no explode.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callstats.operators.materialize import materialize

# The base patterns, written so that no text makes them slow: possessive
# repeats, and a match may start inside a run of its first class only where
# the previous match ended.
BASE = {
    "email": (
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
    ),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[ -]?[0-9]){15,}+", r"[0-9][ -]?[0-9]"),
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]"),
}
KINDS = list(BASE)

#: Generators of further candidates: kind, pattern, and a pattern that any text
#: with a match holds.
GENERATORS = {
    "mail": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]++"
        r" ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,24}(?![A-Za-z])",
        r"\(at\)|\[at\]| at ",
    ),
    "local": (
        r"(?<![0-9+.-])\(?[0-9]{2,4}\)?[ .-][0-9]{2,4}[ .-][0-9]{3,4}(?:[ .-][0-9]{2,4})?(?![0-9])",
        r"[0-9][).]?[ .-][0-9]",
    ),
    "social": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]{2}-[0-9]"),
    "account": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}"),
    "digits": (r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}+(?![0-9])", r"[0-9][ -]?[0-9]"),
}
METHODS = list(GENERATORS)

#: Bounds of training: documents that lend contexts, and trees.
SAMPLE_DOCS = 1000
TREES, DEPTH = 12, 3
RECALL = 0.98
#: Characters of context that a candidate is judged with.
LEFT, RIGHT = 24, 8


def find_all(text: Column, pattern: str, guard: str) -> Column:
    """Leftmost, non-overlapping matches as array<struct<start, value>>; start in
    code points. ``guard`` must match every text that has a match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # The pieces between the matches give the positions.
    gaps = F.zip_with(
        F.split(text, pattern, -1), found, lambda p, m: F.struct(F.char_length(p).alias("gap"), m.alias("value"))
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,value:string>>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        place = acc["at"] + x["gap"]
        one = F.array(F.struct(place.alias("start"), x["value"].alias("value")))
        return F.struct((place + F.char_length(x["value"])).alias("at"), F.concat(acc["out"], one).alias("out"))

    with_value = F.filter(gaps, lambda x: x["value"].isNotNull())
    spans = F.aggregate(with_value, start, add, lambda acc: acc["out"])
    return F.when(text.rlike(guard), spans).otherwise(F.array().cast("array<struct<start:int,value:string>>"))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def part(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + part(i))
    return (n > 0) & (total % 10 == 0)


def valid(kind: str, value: Column) -> Column:
    """Whether a match of a base pattern is a finding."""
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = digits_of(value)
        return F.length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits_of(value)).between(8, 15)
    return F.lit(True)


def base_findings(text: Column, kind: str) -> Column:
    return F.filter(find_all(text, *BASE[kind]), lambda m: valid(kind, m["value"]))


def features(method: Column, value: Column, left: Column, right: Column) -> dict[str, Column]:
    """Format and context of a candidate, as numbers."""
    n = F.char_length(value)
    digits = digits_of(value)

    def yes(c: Column) -> Column:
        return c.cast("double")

    return {
        **{f"is_{m}": yes(method == m) for m in METHODS},
        "length": n.cast("double"),
        "digits": F.length(digits).cast("double"),
        "digit_share": F.length(digits) / n,
        "gaps": F.length(F.regexp_replace(value, "[^ .()-]", "")).cast("double"),
        "capitals": F.length(F.regexp_replace(value, "[^A-Z]", "")).cast("double"),
        "kinds_of_digit": F.size(F.array_distinct(F.split(digits, ""))).cast("double"),
        "luhn": yes(luhn(digits)),
        "brackets": yes(value.rlike(r"[\[(]")),
        "year": yes(value.rlike(r"(?:^|[^0-9])(?:19|20)[0-9]{2}(?:[^0-9]|$)")),
        "domain": yes(value.rlike(r"(?i)[. )\]](?:com|org|net|edu|de|fr|es|io|co|uk|info)$")),
        "mail_near": yes(left.rlike(r"(?i)\b(?:e-?mail|write|contact|reach|address)\b")),
        "phone_near": yes(left.rlike(r"(?i)\b(?:tel|phone|call|mobile|cell|fax|contact)\b")),
        "id_near": yes(left.rlike(r"(?i)\b(?:ssn|social|security|iban|account|card|visa|passport)\b")),
        "count_near": yes(left.rlike(r"(?i)\b(?:order|version|invoice|page|isbn|ref|no|item|date)\b")),
        "joined_left": yes(left.rlike(r"[\p{L}0-9_/.=-]$")),
        "joined_right": yes(right.rlike(r"^[\p{L}0-9_/=%-]")),
        "digits_near": F.length(F.regexp_replace(F.concat(left, right), "[^0-9]", "")).cast("double"),
    }


@dataclass(frozen=True)
class Trees:
    """Weighted regression trees as nested (feature, limit, low, high) or leaf
    values, and the threshold on the margin per generator."""

    names: tuple[str, ...]
    trees: tuple[tuple[float, object], ...]
    thresholds: tuple[tuple[str, float], ...]

    def margin(self, x: dict[str, Column]) -> Column:
        def value(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, limit, low, high = node
            return F.when(x[self.names[feature]] <= limit, value(low)).otherwise(value(high))

        return reduce(lambda a, b: a + b, [F.lit(w) * value(tree) for w, tree in self.trees], F.lit(0.0))

    def accepts(self, method: Column, margin: Column) -> Column:
        limit = F.create_map(*[F.lit(v) for pair in self.thresholds for v in pair])[method]
        return margin >= limit


def parse_tree(lines: list[str]) -> object:
    """Nested form of a tree from Spark's own listing of it (consumes ``lines``)."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return float(line.split(":")[1])
    feature, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    low = parse_tree(lines)
    lines.pop(0)  # Else
    return int(feature), float(limit), low, parse_tree(lines)


def training_rows(docs: DataFrame, bound: int = SAMPLE_DOCS) -> DataFrame:
    """Labelled candidates (method, value, left, right, label, held).

    Contexts come from at most ``bound`` documents, chosen by a hash of
    doc_id, and from nowhere for as many more rows. Into each, personal data of
    every generator's layout is set, with and without a word that announces it,
    and look-alikes: dates, orders, versions, decimals, codes, plain phrases.
    """
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id").limit(bound).select(F.col("doc_id").alias("_id"))
    body = F.coalesce(F.col("text"), F.lit(""))
    here = docs.select("doc_id", body.alias("text")).join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(F.char_length("text"), F.lit(1))).cast("int") + 1
    lent = here.select(
        F.col("doc_id").alias("seed"),
        F.substring("text", place, F.lit(LEFT)).alias("left"),
        F.substring("text", place + LEFT, F.lit(RIGHT)).alias("right"),
    )
    bare = docs.sparkSession.range(bound).select(F.col("id").alias("seed"), F.lit("").alias("left"), F.lit("").alias("right"))
    base = lent.unionByName(bare)

    def number(k: int, salt: int) -> Column:
        return F.lpad(F.pmod(F.xxhash64("seed", "left", F.lit(salt)), F.lit(10**k)).cast("string"), k, "0")

    def word(salt: int) -> Column:
        h = F.lower(F.hex(F.xxhash64("seed", "left", F.lit(salt))))
        return F.translate(F.substring(h, 1, 6), "0123456789", "ghijklmnop")

    def card(salt: int) -> Column:
        # Fifteen digits and the check digit.
        d = number(15, salt)
        check = [F.when(luhn(F.concat(d, F.lit(str(c)))), F.lit(str(c))) for c in range(10)]
        return F.concat(d, F.coalesce(*check))

    def grouped(d: Column, gap: str) -> Column:
        return F.concat_ws(gap, *[F.substring(d, k, 4) for k in (1, 5, 9, 13)])

    iban = F.concat(F.lit("DE"), number(2, 31), F.lit(" "), grouped(number(16, 32), " "))
    rows = [
        ("mail", F.concat(word(1), F.lit(" (at) "), word(2), F.lit(" (dot) com")), "e-mail ", 1),
        ("mail", F.concat(word(3), F.lit("."), word(4), F.lit(" at "), word(5), F.lit(" dot org")), "write ", 1),
        ("mail", F.concat(word(6), F.lit(" at "), word(7), F.lit(".com")), "contact ", 1),
        ("mail", F.concat(word(8), F.lit(" at "), word(9), F.lit(". "), word(10)), "", 0),
        ("mail", F.concat(word(11), F.lit(" at "), word(12), F.lit("."), word(13)), "page ", 0),
        ("local", F.concat(F.lit("("), number(3, 14), F.lit(") "), number(3, 15), F.lit("-"), number(4, 16)), "call ", 1),
        ("local", F.concat_ws("-", number(3, 17), number(3, 18), number(4, 19)), "phone ", 1),
        ("local", F.concat_ws("-", F.concat(F.lit("20"), number(2, 20)), number(2, 21), number(3, 22)), "date ", 0),
        ("local", F.concat_ws(".", number(2, 23), number(2, 24), number(4, 25)), "version ", 0),
        ("local", F.concat_ws(" ", number(4, 26), number(4, 27), number(4, 28)), "order ", 0),
        ("social", F.concat_ws("-", number(3, 29), number(2, 30), number(4, 33)), "ssn ", 1),
        ("social", F.concat_ws("-", number(3, 34), number(2, 35), number(4, 36)), "order ", 0),
        ("account", iban, "iban ", 1),
        ("account", F.regexp_replace(iban, " ", ""), "account ", 1),
        ("account", F.concat(F.lit("AB"), number(2, 37), F.lit(" "), F.upper(F.concat_ws(" ", *[F.substring(word(k), 1, 4) for k in (38, 39, 40)]))), "item ", 0),
        ("digits", F.substring(card(41), 3, 14), "card ", 0),
        ("digits", grouped(card(42), " "), "card ", 1),
        ("digits", card(43), "visa ", 1),
        ("digits", number(16, 44), "order ", 0),
        ("digits", number(14, 45), "ref ", 0),
    ]
    announced = F.pmod(F.xxhash64("seed", "left", F.lit(99)), F.lit(2)) == 0
    variants = [
        F.struct(
            F.lit(m).alias("method"),
            v.alias("value"),
            F.concat("left", F.lit(" "), F.when(announced, F.lit(lead)).otherwise(F.lit(""))).alias("left"),
            F.concat(F.lit(" "), "right").alias("right"),
            F.lit(float(label)).alias("label"),
            F.lit(k).alias("layout"),
        )
        for k, (m, v, lead, label) in enumerate(rows)
    ]
    held = F.pmod(F.xxhash64("seed", "left", F.lit(7)), F.lit(4)) == 0
    return base.select(held.alias("held"), F.inline(F.array(*variants)))


def train(docs: DataFrame, bound: int = SAMPLE_DOCS, recall: float = RECALL) -> Trees:
    """Boosted trees over the labelled candidates. A quarter of the contexts is
    held out; each generator's threshold is the largest margin that keeps
    ``recall`` of its held-out personal data, if it rejects nine in ten of its
    look-alikes, else the margin that does (a redaction must be likely)."""
    rows = training_rows(docs, bound)
    x = features(F.col("method"), F.col("value"), F.col("left"), F.col("right"))
    table = materialize(rows.select("held", "method", "label", *[c.alias(n) for n, c in x.items()]))
    names = tuple(x)
    vectors = VectorAssembler(inputCols=list(names), outputCol="features").transform(table.where("not held"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1, labelCol="label").fit(
        vectors.select("features", "label")
    )
    trees = []
    for tree, weight in zip(model.trees, model.treeWeights):
        trees.append((float(weight), parse_tree(tree.toDebugString.strip().split("\n")[1:])))
    fitted = Trees(names, tuple(trees), ())
    margins = table.where("held").select("method", "label", fitted.margin({n: F.col(n) for n in names}).alias("margin"))
    cut = margins.groupBy("method").agg(
        F.expr(f"percentile(margin, {1 - recall}) filter (where label = 1)").alias("low"),
        F.expr("percentile(margin, 0.9) filter (where label = 0)").alias("high"),
    )
    # One row per generator.
    limits = {r["method"]: r for r in cut.collect()}
    thresholds = []
    for m in METHODS:
        low, high = (limits[m]["low"], limits[m]["high"]) if m in limits else (0.0, 0.0)
        thresholds.append((m, float(max(low if low is not None else 0.0, high if high is not None else 0.0, 0.0))))
    return Trees(names, tuple(trees), tuple(thresholds))


def with_spans(docs: DataFrame, model: Trees, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``findings``: all spans as array<struct<kind, start,
    end>>, base findings in the order of KINDS, then the accepted candidates of
    each generator; by start within a kind. Base counts come along as n_<kind>.

    A candidate that overlaps a base finding is not reported again; candidates
    of different generators may overlap. NULL texts count as empty.
    """
    rows = docs.select(F.struct(*keep).alias("_row"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    text = F.col("_text")
    for kind in KINDS:
        rows = rows.withColumn(f"_{kind}", base_findings(text, kind))
    for method, (pattern, guard) in GENERATORS.items():
        rows = rows.withColumn(f"_{method}", find_all(text, pattern, guard))

    def span(kind: str):
        return lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), (m["start"] + F.char_length(m["value"])).alias("end")
        )

    base = F.concat(*[F.transform(f"_{kind}", span(kind)) for kind in KINDS])
    rows = rows.withColumn("_base", base)

    def accepted(method: str) -> Column:
        def ok(m: Column) -> Column:
            start, end = m["start"], m["start"] + F.char_length(m["value"])
            left = F.substring(text, F.greatest(start - LEFT + 1, F.lit(1)), F.least(start, F.lit(LEFT)))
            right = F.substring(text, end + 1, F.lit(RIGHT))
            x = features(F.lit(method), m["value"], left, right)
            clear = ~F.exists("_base", lambda b: (b["start"] < end) & (start < b["end"]))
            return clear & (model.margin(x) >= dict(model.thresholds)[method])

        return F.transform(F.filter(f"_{method}", ok), span(method))

    rows = rows.withColumn("findings", F.concat("_base", *[accepted(m) for m in METHODS]))
    counts = [F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS]
    return rows.select("_row.*", *counts, "_base", "findings")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_personal_data(docs: DataFrame, model: Trees, keep: list[str]) -> DataFrame:
    """``keep`` columns, counts of base findings, base_sha256 and spans
    (kind:start:end in code points, by kind and start).

    NULL and empty texts have no findings (counts 0, the hash of the empty string,
    empty spans). Whole texts of any length are searched; equal rows get equal
    results; an empty table gives no rows. Only ``keep`` (any names but those of
    the results) and ``text`` are read.
    """
    found = with_spans(docs, model, keep)
    return found.select(
        *keep,
        *[f"n_{kind}" for kind in KINDS],
        F.sha2(joined(F.col("_base")), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"),
    )


def redact(docs: DataFrame, model: Trees, keep: list[str], mark: str = "[{}]") -> DataFrame:
    """``keep`` columns and ``redacted``: the text with every span replaced by
    its kind in brackets. Of overlapping spans the first stays, then the longer.
    A text without findings stays as it is, a NULL text NULL; else as
    ``find_personal_data``."""
    found = with_spans(docs.select(*keep, "text"), model, [*dict.fromkeys([*keep, "text"])])
    ordered = F.array_sort(F.transform("findings", lambda s: F.struct(s["start"], (-s["end"]).alias("last"), s["kind"])))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        end = -s["last"]
        gap = F.substring("text", acc["at"] + 1, s["start"] - acc["at"])
        marked = F.concat(acc["out"], gap, F.lit(mark.split("{}")[0]), s["kind"], F.lit(mark.split("{}")[1]))
        fits = s["start"] >= acc["at"]
        return F.struct(F.when(fits, end).otherwise(acc["at"]).alias("at"), F.when(fits, marked).otherwise(acc["out"]).alias("out"))

    rest = F.aggregate(
        ordered, start, add, lambda acc: F.concat(acc["out"], F.substring("text", acc["at"] + 1, F.length("text")))
    )
    return found.select(*keep, rest.alias("redacted"))
