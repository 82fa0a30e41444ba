"""Personal data: generators propose spans, boosted trees judge them, calibrated thresholds select.

Everything here is DataFrame functions and Spark's own gradient-boosted trees; no Python runs on the executors.

1. Four fixed formats (email, ip, card, phone) are found by regular expressions. Positions follow from the lengths of the
   pieces between the matches. What passes its format's check is a base span and always stays.
2. Further generators propose what the formats miss: neighbouring groups of 13 to 19 digits with a right check digit in any
   run that failed, phone numbers without a plus, written-out mail addresses, IPv6 and dotted addresses with brackets. Their
   spans may overlap each other and the base.
3. Trees are trained on labels that their features don't hold: passed matches of the formats against look-alikes (groups of
   digits with a wrong check digit, dotted numbers out of range or with another number of parts, bare numbers, dates, `a@b`).
   The features are the leading digits, grouping, separators, neighbouring characters and words before; neither the
   check digit nor a length is among them. Where nearly all look-alikes of a place pass the check, what was proposed there is
   personal data; where one in ten does, it passes by chance. Equal feature rows are one weighted row.
4. On documents left out of the training (by hash of the text), each kind's threshold is the lowest score from which on
   `precision` of the spans are right; a kind with few left-out spans takes the threshold of all kinds together. Proposals
   above it that touch no base span of their kind are added, best first.

Defined cases: a null or empty text has no spans; repeated rows and null ids are reported row by row; without passed and
failed matches to learn from nothing is added; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.tables import set_down, texts

KINDS = ("email", "ip", "card", "phone")
# The formats. Possessive quantifiers and the looks behind only spare the matcher vain attempts: a match
# that fails at the first character of a run fails at all others too.
FORMATS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this character has no match; shorter matches cannot pass nor hold a card.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
LEAST = {"email": 1, "ip": 1, "card": 13, "phone": 1}
# Patterns that begin with a look behind take the first character before it: at most places that alone fails.
GENERATORS = [
    ("email", " ", r"(?i)\b[a-z0-9._%+-]{2,64}\x20?(?:\(at\)|\[at\]|\{at\})\x20?[a-z0-9-]{2,64}\x20?(?:\(dot\)|\[dot\]|\{dot\}|\.)\x20?[a-z]{2,12}\b"),
    ("ip", ":", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    ("ip", "[", r"(?<![0-9])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}(?![0-9])"),
    ("phone", None, r"[(0-9](?<![0-9+.-][(0-9])(?:(?<=\()[0-9]{3}|(?<=[0-9])[0-9]{2})\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])"),
]
# Look-alikes: spans that are surely not of the kind.
OTHERS = [
    ("email", "@", r"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,64}(?![A-Za-z0-9.-])"),
    ("ip", ".", r"[0-9](?<![0-9.][0-9])[0-9]{0,8}(?:\.[0-9]{1,9}){2}(?:(?:\.[0-9]{1,9}){2,6})?+(?!\.?[0-9])"),
    ("phone", None, r"[0-9](?<![0-9+.-][0-9])(?:[0-9]{6,11}|[0-9]{0,3}([./-])[0-9]{1,2}\1[0-9]{1,4})(?![0-9.-])"),
]
WORDS = {
    "email": r"(?i)(mail|contact|write|reach|send|\bat\b)", "ip": r"(?i)(\bip\b|address|host|server|client|from|node)",
    "card": r"(?i)(card|visa|amex|master|credit|debit|paid|charge|account)", "phone": r"(?i)(phone|tel|call|mobile|cell|fax|dial)",
}
FOUND = "array<struct<start: long, end: long, value: string, before: string, after: string>>"
FEATURES = ["kind_number", "lead", "grouped", "separators", "letters", "before_class", "after_class", *[f"near_{k}" for k in KINDS]]


def size(column: Column) -> Column:
    return F.length(column).cast("long")


def matches(text: Column, pattern: str, needs: str | None = None, least: int = 1) -> Column:
    """Non-overlapping matches from the left: code-point positions, the text, and what stands next to it.

    Matches shorter than `least` only move the position on. Found ones are gathered in blocks, since every addition to an
    array copies it.
    """
    pieces, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    follows = F.slice(pieces, F.lit(2), F.size(pieces))
    steps = F.arrays_zip(pieces.alias("piece"), values.alias("value"), follows.alias("follows"))
    none, no_blocks = F.array().cast(FOUND), F.array().cast(f"array<{FOUND}>")

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + size(x["piece"])
        end = start + size(x["value"])
        one = F.struct(
            start.alias("start"), end.alias("end"), x["value"].alias("value"),
            F.right(x["piece"], F.lit(24)).alias("before"), F.left(x["follows"], F.lit(1)).alias("after"),
        )
        wanted = F.coalesce(F.length(x["value"]) >= least, F.lit(False))
        full = wanted & (F.size(state["block"]) >= 256)
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.when(full, F.concat(state["blocks"], F.array(state["block"]))).otherwise(state["blocks"]).alias("blocks"),
            F.when(full, F.array(one)).when(wanted, F.concat(state["block"], F.array(one))).otherwise(state["block"]).alias("block"),
        )

    empty = F.struct(F.lit(0).cast("long").alias("at"), no_blocks.alias("blocks"), none.alias("block"))
    found = F.aggregate(steps, empty, add, lambda s: F.flatten(F.concat(s["blocks"], F.array(s["block"]))))
    return F.when(F.contains(text, F.lit(needs)), found).otherwise(none) if needs else found


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(
            F.split(value, r"\."),
            lambda part: F.coalesce(F.regexp_extract(part, r"^0*([0-9]{1,3})$", 1).try_cast("int"), F.lit(256)) <= 255,
        )
    if kind == "card":
        return F.length(digits(value)).between(16, 19) & F.call_function("luhn_check", digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    return F.lit(True)


def groups_of(run: Column) -> Column:
    """Up to five neighbouring groups of a run of digits that together have the digits of a card."""
    parts = matches(run["value"], "[0-9]+")

    def from_group(_, i: Column) -> Column:
        def window(n: Column) -> Column:
            last = F.get(parts, i + n - 1)
            first = F.get(parts, i)
            value = F.substring(run["value"], (first["start"] + 1).cast("int"), (last["end"] - first["start"]).cast("int"))
            return F.struct(
                (run["start"] + first["start"]).alias("start"), (run["start"] + last["end"]).alias("end"), value.alias("value"),
                F.when(i == 0, run["before"]).otherwise(F.concat(run["before"], first["before"])).alias("before"),
                F.when(i + n == F.size(parts), run["after"]).otherwise(last["after"]).alias("after"),
            )

        return F.transform(F.sequence(F.lit(1), F.least(F.lit(5), F.size(parts) - i)), window)

    return F.filter(F.flatten(F.transform(parts, from_group)), lambda x: F.length(digits(x["value"])).between(13, 19))


def tagged(found: Column, kind: str, label: int | None) -> Column:
    return F.transform(
        found,
        lambda x: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"),
            x["before"].alias("before"), x["after"].alias("after"), F.lit(label).cast("int").alias("label"),
        ),
    )


def candidates(docs: DataFrame) -> DataFrame:
    """(row, doc_id, left_out, spans): all candidates of a document, with label 1 (base spans), 0 or null (proposals)."""
    text = F.coalesce("text", F.lit(""))
    rows = texts(docs).select("doc_id", text.alias("text"))
    rows = rows.select("doc_id", "text", *[matches(F.col("text"), FORMATS[k], NEEDS[k], LEAST[k]).alias(f"all_{k}") for k in KINDS])
    good = {k: _split(k, True) for k in KINDS}
    bad = {k: _split(k, False) for k in KINDS}
    groups = F.flatten(F.transform(bad["card"], groups_of))
    by_chance = lambda x: F.call_function("luhn_check", digits(x["value"]))
    rows = rows.select("*", groups.alias("groups"))
    labelled = [tagged(good[k], k, 1) for k in KINDS] + [tagged(bad[k], k, 0) for k in KINDS if k != "card"]
    labelled += [tagged(F.filter("groups", lambda x: ~by_chance(x)), "card", 0)]
    labelled += [tagged(matches(F.col("text"), p, needs), k, 0) for k, needs, p in OTHERS]
    proposed = [tagged(F.filter("groups", by_chance), "card", None)]
    proposed += [tagged(matches(F.col("text"), p, needs), k, None) for k, needs, p in GENERATORS]
    left_out = F.pmod(F.xxhash64("text"), F.lit(5)) == 0  # equal texts go the same way
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", left_out.alias("left_out"), F.concat(*labelled, *proposed).alias("spans"))


def _split(kind: str, good: bool) -> Column:
    """The matches of a kind that pass its check, or those that fail."""
    return F.filter(f"all_{kind}", lambda x: passes(kind, x["value"]) if good else ~passes(kind, x["value"]))


def char_class(c: Column) -> Column:
    return (
        F.when(c.isNull() | (c == ""), 0).when(c.rlike(r"^\s$"), 1).when(c.rlike("^[0-9]$"), 2).when(c.rlike(r"^\p{L}$"), 3).otherwise(4)
    )


def with_features(spans: DataFrame) -> DataFrame:
    value, parts = F.col("value"), F.expr("filter(split(value, '[^0-9]+'), x -> x <> '')")
    apart = F.array_distinct(F.split(F.regexp_replace(value, "[A-Za-z0-9]", ""), ""))
    columns = {
        "kind_number": F.col("kind"), "lead": F.left(digits(value), F.lit(2)).try_cast("int"), "grouped": (F.size(parts) > 1).cast("int"),
        "separators": F.least(F.size(F.filter(apart, lambda c: c != "")), F.lit(4)), "letters": value.rlike("[A-Za-z]").cast("int"),
        "before_class": char_class(F.right("before", F.lit(1))), "after_class": char_class(F.col("after")),
    }
    columns |= {f"near_{k}": F.col("before").rlike(words).cast("int") for k, words in WORDS.items()}
    return spans.withColumns({name: F.coalesce(c.cast("double"), F.lit(-1.0)) for name, c in columns.items()})


def thresholds(scored: DataFrame, precision: float, least: int = 20) -> dict[int, float]:
    """Of each kind the lowest score from which on `precision` of the left-out spans are right.

    A kind with fewer than `least` left-out spans takes the lowest score of all kinds together.
    """
    bins = scored.groupBy("kind", F.floor(F.col("score") * 1000).alias("bin")).agg(F.sum("label").alias("right"), F.count(F.lit(1)).alias("n"))
    rows = sorted(bins.collect(), key=lambda r: -r["bin"])  # at most a thousand bins of each kind

    def lowest(some: list) -> float | None:
        right, n, limit = 0, 0, None
        for k, r in enumerate(some):
            right, n = right + r["right"], n + r["n"]
            whole_bin = k + 1 == len(some) or some[k + 1]["bin"] != r["bin"]
            if whole_bin and right >= precision * n:
                limit = r["bin"] / 1000
        return limit

    own = {kind: [r for r in rows if r["kind"] == kind] for kind in range(len(KINDS))}
    limits = {kind: lowest(some if sum(r["n"] for r in some) >= least else rows) for kind, some in own.items()}
    return {kind: limit for kind, limit in limits.items() if limit is not None}


def judged(spans: DataFrame, precision: float, trees: int, depth: int) -> DataFrame | None:
    """The proposals (label null) that the trees select: row, kind, start, end, score."""
    rows = with_features(spans)
    known = rows.where("label is not null")
    counts = known.where("not left_out").groupBy("label", *FEATURES).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    train = set_down(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(counts), "pii-training")
    if train.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=1).fit(train)

    def score(some: DataFrame) -> DataFrame:
        out = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(some))
        return out.withColumn("score", vector_to_array("probability")[1])

    limits = thresholds(score(known.where("left_out")), precision)
    if not limits:
        return None
    enough = F.lit(False)
    for kind, limit in limits.items():
        enough = enough | ((F.col("kind") == kind) & (F.col("score") >= limit))
    return score(rows.where("label is null")).where(enough).select("row", "kind", "start", "end", "score")


SPAN = "array<struct<kind: int, start: long, end: long>>"


def found(docs: DataFrame, precision: float = 0.99, trees: int = 10, depth: int = 3) -> DataFrame:
    """(doc_id, base, spans): the spans of the formats, and all selected spans, by kind and start."""
    rows = set_down(candidates(docs), "pii-candidates")
    selected = judged(rows.select("row", "left_out", F.inline("spans")), precision, trees, depth)
    base = F.transform(
        F.filter("spans", lambda x: x["label"] == 1), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
    )
    rows = rows.select("row", "doc_id", F.array_sort(base).alias("base"))
    none = F.array().cast(SPAN)
    if selected is None:
        return rows.select("doc_id", "base", F.col("base").alias("spans"))
    best = F.struct((-F.col("score")).alias("low"), (F.col("start") - F.col("end")).alias("short"), "kind", "start", "end")
    more = selected.groupBy("row").agg(F.array_sort(F.collect_set(best)).alias("more"))  # a document's own proposals

    def touches(x: Column, y: Column) -> Column:
        return (x["kind"] == y["kind"]) & (x["start"] < y["end"]) & (y["start"] < x["end"])

    def add(taken: Column, x: Column) -> Column:
        one = F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
        return F.when(F.exists(taken, lambda y: touches(x, y)), taken).otherwise(F.concat(taken, F.array(one)))

    both = rows.join(more, "row", "left")
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.aggregate("more", F.coalesce("base", none), add)))
    return both.select("doc_id", "base", spans.alias("spans"))


def digest(spans: DataFrame) -> DataFrame:
    """Counts of the base spans, a checksum of them, and all spans as text."""

    def shown(column: str) -> Column:
        name = F.array(*[F.lit(k) for k in KINDS])
        one = F.transform(column, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(one, ",")

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return spans.select("doc_id", *[number(k) for k in range(4)], F.sha2(shown("base"), 256).alias("base_sha256"), shown("spans").alias("spans"))
