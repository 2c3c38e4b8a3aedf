"""Personal data: spans of four plain patterns, and candidates that boosted trees select.

High-recall generators propose spans, which may overlap: digit groups, spelled-out mail addresses,
account numbers, device addresses. Gradient-boosted trees score a candidate by its format (digits,
groups, separators, length) and its context (what stands before and after it, words nearby). Examples
are candidates that a plain pattern confirms or that pass a test of their own form: an address that is a
mail address once it is spelled back, an account number whose remainder by 97 is 1, a well-formed device
address. The others are counter-examples; some rules that tell them apart (the leading plus, the dots, the
remainder) are no features, so that format and context have to. The trees are fitted on a bounded sample
of the candidates of each generator and label, so that rare ones take part. Each generator's threshold
is calibrated on the candidates of all documents that aren't trained on: it is the least score at which
``PRECISION`` of the candidates are examples, as are of those at this score or above.
Plain spans stay whatever the trees say. All is built from DataFrame functions; the trees become
one expression.

Defined results: null text is empty text and has no spans; if the table holds too few examples or
counter-examples, only plain spans are found; repeated rows are searched each; an empty table gives
an empty one; other columns are ignored. Offsets are code points, ends excluded. A document with n
spans of a kind costs n^2 array copies, which matters from thousands of spans on.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ..sinks.files import stored

KINDS = ("email", "ip", "card", "phone")
#: Candidates of a generator and label that the trees are trained on, at most about so many and 3 of 4.
SAMPLE = 5_000
_DRAWS = 1 << 40
#: Least number of examples and of counter-examples.
EXAMPLES = 20
TREES, DEPTH = 12, 3
PRECISION = 0.95
CONTEXT = 24

# The base patterns (fixed values), written so that a search is linear in the text: a match begins at
# the first character of its run, and possessive parts never give anything back.
_EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
)
_IP = r"[0-9](?<![0-9]{2})[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++"
# Only runs of 13 to 19 digits can pass, and a run never begins inside another.
_CARD = r"[0-9](?<![0-9]{2})(?<![0-9][ -][0-9])(?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"

# Generators: name, pattern, and a quicker test that texts with a match pass.
GENERATORS = (
    ("number", r"[0-9](?<![A-Za-z0-9][0-9])(?:[ ().\-/]{0,2}[0-9]){6,18}+(?![A-Za-z0-9])", "[0-9]"),
    (
        "address",
        r"[A-Za-z0-9._%+-](?<![A-Za-z0-9._%+-]{2})[A-Za-z0-9._%+-]{0,63}+ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}"
        r"(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]{2,63}){1,8}",
        r"[\[(]at[\])]",
    ),
    ("account", r"[A-Z](?<![A-Za-z0-9][A-Z])[A-Z][0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}"),
    ("device", r"[0-9A-Fa-f](?<![0-9A-Za-z:][0-9A-Fa-f])[0-9A-Fa-f]{0,3}(?::[0-9A-Fa-f]{1,4}){5,7}(?![0-9A-Za-z:])", "[0-9A-Fa-f]:[0-9A-Fa-f]"),
)
# Words nearby that speak for or against personal data (fixed values).
_HINTS = {
    "near_phone": "phone|tel|call|fax|mobile|cell|whatsapp",
    "near_mail": "mail|contact|write to|reach",
    "near_card": "card|visa|master|credit|debit|paid|payment",
    "near_person": "ssn|social|passport|licen[cs]e no|tax|born|birth|patient|member",
    "near_bank": "iban|account|bank|swift|bic",
    "near_host": r"\bip\b|host|server|mac|client",
    "near_thing": "order|invoice|version|isbn|issn|serial|model|page|ref|no\\.|part|build|doi",
}
_SPAN = "struct<start:bigint,end:bigint,value:string>"


def _spans(text: Column, pattern: str, possible: Column) -> Column:
    """Start, end and text of all matches: where a match lies follows from what stands between them."""
    none = F.array().cast(f"array<{_SPAN}>")
    pairs = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"),
    )
    state = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["value"])
        span = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        longer = F.struct(
            end.cast("bigint").alias("at"),
            F.concat(state["spans"], F.array(span).cast(f"array<{_SPAN}>")).alias("spans"),
        )
        return F.when(x["value"].isNull(), state).otherwise(longer)

    found = F.aggregate(pairs, state, step, lambda s: s["spans"])
    return F.when(possible, found).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _passes_luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled, and its digits added."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, -i, F.lit(1)).try_cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    places = F.sequence(F.lit(1), F.greatest(F.char_length(digits), F.lit(1)))
    return F.coalesce(F.aggregate(places, F.lit(0), add) % 10 == 0, F.lit(False))


def _passes_97(value: Column) -> Column:
    """The remainder of an account number: its first four characters come last, letters count from 10."""
    value = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(value, F.lit(5)), F.substr(value, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.char_length(turned)), F.lit(0), add) == 1


def _well_formed(name: str, value: Column) -> Column:
    """Whether a candidate passes the test of its own generator's form."""
    if name == "address":
        spelled = F.regexp_replace(value, r" ?[(\[]at[)\]] ?", "@")
        spelled = F.regexp_replace(spelled, r" ?(?:\(dot\)|\[dot\]|\.) ?", ".")
        return spelled.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$")
    if name == "account":
        return _passes_97(value)
    if name == "device":
        return value.rlike("^(?:[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){5}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7})$")
    return F.lit(False)


def with_base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text (never null) and an array of spans per kind."""
    text = F.col("text")
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text",
        _spans(text, _EMAIL, F.contains(text, F.lit("@"))).alias("email"),
        _spans(text, _IP, text.rlike(r"[0-9]\.[0-9]")).alias("ip"),
        _spans(text, _CARD, text.rlike("[0-9][ -]?[0-9]")).alias("card"),
        _spans(text, _PHONE, F.contains(text, F.lit("+"))).alias("phone"),
    )
    return found.select(
        "doc_id", "text", "email",
        F.filter("ip", lambda s: s["value"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")).alias("ip"),
        F.filter("card", lambda s: _passes_luhn(_digits(s["value"]))).alias("card"),
        F.filter("phone", lambda s: F.char_length(_digits(s["value"])).between(9, 15)).alias("phone"),
    )


def _overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def _features(text: Column, span: Column, generator: int) -> dict[str, Column]:
    value = span["value"]
    digits = _digits(value)
    before = F.lower(F.substr(text, F.greatest(span["start"] - CONTEXT, F.lit(0)) + 1, F.least(span["start"], F.lit(CONTEXT))))
    after = F.lower(F.substr(text, span["end"] + 1, F.lit(CONTEXT)))
    groups = F.split(value, "[^0-9A-Za-z]+", -1)
    near = F.concat_ws(" ", before, after)
    return {
        "generator": F.lit(generator),
        "digits": F.char_length(digits),
        "chars": F.char_length(value),
        "separators": F.char_length(F.regexp_replace(value, "[0-9A-Za-z]", "")),
        "groups": F.size(groups),
        "longest_group": F.array_max(F.transform(groups, F.char_length)),
        "first_group": F.char_length(F.element_at(groups, 1)),
        "last_group": F.char_length(F.element_at(groups, -1)),
        "different_digits": F.size(F.array_distinct(F.split(digits, ""))),
        "check_digit": _passes_luhn(digits),
        "brackets": F.contains(value, F.lit("(")),
        "slashes": F.contains(value, F.lit("/")),
        "stands_alone": before.rlike(r"(^|\s)$"),
        "ends_alone": after.rlike(r"^($|[\s.,;!?])"),
        "labelled": before.rlike("[:=]\\s*$"),
        "after_number": before.rlike("[0-9]\\s*$"),
        **{name: near.rlike(words) for name, words in _HINTS.items()},
    }


def _candidate(text: Column, name: str, number: int, plain: Column) -> Callable[[Column], Column]:
    def made(span: Column) -> Column:
        features = [f.cast("double").alias(n) for n, f in _features(text, span, number).items()]
        return F.struct(
            F.lit(name).alias("generator"), span["start"].alias("start"), span["end"].alias("end"),
            _overlaps(span, plain).alias("plain"),
            (_overlaps(span, plain) | _well_formed(name, span["value"])).alias("confirmed"),
            F.struct(*features).alias("features"),
        )

    return made


def with_candidates(docs: DataFrame) -> DataFrame:
    """with_base_spans(), and ``candidates``: generator, span, features, whether it overlaps a plain span, and its label."""
    base = with_base_spans(docs)
    proposed = base.select(
        "*",
        *[_spans(F.col("text"), pattern, F.col("text").rlike(possible)).alias(f"by_{name}") for name, pattern, possible in GENERATORS],
    )
    plain = F.concat(*[F.col(k) for k in KINDS])
    candidates = [
        F.transform(f"by_{name}", _candidate(F.col("text"), name, i, plain))
        for i, (name, _, _) in enumerate(GENERATORS)
    ]
    return proposed.select("doc_id", "text", *KINDS, F.concat(*candidates).alias("candidates"))


class Selector:
    """Trees and a threshold per generator; no trees select nothing."""

    def __init__(self, trees: list, weights: list[float], thresholds: dict[str, float], names: list[str]):
        self.trees, self.weights, self.thresholds, self.names = trees, weights, thresholds, names

    def score(self, features: Column) -> Column:
        """Probability that a candidate is personal data."""

        def value(node) -> Column:
            if node.getClass().getSimpleName() == "LeafNode":
                return F.lit(float(node.prediction()))
            split = node.split()
            at_most = features[self.names[split.featureIndex()]] <= float(split.threshold())
            return F.when(at_most, value(node.leftChild())).otherwise(value(node.rightChild()))

        margin = reduce(Column.__add__, [F.lit(w) * value(t) for t, w in zip(self.trees, self.weights, strict=True)])
        return 1 / (1 + F.exp(-2 * margin))

    def selects(self, candidate: Column) -> Column:
        if not self.thresholds:
            return F.lit(False)
        least = F.coalesce(*[
            F.when(candidate["generator"] == name, F.lit(least)) for name, least in self.thresholds.items()
        ])
        return F.coalesce(self.score(candidate["features"]) >= least, F.lit(False)) & ~candidate["plain"]


def thresholds(counts: list[tuple[str, int, int, int]]) -> dict[str, float]:
    """The threshold of each generator that has one, from generator, score in hundredths, examples and candidates."""
    out, good, every = {}, Counter(), Counter()
    for name, score, some, many in sorted(counts, key=lambda row: -row[1]):
        good[name] += some
        every[name] += many
        if some >= PRECISION * many and good[name] >= PRECISION * every[name]:
            out[name] = score / 100
    return out


def train(docs: DataFrame, sample: int = SAMPLE) -> Selector:
    """From the candidates of all documents; a hash of doc_id and text draws those that the trees are fitted on."""
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(_DRAWS)).alias("draw")
    held = stored(with_candidates(docs).select(draw, "candidates"), "candidates")
    names = held.select(F.col("candidates")[0]["features"].alias("f")).select("f.*").columns
    label = F.col("c.confirmed").cast("double").alias("label")
    rows = held.select("draw", F.explode("candidates").alias("c"))
    many = rows.groupBy("c.generator", "c.confirmed").count().collect()  # at most 2 a generator

    def is_drawn(c: Column) -> Column:
        return F.coalesce(*[
            F.when(
                (c["generator"] == r["generator"]) & (c["confirmed"] == r["confirmed"]),
                F.col("draw") < int(_DRAWS * min(0.75, sample / r["count"])),
            ) for r in many
        ], F.lit(False))

    drawn = held.select(F.explode(F.filter("candidates", is_drawn)).alias("c"))
    drawn = stored(drawn.select(F.col("c.generator").alias("of"), label, "c.features.*"), "drawn")
    parts = drawn.groupBy("of", "label").count().collect()
    few = [sum(r["count"] for r in parts if r["label"] == kind) for kind in (0, 1)]
    if min(few) < EXAMPLES:
        return Selector([], [], {}, names)
    # Each generator and label weighs the same.
    weight = F.coalesce(*[
        F.when((F.col("of") == r["of"]) & (F.col("label") == r["label"]), F.lit(sum(few) / len(parts) / r["count"]))
        for r in parts
    ])
    assembled = VectorAssembler(inputCols=names, outputCol="x").transform(drawn.withColumn("weight", weight))
    model = GBTClassifier(
        featuresCol="x", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=1
    ).fit(assembled)
    trees = [t._call_java("rootNode") for t in model.trees]
    selector = Selector(trees, list(model.treeWeights), {}, names)
    rest = held.filter(~F.exists("candidates", is_drawn)).select(F.explode("candidates").alias("c"))
    scored = rest.select(
        F.col("c.generator").alias("generator"), label,
        F.floor(100 * selector.score(F.col("c.features"))).cast("int").alias("score"),
    )
    counts = scored.groupBy("generator", "score").agg(F.sum("label").alias("good"), F.count("*").alias("all"))
    selector.thresholds = thresholds(counts.collect())  # at most 101 scores a generator
    return selector


def _joined(spans: dict[str, Column]) -> Column:
    def written(kind: str, held: Column) -> Column:
        return F.transform(held, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    return F.array_join(F.concat(*[written(kind, held) for kind, held in spans.items()]), ",")


def _of(name: str) -> Column:
    return F.filter("more", lambda c: c["generator"] == name)


def with_spans(docs: DataFrame, selector: Selector) -> DataFrame:
    """doc_id, text, the base spans by kind, and ``more``, the candidates that were selected."""
    if not selector.thresholds:
        none = F.array().cast("array<struct<generator:string,start:bigint,end:bigint>>")
        return with_base_spans(docs).withColumn("more", none)
    chosen = F.transform(
        F.filter("candidates", selector.selects),
        lambda c: F.struct(c["generator"].alias("generator"), c["start"].alias("start"), c["end"].alias("end")),
    )
    return with_candidates(docs).select("doc_id", "text", *KINDS, chosen.alias("more"))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, their digest, and all spans."""
    found = with_spans(docs, train(docs))
    base = {k: F.col(k) for k in KINDS}
    more = {name: _of(name) for name, _, _ in GENERATORS}
    return found.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(base | more).alias("spans"),
    )


def redacted(docs: DataFrame, selector: Selector, mark: str = "[PII]") -> DataFrame:
    """doc_id and its text with every span, overlapping ones as one, replaced by ``mark``."""
    found = with_spans(docs, selector)
    place = "array<struct<start:bigint,end:bigint>>"
    bare = [
        F.transform(F.col(c), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).cast(place)
        for c in (*KINDS, "more")
    ]
    spans = F.array_sort(F.concat(*bare))
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(state: Column, s: Column) -> Column:
        begins = F.concat(
            state["out"], F.substr(F.col("text"), (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int")),
            F.lit(mark),
        )
        return F.struct(
            F.when(s["start"] >= state["at"], begins).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], s["end"]).alias("at"),
        )

    rest = F.aggregate(spans, state, step, lambda s: F.concat(s["out"], F.substr(F.col("text"), (s["at"] + 1).cast("int"))))
    return found.select("doc_id", rest.alias("text"))
