"""PII redaction: candidate spans judged by gradient-boosted trees, with Spark functions only.

Base spans follow fixed patterns and checks (email, ip, card, phone) and always count.
High-recall generators propose further spans, which may overlap: digit groups that could
be a phone number written nationally, spelled-out email addresses, and long mixed tokens that could be
a secret. Each gets features of its format and of the text around it. Boosted
trees, trained in the JVM on a small labelled table that Spark derives from a rule, are
compiled into one Spark expression; a generator's threshold is the least score at which the held-out half
of that table has the wanted precision. Candidates that reach it and meet no base span
are added.

Patterns start only where a longest run can start and use possessive repetition, so
matching takes time in proportion to the text and no deep recursion, whatever the text.

Defined cases: a null text counts as empty and has no spans; positions are code points,
ends exclusive; spans of different kinds may overlap, and redaction merges overlapping
spans under the first one's kind; repeated rows are judged each; extra columns are ignored
by spans and kept by redaction; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallykeep.llm.common import free_name, plain_text

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("email_spelled", "phone_national", "secret")

# A local part starts where its run of characters starts, or where the last match ended;
# from other places of the run a match would start only if it did from there.
_LOCAL = r"A-Za-z0-9._%+\-"
_BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # whole runs of 13 to 19 digits; runs of other lengths would fail the check
    "card": r"(?<![0-9])(?<![0-9][ \-])[0-9](?:[ \-]?[0-9]){12,18}+(?![ \-]?[0-9])",
    "phone": r"\+[0-9][ ().0-9\-]+[0-9]",
}
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

# Parts and groups of any number and length: every repetition is possessive and needs nothing
# after it, so a start that fails has read one part only.
_GENERATORS = {
    "email_spelled": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++ ?[\[(]? ?(?:at|AT) ?[\])]? ?[A-Za-z0-9\-]++"
    r"(?: ?[\[(]? ?(?:dot|DOT) ?[\])]? ?[A-Za-z0-9\-]++)++",
    # two groups or more, or one that starts with a zero
    "phone_national": r"(?<![0-9A-Za-z+.\-])(?:[(]?[0-9]{2,}+(?![A-Za-z])[)]?(?:[ .\-]{1,2}[0-9]{2,}+(?![A-Za-z]))++|0[0-9]{6,}+(?![A-Za-z]))",
    "secret": r"(?<![A-Za-z0-9_\-])[A-Za-z0-9_\-]{20,}+",
}

# Code points before a candidate that count as its context.
CONTEXT_CHARS = 24
_CONTEXT = {
    "says_contact": "(?i)(mail|contact|write|reach)",
    "says_phone": "(?i)(phone|tel|call|fax|mobile|whatsapp)",
    "says_secret": "(?i)(token|secret|password|passwd|api|key|auth|bearer)",
    "assigned": "[=:] ?[\"']?$",
    # one of the dotted parts of a long token
    "joined": r"[A-Za-z0-9_\-]{16}\.$",
}
FEATURES = (
    "length", "digits", "letters", "uppers", "separators", "groups", "brackets", "switches", *_CONTEXT,
)

# Trees, their depth, and the precision a threshold must show on held-out rows.
TREES, TREE_DEPTH = 8, 3
LABELLED_ROWS = 4500
WANTED_PRECISION = 0.99


def _located(text: Column, pattern: str) -> Column:
    """Matches of a pattern as (start, end, found), from the pieces between them."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches)
    lengths = F.transform(zipped, lambda one: F.struct(F.length(one["gap"]).alias("gap"), one["found"].alias("found")))
    # one step per match; documents have few
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(state: Column, one: Column) -> Column:
        begin = state["at"] + one["gap"]
        end = begin + F.coalesce(F.length(one["found"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), one["found"].alias("found"))
        return F.struct(end.alias("at"), F.when(one["found"].isNotNull(), F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(lengths, start, step, lambda state: state["spans"])


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(found: Column) -> Column:
    """The check of card numbers: every second digit from the right counts double."""
    digits = F.reverse(_digits(found))

    def value(at: Column) -> Column:
        digit = F.substring(digits, at, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when(at % 2 == 0, doubled).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda sum_, at: sum_ + value(at))
    return total % 10 == 0


def _passes(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")
    if kind == "card":
        return _luhn(found)
    if kind == "phone":
        return F.length(_digits(found)).between(9, 15)
    return F.lit(True)


def _base_spans(text: Column, kind: str) -> Column:
    empty = F.array().cast("array<struct<start:int,end:int,found:string>>")
    needed = _NEEDS[kind]
    possible = text.contains(needed) if needed else text.rlike("[0-9]")
    return F.when(possible & text.rlike(_BASE[kind]), F.filter(_located(text, _BASE[kind]), lambda s: _passes(kind, s["found"]))).otherwise(
        empty
    )


def _count(text: Column, pattern: str) -> Column:
    """Characters of a short text that a character class matches."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _features(found: Column, context: Column) -> dict[str, Column]:
    values = {
        "length": F.length(found),
        "digits": _count(found, "[0-9]"),
        "letters": _count(found, "[A-Za-z]"),
        "uppers": _count(found, "[A-Z]"),
        "separators": _count(found, r"[ .\-_]"),
        "groups": F.size(F.regexp_extract_all(found, F.lit("[0-9]+"), F.lit(0))),
        "brackets": _count(found, r"[()\[\]]"),
        # changes between letters and digits, frequent in random tokens
        "switches": F.size(F.regexp_extract_all(found, F.lit("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]"), F.lit(0))),
    }
    values |= {name: context.rlike(pattern).cast("int") for name, pattern in _CONTEXT.items()}
    return {name: values[name].cast("double") for name in FEATURES}


def labelled_table(spark: SparkSession) -> DataFrame:
    """(kind, found, context, label, held_out): look-alikes and real formats, by a rule.

    Every row draws its digits and letters from hashes of its number, so the table is
    the same everywhere. A candidate is personal where its format is the usual one, and doubtful formats only with
    a fitting word before them.
    """

    def number(salt: int, most: int) -> Column:
        return F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(most)).cast("int")

    def digits(salt: int, count: int) -> Column:
        return F.lpad(number(salt, 10**count).cast("string"), count, "0")

    word = F.element_at(F.split(F.lit("ann bob info sales maria theo shop news"), " "), number(1, 8) + 1)
    site = F.element_at(F.split(F.lit("mail example corp web home"), " "), number(2, 5) + 1)
    hexes = F.substring(F.sha2(F.col("id").cast("string"), 256), F.lit(1), number(3, 24) + 20)
    blocks = [F.unhex(F.sha2(F.concat_ws("/", F.col("id").cast("string"), F.lit(str(k))), 512)) for k in range(12)]
    random = F.translate(F.base64(F.concat(*blocks)), "+/=\r\n", "-_")  # 1,024 characters
    long = F.substring(random, F.lit(1), number(3, 800) + 201)
    part = F.substring(random, F.lit(1), number(3, 960) + 40)
    previous = F.concat(F.substring(F.reverse(random), F.lit(1), F.lit(CONTEXT_CHARS - 1)), F.lit("."))
    words = F.repeat(F.concat(word, site), number(3, 100) + 40)
    prose = F.element_at(F.split(F.lit("and the|of this|in a|was from|see page|since|version|about"), r"\|"), number(4, 8) + 1)
    phone_word = F.element_at(F.split(F.lit("call |phone: |Tel. |fax |mobile "), r"\|"), number(5, 5) + 1)
    mail_word = F.element_at(F.split(F.lit("mail |contact: |write to |reach me "), r"\|"), number(5, 4) + 1)
    secret_word = F.element_at(F.split(F.lit("token = \"|api_key: |secret=|password = '|bearer "), r"\|"), number(5, 5) + 1)
    plain = F.concat(prose, F.lit(" "))
    labels = F.concat(site, F.repeat(F.concat(F.lit(" dot "), F.substring(word, F.lit(1), number(6, 4) + 1)), number(3, 8) + 1))
    letters = F.substring(F.translate(F.lower(random), "0123456789-_", ""), F.lit(1), number(3, 100) + 20)
    run = F.concat(F.lit("0"), digits(6, 9))
    area = F.concat(F.lit("0"), digits(6, 3), F.lit(" "), digits(7, 6))
    hyphened = F.concat(F.lit("0"), digits(6, 2), F.lit("-"), digits(7, 7))
    pairs = F.concat_ws(" ", *[digits(salt, 2) for salt in range(6, 12)])
    many_pairs = F.concat(pairs, F.repeat(F.concat(F.lit(" "), digits(12, 2)), number(3, 60) + 3))
    numbers = F.concat(digits(6, 2), F.repeat(F.concat(F.lit(" "), digits(7, 2), F.lit(" "), digits(8, 3)), number(3, 30) + 4))
    rows = [
        ("phone_national", F.concat(F.lit("("), digits(6, 3), F.lit(") "), digits(7, 3), F.lit("-"), digits(8, 4)), plain, 1),
        ("phone_national", F.concat(digits(6, 3), F.lit("-"), digits(7, 3), F.lit("-"), digits(8, 4)), plain, 1),
        ("phone_national", F.concat(digits(6, 4), F.lit(" "), digits(7, 4), digits(8, 1)), phone_word, 1),
        ("phone_national", F.concat(digits(6, 3), F.lit(" "), digits(7, 2), F.lit(" "), digits(8, 2), F.lit(" "), digits(9, 2)), phone_word, 1),
        ("phone_national", F.concat(F.lit("19"), digits(6, 2), F.lit("-"), digits(7, 2), F.lit("-"), digits(8, 2)), plain, 0),
        ("phone_national", F.concat(digits(6, 2), F.lit("."), digits(7, 2), F.lit("."), digits(8, 4)), plain, 0),
        ("phone_national", F.concat(F.lit("20"), digits(6, 2), F.lit("-20"), digits(7, 2)), plain, 0),
        ("phone_national", F.concat(digits(6, 3), F.lit(" "), digits(7, 3)), plain, 0),
        ("phone_national", F.concat(digits(6, 4), F.lit(" "), digits(7, 4), digits(8, 1)), plain, 0),
        ("phone_national", F.concat(digits(6, 3), F.lit(" "), digits(7, 2), F.lit(" "), digits(8, 2), F.lit(" "), digits(9, 2)), plain, 0),
        # written without groups, in uneven groups, in many pairs
        ("phone_national", run, phone_word, 1),
        ("phone_national", area, phone_word, 1),
        ("phone_national", hyphened, phone_word, 1),
        ("phone_national", pairs, phone_word, 1),
        ("phone_national", run, plain, 0),
        ("phone_national", area, plain, 0),
        ("phone_national", hyphened, plain, 0),
        ("phone_national", pairs, plain, 0),
        # lists of numbers, whatever word precedes them
        ("phone_national", numbers, plain, 0),
        ("phone_national", numbers, phone_word, 0),
        ("phone_national", many_pairs, plain, 0),
        ("phone_national", many_pairs, phone_word, 0),
        ("email_spelled", F.concat(word, F.lit(" (at) "), site, F.lit(" (dot) com")), plain, 1),
        ("email_spelled", F.concat(word, F.lit("[at]"), site, F.lit("[dot]org")), plain, 1),
        ("email_spelled", F.concat(word, F.lit(" at "), site, F.lit(" dot com")), mail_word, 1),
        ("email_spelled", F.concat(word, F.lit(" at "), site, F.lit(" dot "), word), plain, 0),
        ("email_spelled", F.concat(word, F.lit("at"), site, F.lit("dot"), word), plain, 0),
        # long local parts, hosts of many labels
        ("email_spelled", F.concat(F.repeat(word, number(3, 20) + 4), F.lit(" at "), site, F.lit(" dot com")), mail_word, 1),
        ("email_spelled", F.concat(word, F.lit(" at "), labels, F.lit(" dot com")), mail_word, 1),
        ("email_spelled", F.concat(word, F.lit(" at "), labels, F.lit(" dot "), word), plain, 0),
        ("secret", hexes, secret_word, 1),
        ("secret", F.concat(F.lit("sk-"), F.base64(F.unhex(F.sha1(F.col("id").cast("string").cast("binary"))))), secret_word, 1),
        ("secret", F.concat(F.repeat(word, 3), F.repeat(site, 3)), plain, 0),
        ("secret", F.concat(F.repeat(word, 3), F.repeat(site, 3)), secret_word, 0),
        ("secret", F.concat(F.lit("section-"), number(6, 99).cast("string"), F.lit("-"), F.repeat(word, 4)), plain, 0),
        ("secret", F.lpad(digits(6, 9), 24, "1234567890"), plain, 0),
        # runs of letters that are no words
        ("secret", letters, plain, 0),
        ("secret", letters, mail_word, 0),
        # longer than any single line of hex digits or words
        ("secret", long, secret_word, 1),
        ("secret", F.substring(F.lower(F.hex(F.concat(*blocks))), F.lit(1), number(3, 800) + 201), secret_word, 1),
        ("secret", part, previous, 1),
        ("secret", long, plain, 0),
        ("secret", words, plain, 0),
        ("secret", words, secret_word, 0),
        ("secret", F.concat(F.lit("section-"), number(6, 99).cast("string"), F.lit("-"), words), plain, 0),
        ("secret", F.lpad(digits(6, 9), number(3, 800) + 201, "1234567890"), plain, 0),
        ("secret", F.repeat(F.element_at(F.split(F.lit("- _ -_ _-"), " "), number(6, 4) + 1), number(3, 300) + 201), plain, 0),
    ]
    spans = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), found.alias("found"), context.alias("context"), F.lit(label).alias("label"))
            for kind, found, context, label in rows
        ]
    )
    each = spark.range(LABELLED_ROWS).withColumn("one", F.get(spans, F.pmod("id", F.lit(len(rows))).cast("int")))
    return each.select("one.*", (F.pmod(F.floor(F.col("id") / len(rows)), F.lit(2)) == 1).alias("held_out"))


def _as_sql(tree: str, names: list[str]) -> str:
    """One printed regression tree as a nested CASE."""
    lines = iter([line.strip() for line in tree.splitlines() if re.match(r"\s*(If|Else|Predict)", line)])

    def node() -> str:
        line = next(lines)
        if found := re.match(r"Predict: (\S+)", line):
            return f"cast({found[1]} AS double)"
        feature, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = node()
        next(lines)
        return f"CASE WHEN {names[int(feature)]} <= {limit} THEN {low} ELSE {node()} END"

    return node()


class Model:
    """Boosted trees as a SQL expression over features, and a threshold per kind."""

    def __init__(self, spark: SparkSession):
        from pyspark.ml.classification import GBTClassifier
        from pyspark.ml.feature import VectorAssembler

        rows = labelled_table(spark)
        values = _features(F.col("found"), F.col("context"))
        names = [*FEATURES, *[f"is_{kind}" for kind in ADDED_KINDS]]
        kinds = [(F.col("kind") == kind).cast("double").alias(f"is_{kind}") for kind in ADDED_KINDS]
        table = rows.select("kind", "label", "held_out", *[v.alias(n) for n, v in values.items()], *kinds).coalesce(1)
        train = VectorAssembler(inputCols=names, outputCol="features").transform(table.filter("NOT held_out"))
        fitted = GBTClassifier(labelCol="label", maxIter=TREES, maxDepth=TREE_DEPTH, seed=1, stepSize=0.5).fit(train)
        parts = [
            f"{weight!r} * ({_as_sql(tree.toDebugString, names)})" for weight, tree in zip(fitted.treeWeights, fitted.trees)
        ]
        self.margin = " + ".join(parts)
        scored = table.filter("held_out").withColumn("score", F.round(F.expr(self.margin), 6))
        # the highest-scored share of each kind that is precise enough; one row per kind
        self.thresholds = {kind: float("inf") for kind in ADDED_KINDS}
        at = scored.groupBy("kind", "score").agg(F.sum("label").alias("good"), F.count("*").alias("n"))
        found: dict[str, list] = {}
        for row in at.collect():  # at most one row per leaf combination of the small table
            found.setdefault(row["kind"], []).append((row["score"], row["good"], row["n"]))
        for kind, steps in found.items():
            good = total = 0
            for score, hits, count in sorted(steps, reverse=True):
                good, total = good + hits, total + count
                if good >= WANTED_PRECISION * total:
                    self.thresholds[kind] = score


_trained: dict[str, Model] = {}


def model(spark: SparkSession) -> Model:
    """The model, trained once per application from the fixed labelled table."""
    application = spark.sparkContext.applicationId
    if application not in _trained:
        _trained[application] = Model(spark)
    return _trained[application]


def with_spans(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str, str]:
    """Append base spans (a struct of arrays by kind) and added spans (kind, start, end)."""
    trained = model(docs.sparkSession)
    source, base, every = (free_name(docs, name) for name in ("pii_text", "pii_base", "pii_added"))
    staged = docs.withColumn(source, plain_text(F.col(f"`{text}`")))

    def of_kind(kind: str) -> Column:
        spans = _base_spans(F.col(source), kind)
        return F.transform(
            spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
        )

    staged = staged.withColumn(base, F.struct(*[of_kind(kind).alias(kind) for kind in BASE_KINDS]))
    taken = F.concat(*[F.col(f"{base}.{kind}") for kind in BASE_KINDS])
    raw = free_name(staged, "pii_candidates")
    none = F.array().cast("array<struct<kind:string,start:int,end:int,found:string>>")

    def proposed(kind: str) -> Column:
        spans = F.transform(
            _located(F.col(source), _GENERATORS[kind]),
            lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found")),
        )
        return F.when(F.col(source).rlike(_GENERATORS[kind]), spans).otherwise(none)

    staged = staged.withColumn(raw, F.concat(*[proposed(kind) for kind in ADDED_KINDS]))

    def score(one: Column) -> Column:
        begin = F.greatest(one["start"] - CONTEXT_CHARS, F.lit(0))
        context = F.substring(F.col(source), begin + 1, one["start"] - begin)
        values = _features(one["found"], context)
        values |= {f"is_{kind}": (one["kind"] == kind).cast("double") for kind in ADDED_KINDS}
        return F.struct(one["kind"].alias("kind"), one["start"].alias("start"), one["end"].alias("end"), *[v.alias(n) for n, v in values.items()])

    valued = free_name(staged, "pii_features")
    staged = staged.withColumn(valued, F.transform(raw, score))
    limit = " ".join(f"WHEN one.kind = '{kind}' THEN double('{value}')" for kind, value in trained.thresholds.items())
    margin = re.sub(r"\b(" + "|".join([*FEATURES, *[f"is_{k}" for k in ADDED_KINDS]]) + r")\b", r"one.\1", trained.margin)
    chosen = F.expr(f"filter({valued}, one -> round({margin}, 6) >= CASE {limit} END)")
    free = F.filter(chosen, lambda one: ~F.exists(taken, lambda b: (b["start"] < one["end"]) & (one["start"] < b["end"])))
    plain = F.transform(free, lambda one: F.struct(one["kind"].alias("kind"), one["start"].alias("start"), one["end"].alias("end")))
    return staged.withColumn(every, plain).drop(source, raw, valued), base, every


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_digest(docs: DataFrame) -> DataFrame:
    """Per document: base spans counted and hashed, and all spans as text."""
    found, base, added = with_spans(docs.select("doc_id", "text"))
    by_kind = F.concat(*[F.col(f"{base}.{kind}") for kind in BASE_KINDS])
    return found.select(
        "doc_id",
        *[F.size(F.col(f"{base}.{kind}")).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(_written(by_kind), 256).alias("base_sha256"),
        _written(F.concat(by_kind, F.col(added))).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets, like ``[EMAIL]``."""
    found, base, added = with_spans(docs, text)
    spans, merged = free_name(found, "pii_spans"), free_name(found, "pii_merged")
    by_place = F.transform(
        F.concat(*[F.col(f"{base}.{kind}") for kind in BASE_KINDS], F.col(added)),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    found = found.withColumn(spans, F.array_sort(by_place))

    def join(state: Column, one: Column) -> Column:
        last = F.try_element_at(state, F.lit(-1))
        widened = F.struct(last["start"].alias("start"), F.greatest(last["end"], one["end"]).alias("end"), last["kind"].alias("kind"))
        overlaps = F.coalesce(last["end"] > one["start"], F.lit(False))
        return F.when(overlaps, F.concat(F.slice(state, 1, F.size(state) - 1), F.array(widened))).otherwise(F.concat(state, F.array(one)))

    found = found.withColumn(merged, F.aggregate(spans, F.slice(F.col(spans), 1, 0), join))
    value = F.col(f"`{text}`")
    before = F.transform(
        merged,
        lambda s, i: F.concat(
            F.substring(value, F.coalesce(F.get(F.col(merged), i - 1)["end"], F.lit(0)) + 1, s["start"] - F.coalesce(F.get(F.col(merged), i - 1)["end"], F.lit(0))),
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")),
        ),
    )
    rest = F.expr(f"substring(`{text}`, try_element_at({merged}, -1).end + 1)")
    cleaned = F.when(F.size(merged) > 0, F.concat(F.array_join(before, ""), rest)).otherwise(value)
    return found.withColumn(text, cleaned).drop(base, added, spans, merged)
