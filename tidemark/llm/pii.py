"""Personal data by weak supervision, on built-in functions only.

Base spans (email, ip, card, phone) are found by fixed patterns. Wider patterns give
candidates on which labelers vote: the strict pattern (regex), a gazetteer of mail
hosts and prefixes, and the words before the span (context). Expectation-maximisation
over the counted vote vectors estimates how reliable each labeler is; its posteriors
train a final span classifier whose accepted candidates are added to the base spans.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from uuid import uuid4

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import read, stored

KINDS = ("email", "ip", "card", "phone")

# Fixed patterns. The possessive forms match the same texts as the plain ones without
# keeping backtracking states; the look-behind or \G starts a match at the start of a
# run or right behind the last match, the only places where one can start.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Candidates beyond the base patterns, by the kind they would be.
OBFUSCATED = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
    r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++"
)
LOCAL_PHONE = r"(?<![0-9+.)(-])(?<!\+[0-9]\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])"
CANDIDATES = {"email": OBFUSCATED, "phone": LOCAL_PHONE}

# Cheap necessary conditions that spare most texts the slower patterns.
NEEDS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": "\\+[0-9]"}
CANDIDATE_NEEDS = {"email": "(?:\\(at\\)|\\[at\\])", "phone": "[0-9]{3}[\\x20.-][0-9]{4}"}

# Gazetteer and context words: fixed lists of this labeler.
MAIL_ENDINGS = ("com", "org", "net", "edu", "gov", "io", "info")
CONTEXT_WORDS = {
    "email": ("mail", "email", "e-mail", "contact", "write", "reach", "correo", "kontakt"),
    "phone": ("call", "phone", "tel", "telephone", "mobile", "cell", "fax", "telefon", "llame"),
}
CONTEXT_CHARS = 24

# Matches that are laid out one after another; see _parts.
PART = 512
_MATCH = StructType([StructField("start", LongType()), StructField("text", StringType())])
_SPANS = ArrayType(_MATCH)
_GAPS = ArrayType(StructType([StructField("gap", LongType()), StructField("text", StringType())]))

LABELERS = ("by_regex", "by_gazetteer", "by_context")
EM_ROUNDS = 50
PRIOR_STRENGTH = 2.0  # pseudo-votes that keep an unseen labeler's rates inside (0, 1)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _parts(found: Column) -> Column:
    """Runs of ``PART`` elements of an array. A list built up element by element is copied
    at every step, so long ones are built in parts, and from the parts."""
    last = F.floor((F.size(found) - 1) / PART).cast("int")
    runs = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(found, k * PART + 1, PART))
    return F.when(F.size(found) > 0, runs).otherwise(F.array().cast(ArrayType(_GAPS)))


def matches(text: Column, pattern: str, needs: str) -> Column:
    """(start, text) of all matches, leftmost and non-overlapping, in code points.

    The text between matches, from splitting by the same pattern, gives the starts.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    empty = F.array().cast(_SPANS)
    pairs = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(found)), found,
        lambda gap, match: F.struct(
            F.char_length(gap).cast("long").alias("gap"), match.alias("text")
        ),
    )

    def state(at: Column, spans: Column) -> Column:
        return F.struct(at.alias("at"), spans.alias("spans"))

    def one(so_far: Column, pair: Column) -> Column:
        start = so_far["at"] + pair["gap"]
        span = F.struct(start.alias("start"), pair["text"].alias("text"))
        return state(start + F.char_length(pair["text"]), F.concat(so_far["spans"], F.array(span)))

    def part(so_far: Column, run: Column) -> Column:
        laid = F.aggregate(run, state(so_far["at"], empty), one)
        return _let(laid, lambda d: state(d["at"], F.concat(so_far["spans"], F.array(d["spans"]))))

    start = state(F.lit(0).cast("long"), F.array().cast(ArrayType(_SPANS)))
    laid = _let(pairs, lambda p: F.flatten(F.aggregate(_parts(p), start, part)["spans"]))
    return F.when(F.regexp_like(text, F.lit(needs)), laid).otherwise(empty)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits, doubled at every second place from the right, sum to tens."""
    backwards = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.char_length(digits)),
        F.lit(0),
        lambda total, i: total
        + F.when(i % 2 == 1, F.substring(backwards, i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*(F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))),
                         F.substring(backwards, i, F.lit(1)).cast("int") + 1)
        ),
    )
    return total % 10 == 0


def is_valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        small = "0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])?"
        return F.regexp_like(text, F.lit(rf"^{small}\.{small}\.{small}\.{small}$"))
    if kind == "card":
        digits = _digits(text)
        return F.char_length(digits).between(14, 19) & F.when(
            F.char_length(digits).between(14, 19), _luhn(digits)
        ).otherwise(False)
    if kind == "phone":
        return F.char_length(_digits(text)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Valid base spans: (start, rank, kind, stop), ordered by start, then kind."""
    found = []
    for rank, (kind, pattern) in enumerate(zip(KINDS, (EMAIL, IP, CARD, PHONE))):
        found.append(_valid_spans(matches(text, pattern, NEEDS[kind]), kind, rank))
    return F.array_sort(F.concat(*found))


def _valid_spans(found: Column, kind: str, rank: int) -> Column:
    valid = F.filter(found, lambda m: is_valid(kind, m["text"]))
    return F.transform(valid, lambda m: _span(m, kind, rank))


def _span(match: Column, kind: str, rank: int) -> Column:
    return F.struct(
        match["start"].alias("start"),
        F.lit(rank).alias("rank"),
        F.lit(kind).alias("kind"),
        (match["start"] + F.char_length(match["text"])).alias("stop"),
    )


def candidate_spans(text: Column) -> Column:
    """Candidates with their votes: 1 for, 0 against, NULL for no opinion."""
    found = []
    for kind, pattern in CANDIDATES.items():
        rank = KINDS.index(kind)
        found.append(_voted_spans(text, matches(text, pattern, CANDIDATE_NEEDS[kind]), kind, rank))
    return F.concat(*found)


def _voted_spans(text: Column, found: Column, kind: str, rank: int) -> Column:
    return F.transform(found, lambda m: _voted(text, m, kind, rank))


def _voted(text: Column, match: Column, kind: str, rank: int) -> Column:
    span, found = _span(match, kind, rank), match["text"]
    before = F.lower(F.substring(
        text,
        F.greatest(match["start"] - CONTEXT_CHARS + 1, F.lit(1)).cast("int"),
        F.least(match["start"], F.lit(CONTEXT_CHARS)).cast("int"),
    ))
    words = "|".join(CONTEXT_WORDS[kind])
    by_context = F.when(F.regexp_like(before, F.lit(rf"\b(?:{words})\b")), 1)
    if kind == "email":
        ending = F.lower(F.regexp_extract(found, "([A-Za-z0-9-]+)$", 1))
        by_regex = F.regexp_like(found, F.lit(r"(?:\(at\)|\[at\]).*(?:\.|\(dot\)|\[dot\])")).cast("int")
        by_gazetteer = ending.isin(*MAIL_ENDINGS).cast("int")
    else:
        # A number of the same shape has one separator throughout, or a bracketed prefix.
        alike = r"^(?:\([0-9]{3}\)\x20[0-9]{3}-[0-9]{4}|[0-9]{3}([.-])[0-9]{3}\1[0-9]{4})$"
        by_regex = F.regexp_like(found, F.lit(alike)).cast("int")
        # National prefixes and exchanges start with 2 to 9.
        by_gazetteer = F.regexp_like(found, F.lit(r"^\(?[2-9][0-9]{2}\)?[\x20.-][2-9]")).cast("int")
    return F.struct(
        *(span[name].alias(name) for name in ("start", "rank", "kind", "stop")),
        by_regex.alias("by_regex"),
        by_gazetteer.alias("by_gazetteer"),
        by_context.alias("by_context"),
        F.regexp_like(found, F.lit(r"\(")).cast("int").alias("bracketed"),
    )


def estimate(patterns: list[tuple]) -> tuple[list[float], np.ndarray]:
    """Prior and per-labeler rates by expectation-maximisation, then posteriors.

    ``patterns`` has (votes..., rows). A labeler has a rate of voting "for" on real
    spans and one on others; both start from the belief that labelers are mostly right.
    """
    votes = np.array([[np.nan if v is None else v for v in p[:-1]] for p in patterns], float)
    rows = np.array([p[-1] for p in patterns], float)
    real = np.full(votes.shape[1], 0.8)
    other = np.full(votes.shape[1], 0.2)
    prior, given = 0.5, ~np.isnan(votes)
    posterior = np.full(len(rows), 0.5)
    for _ in range(EM_ROUNDS):
        odds = np.full(len(rows), math.log(prior / (1 - prior)))
        odds += np.where(given & (votes == 1), np.log(real / other), 0).sum(1)
        odds += np.where(given & (votes == 0), np.log((1 - real) / (1 - other)), 0).sum(1)
        posterior = 1 / (1 + np.exp(-odds))
        for rate, weight, mean in ((real, posterior, 0.8), (other, 1 - posterior, 0.2)):
            w = (weight * rows)[:, None] * given
            rate[:] = ((w * (votes == 1)).sum(0) + PRIOR_STRENGTH * mean) / (
                w.sum(0) + PRIOR_STRENGTH
            )
        prior = ((posterior * rows).sum() + PRIOR_STRENGTH / 2) / (rows.sum() + PRIOR_STRENGTH)
    return [prior, *real, *other], posterior


def train(features: np.ndarray, target: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Logistic regression on soft targets, by Newton's method with a ridge."""
    design = np.column_stack([features, np.ones(len(features))])
    beta = np.zeros(design.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (rows * (target - p)) - 0.1 * beta
        curve = (design * (rows * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(len(beta))
        beta += np.clip(np.linalg.solve(curve, slope), -3, 3)
    return beta


FEATURES = ("is_phone", "bracketed", "regex_for", "gazetteer_for", "context_for")


def _features(span: Column) -> list[Column]:
    return [
        (span["kind"] == "phone").cast("int"),
        span["bracketed"],
        F.coalesce(span["by_regex"], F.lit(0)),
        F.coalesce(span["by_gazetteer"], F.lit(0)),
        F.coalesce(span["by_context"], F.lit(0)),
    ]


def classifier(spans: DataFrame) -> list[float]:
    """Weights of the final classifier, from the vote vectors of all candidates.

    The vectors are counted by Spark; their number is bounded by the votes and features.
    """
    flat = spans.select(F.explode("candidates").alias("span"))
    names = [f"f{i}" for i in range(len(FEATURES))]
    counted = (
        flat.select(
            *(F.col("span")[v].alias(v) for v in LABELERS),
            *(c.alias(n) for c, n in zip(_features(F.col("span")), names)),
        )
        .groupBy(*LABELERS, *names)
        .count()
        .orderBy(*LABELERS, *names)
        .collect()
    )
    if not counted:
        return [0.0] * len(FEATURES) + [-1.0]
    _, posterior = estimate([(*(r[v] for v in LABELERS), r["count"]) for r in counted])
    features = np.array([[r[n] for n in names] for r in counted], float)
    rows = np.array([r["count"] for r in counted], float)
    return [float(b) for b in train(features, posterior, rows)]


def accepted(base: Column, candidates: Column, weights: list[float]) -> Column:
    """Candidates that the classifier takes for personal data, clear of base spans."""

    def is_accepted(span: Column) -> Column:
        total = reduce(
            Column.__add__, (w * f for w, f in zip(weights, _features(span))), F.lit(weights[-1])
        )
        clear = ~F.exists(
            base, lambda b: (b["start"] < span["stop"]) & (span["start"] < b["stop"])
        )
        return (total > 0) & clear

    return F.transform(
        F.filter(candidates, is_accepted),
        lambda s: F.struct(*(s[n].alias(n) for n in ("start", "rank", "kind", "stop"))),
    )


_BASE, _CANDIDATES = "_pii_base", "_pii_candidates"


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id, ``base`` and ``spans``: arrays of (start, rank, kind, stop), by start and kind.

    Positions are code points, the stop is exclusive. A NULL or empty text has no spans;
    repeated rows are searched each; an empty table gives no rows; columns other than
    doc_id and text are ignored. Without candidates nothing is added to the base spans.
    Texts of any length are searched whole, in a time that grows with their matches.
    """
    found = stored(with_spans(docs.select("doc_id", "text")).drop("text"), "pii-spans")
    weights = classifier(found.select(F.col(_CANDIDATES).alias("candidates")))
    return found.select("doc_id", F.col(_BASE).alias("base"), all_spans(weights).alias("spans"))


def with_spans(docs: DataFrame, made: str = "") -> DataFrame:
    """``docs`` with columns of base spans and of candidates, ``made`` ending their names."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "*", base_spans(text).alias(_BASE + made), candidate_spans(text).alias(_CANDIDATES + made)
    )


def all_spans(weights: list[float], made: str = "") -> Column:
    base, candidates = F.col(_BASE + made), F.col(_CANDIDATES + made)
    return F.array_sort(F.concat(base, accepted(base, candidates, weights)))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; overlaps go as one."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text"))

    def piece(begin: Column, end: Column) -> Column:
        return F.substring(text, (begin + 1).cast("int"), (end - begin).cast("int"))

    return F.aggregate(
        spans,
        start,
        lambda state, span: F.struct(
            F.greatest(state["at"], span["stop"]).alias("at"),
            F.when(
                span["start"] >= state["at"],
                F.concat(
                    state["text"], piece(state["at"], span["start"]),
                    F.lit("["), F.upper(span["kind"]), F.lit("]"),
                ),
            ).otherwise(state["text"]).alias("text"),
        ),
        lambda state: F.concat(state["text"], piece(state["at"], F.char_length(text).cast("long"))),
    )


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans of ``text`` replaced by their kinds, and ``n_chars``, if
    there, counting the new text. A NULL text stays NULL; other columns are untouched.

    The classifier is trained on the candidates of all documents, which are stored
    first; the spans themselves are found again on the way to the new texts.
    """
    candidates = docs.select(candidate_spans(F.coalesce("text", F.lit(""))).alias("candidates"))
    weights = classifier(stored(candidates.filter(F.size("candidates") > 0), "pii-candidates"))
    made = uuid4().hex  # so that no column of the documents has the same name
    spans = f"_pii_spans{made}"
    found = with_spans(docs, made).withColumn(spans, all_spans(weights, made))
    text = F.when(F.col("text").isNotNull(), redacted(F.col("text"), F.col(spans)))
    done = found.withColumn("text", text).select(*docs.columns)
    if "n_chars" in docs.columns:
        counted = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        done = done.withColumn("n_chars", counted)
    return done


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
        ),
        ",",
    )


def op4_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(read(spark, sf_dir, "documents"))
    counts = [
        F.size(_of_kind(F.col("base"), kind)).cast("long").alias(f"n_{kind}") for kind in KINDS
    ]
    return found.select(
        "doc_id", *counts,
        F.sha2(F.encode(_listed(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
