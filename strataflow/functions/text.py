"""Text expressions: tokens, sentences, lexicon scores, classification, extraction, redaction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .compat import col

# Word lists, categories and patterns of the text operators.
POSITIVE = (
    "appreciate", "best", "better", "easy", "excellent", "fast", "friendly", "glad", "good", "great", "happy",
    "helpful", "love", "perfect", "pleased", "quick", "reliable", "resolved", "satisfied", "smooth", "success",
    "thank", "thanks", "wonderful",
)
NEGATIVE = (
    "angry", "awful", "bad", "broken", "clown", "complaint", "crashing", "declined", "delay", "delayed", "disgusting",
    "embarrassing", "error", "failed", "fraud", "frustrated", "idiot", "incorrect", "invalid", "loser", "lost", "moron",
    "pathetic", "poor", "problem", "scum", "stolen", "stupid", "terrible", "trash", "unable", "unacceptable",
    "unauthorized", "unhappy", "urgent", "worst", "worthless", "wrong",
)
TICKET_TOPICS = {
    "Billing & Payments": ("billing", "charge", "charged", "payment", "refund", "statement", "fee"),
    "Fraud & Unauthorized Activity": ("fraud", "unauthorized", "stolen", "suspicious", "authorize"),
    "Account Access & Login": ("login", "password", "access", "locked", "credentials", "pin"),
    "Technical Issue": ("app", "crashing", "error", "loading", "website"),
    "Card Services": ("card", "debit", "credit", "declined", "replacement"),
    "Loan & Mortgage": ("loan", "mortgage", "interest", "rate"),
}
DEFAULT_TOPIC = "General Inquiry"
PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "PHONE_NUMBER": r"\+?[0-9]{1,3}[ .-]\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
    "IP_ADDRESS": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "CARD_NUMBER": r"[0-9]{16}",
    "DATE": r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "AMOUNT": r"\$[0-9][0-9,]*(?:\.[0-9]{2})?",
}
NAMES = ("James Smith", "Maria Garcia", "Wei Chen")
# Fixed order: longer numbers before the shorter ones they may contain.
REDACTION_ORDER = ("EMAIL", "CARD_NUMBER", "PHONE_NUMBER", "IP_ADDRESS", "DATE", "NAME")


def tokens(c: str | Column) -> Column:
    """Lower-case runs of letters of any script, in order."""
    parts = F.split(F.lower(col(c)), r"[^\p{L}]+")
    return F.filter(parts, lambda w: w != "")


def sentences(c: str | Column) -> Column:
    """Trimmed texts between sentence ends or line breaks."""
    parts = F.transform(F.split(col(c), r"[.!?\n]+"), lambda s: F.trim(s))
    return F.filter(parts, lambda s: s != "")


def count_words(words: Column, lexicon: Sequence[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(*lexicon)))


def has_any(words: Column, terms: Sequence[str]) -> Column:
    """Whether any term of a rule occurs."""
    return F.arrays_overlap(words, F.array(*[F.lit(w) for w in terms]))


def sentiment(words: Column, positive: Sequence[str] = POSITIVE, negative: Sequence[str] = NEGATIVE) -> Column:
    """(positive - negative) / all hits, in [-1, 1]; 0 without a hit."""
    p, n = count_words(words, positive), count_words(words, negative)
    return F.when(p + n > 0, (p - n).cast("double") / (p + n)).otherwise(F.lit(0.0))


def classify(words: Column, topics: Mapping[str, Sequence[str]], default: str = DEFAULT_TOPIC) -> Column:
    """struct(label, confidence): the topic with most keyword hits and its share of all hits.

    Equal counts go to the topic listed first.
    """
    scored = F.array(
        *[
            F.struct(count_words(words, terms).alias("hits"), F.lit(-i).alias("rank"), F.lit(label).alias("label"))
            for i, (label, terms) in enumerate(topics.items())
        ]
    )
    total = F.aggregate(scored, F.lit(0), lambda acc, s: acc + s["hits"])
    best = F.array_max(scored)
    return F.when(
        total > 0, F.struct(best["label"].alias("label"), (best["hits"].cast("double") / total).alias("confidence"))
    ).otherwise(F.struct(F.lit(default).alias("label"), F.lit(0.0).alias("confidence")))


def extract_fields(c: str | Column, fields: Sequence[str]) -> Column:
    """struct of all matches per named pattern."""
    return F.struct(
        *[F.regexp_extract_all(col(c), F.lit(PATTERNS[f]), F.lit(0)).alias(f.lower()) for f in fields]
    )


def luhn_valid(digits: Column) -> Column:
    """Check digit test of a 16-digit card number."""

    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = d * 2
        return F.when(i % 2 == 1, F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.lit(16)), F.lit(0), lambda acc, i: acc + value(i))
    return total % 10 == 0


def redact(c: str | Column, categories: Sequence[str] | None = None, names: Sequence[str] = NAMES) -> Column:
    """Replace matches of each category by its name in brackets; cards only with a valid check digit."""
    out = col(c)
    for kind in REDACTION_ORDER:
        if categories is not None and kind not in categories:
            continue
        mark = F.lit(f"[{kind}]")
        if kind == "CARD_NUMBER":
            found = F.regexp_extract_all(out, F.lit(PATTERNS[kind]), F.lit(0))
            cards = F.array_distinct(F.filter(found, luhn_valid))
            out = F.aggregate(cards, out, lambda acc, card: F.replace(acc, card, mark))
        elif kind == "NAME":
            for name in names:
                out = F.replace(out, F.lit(name), mark)
        else:
            out = F.regexp_replace(out, F.lit(PATTERNS[kind]), mark)
    return out
