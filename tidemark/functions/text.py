"""Text expressions over question and SQL logs. All are plain Catalyst columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, word lists of the assistant logs.
FORBIDDEN_VERBS = [
    "DROP", "DELETE", "UPDATE", "INSERT", "ALTER", "CREATE", "TRUNCATE", "EXEC", "EXECUTE",
]
COST_TABLES = ["aws_costs", "azure_costs", "gcp_costs"]
CATEGORY_WORDS = {
    "schema": ["table", "column", "field"],
    "sql_patterns": ["how to", "query", "calculate"],
    "business_rules": ["should", "policy", "rule"],
    "glossary": ["what is", "define", "meaning"],
}
FOLLOW_UP_WORDS = ["that", "it", "same", "also", "too", "what about", "how about", "and"]
MULTI_STEP_PHRASES = [
    "and then", "followed by", "compared to", "versus", "top and bottom", "trend",
]
SCREENED_TOKENS = ["DROP", "DELETE", "UPDATE", "--", ";"]
NOT_SELECT = "Only SELECT queries are allowed"
CHAINED = "Multiple statements not allowed"
FORBIDDEN = "Forbidden keyword: "
NO_TABLE = "Query must reference one of: "
QUESTION_CLASSES = {
    "cost": ["cost", "spend", "bill", "budget"],
    "resource": ["resource", "instance", "volume", "service"],
}


def has_word(text: Column, words: Sequence[str]) -> Column:
    """True when any of the words occurs as a whole word, in any case."""
    return text.rlike(r"(?i)\b(" + "|".join(words) + r")\b")


def contains_any(text: Column, phrases: Sequence[str]) -> Column:
    """True when any phrase occurs anywhere, in any case."""
    lowered = F.lower(text)
    out = F.lit(False)
    for p in phrases:
        out = out | lowered.contains(p.lower())
    return out


def categories(text: Column, words: Mapping[str, Sequence[str]] = CATEGORY_WORDS) -> Column:
    """Categories whose keywords occur; every category when none does."""
    found = F.array_compact(
        F.array(*[F.when(contains_any(text, ws), F.lit(c)) for c, ws in words.items()])
    )
    every = F.array(*[F.lit(c) for c in words])
    return F.when(F.size(found) > 0, found).otherwise(every)


def question_class(text: Column) -> Column:
    out = None
    for name, words in QUESTION_CLASSES.items():
        hit = contains_any(text, words)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("other")


def sql_errors(
    sql: Column,
    verbs: Sequence[str] = FORBIDDEN_VERBS,
    tables: Sequence[str] = COST_TABLES,
) -> Column:
    """The rules a SQL text breaks, as an array; empty when it is acceptable."""
    checks = [
        F.when(has_word(sql, [v]), F.lit(FORBIDDEN + v)) for v in verbs
    ]
    checks += [
        F.when(~sql.rlike(r"(?i)^\s*select\b"), F.lit(NOT_SELECT)),
        F.when(sql.rlike(r";\s*\S"), F.lit(CHAINED)),
        F.when(
            ~has_word(sql, tables),
            F.lit(NO_TABLE + ", ".join(tables)),
        ),
    ]
    return F.array_compact(F.array(*checks))


def clean_sql(sql: Column) -> Column:
    """Strip code fences, squeeze white space, end with exactly one semicolon."""
    bare = F.regexp_replace(sql, r"```(sql)?\n?", "")
    squeezed = F.trim(F.regexp_replace(bare, r"\s+", " "))
    return F.concat(F.regexp_replace(squeezed, r"[;\s]+$", ""), F.lit(";"))


def question_ok(text: Column, shortest: int = 3, longest: int = 500) -> Column:
    sized = (F.length(text) >= shortest) & (F.length(text) <= longest)
    return sized & ~contains_any(text, SCREENED_TOKENS)


def confidence_label(score: Column) -> Column:
    """Bands at 0.9 and 0.7."""
    return F.when(score >= 0.9, "high").when(score >= 0.7, "medium").otherwise("low")


def answer_band(percent: Column) -> Column:
    """Bands at 95 and 70 percent."""
    return F.when(percent >= 95, "high").when(percent >= 70, "medium").otherwise("low")


# Patterns for personal data.
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "ip": r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
}


def pii_counts(text: Column) -> dict[str, Column]:
    return {n: F.regexp_count(text, F.lit(p)) for n, p in PII.items()}


def hide_pii(text: Column) -> Column:
    for name, pattern in PII.items():
        text = F.regexp_replace(text, pattern, f"<{name}>")
    return text


def wraps_column(sql: Column, column: str) -> Column:
    """True when a filter wraps the column in a function or cast, which stops pruning."""
    return sql.rlike(rf"(?is)\bwhere\b.*\b\w+\s*\(\s*{column}\b")
