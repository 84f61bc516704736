"""Rules for failed writes: what to retry, ignore or set aside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.model import DEFAULT_RETRY_ATTEMPTS, DEFAULT_RETRY_INITIAL_S, DEFAULT_RETRY_MAX_S

# Words that mark a whole batch as worth another try.
BATCH_WORDS = ("rate limit", "temporary", "unavailable", "timeout", "connection", "backenderror", "internalerror")
# Reasons that mark a row error as passing.
TRANSIENT_REASONS = ("backenderror", "internalerror", "ratelimitexceeded", "serviceunavailable")
# Words that mark an inner error of a batch as passing.
INNER_WORDS = ("backend", "temporary")
# Words that mark a plain-text row error as passing.
ROW_WORDS = ("backend", "temporary", "unavailable", "timeout", "rate")
# Fixed value: the word that marks a row as already written.
DUPLICATE_WORD = "duplicate"

RETRY, IGNORED, PERMANENT = "retry", "ignored", "permanent"


def _has_any(text: Column, words: tuple[str, ...]) -> Column:
    return F.coalesce(F.lower(text).rlike("|".join(words)), F.lit(False))


def retry_delay_s(
    attempt: Column, initial_s: float = DEFAULT_RETRY_INITIAL_S, max_s: float = DEFAULT_RETRY_MAX_S
) -> Column:
    """Seconds to wait after a failed attempt (counted from 0): doubling, up to a ceiling."""
    return F.least(F.lit(float(initial_s)) * F.pow(F.lit(2.0), attempt), F.lit(float(max_s)))


def retry_exhausted(attempt: Column, max_attempts: int = DEFAULT_RETRY_ATTEMPTS) -> Column:
    return attempt + 1 >= F.lit(max_attempts)


def batch_retryable(message: Column, errors: Column | None = None) -> Column:
    """Whether a failed batch is worth another try, by its message or its inner errors.

    ``errors`` is an array of ``(reason, message)``; a null reason means the
    error came as plain text.
    """
    by_message = _has_any(message, BATCH_WORDS)
    if errors is None:
        return by_message

    def passing(e: Column) -> Column:
        named = F.coalesce(F.lower(e["reason"]).isin(*TRANSIENT_REASONS), F.lit(False))
        return named | _has_any(F.concat_ws(" ", e["reason"], e["message"]), INNER_WORDS)

    return by_message | F.coalesce(F.exists(errors, passing), F.lit(False))


def classify_row_error(errors: Column, row_index: Column, batch_rows: Column) -> Column:
    """``retry``, ``ignored`` or ``permanent`` for one failed row.

    One duplicate among the inner errors outweighs the rest, one passing error
    outweighs permanent ones, and a row that lies outside its batch is permanent.
    """

    def duplicate(e: Column) -> Column:
        return _has_any(F.concat_ws(" ", e["reason"], e["message"]), (DUPLICATE_WORD,))

    def passing(e: Column) -> Column:
        return F.when(e["reason"].isNull(), _has_any(e["message"], ROW_WORDS)).otherwise(
            F.lower(e["reason"]).isin(*TRANSIENT_REASONS)
        )

    inside = (row_index >= 0) & (row_index < batch_rows)
    return (
        F.when(~F.coalesce(inside, F.lit(False)), F.lit(PERMANENT))
        .when(F.coalesce(F.exists(errors, duplicate), F.lit(False)), F.lit(IGNORED))
        .when(F.coalesce(F.exists(errors, passing), F.lit(False)), F.lit(RETRY))
        .otherwise(F.lit(PERMANENT))
    )
