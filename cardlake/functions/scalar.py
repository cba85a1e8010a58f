"""Scalar column functions (F1-F6, P5, S5). All built-in expressions, so they
stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardlake.schemas import DECIMAL, FILE_DATE_FORMAT


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ``last first middle`` with a NULL part read as empty text, which keeps its
# separating space (``concat`` alone would give NULL, ``concat_ws`` drop the space)
FULL_NAME_SQL = ("concat(coalesce(last_name, ''), ' ', coalesce(first_name, ''), ' ', "
                 "coalesce(patronymic, ''))")


# day of a timestamp in the session zone (UTC), as SQL text
EVENT_DAY_SQL = "to_date(trans_date)"


def parse_amount(text) -> Column:
    """Amount text with a decimal comma or point -> decimal(18,2).

    Parsed straight from text so that no binary float is involved (ledger
    Q12). Unparsable text (``'1 500,5'``, empty) gives NULL; the staging step
    counts those and fails the date.
    """
    return F.replace(F.trim(_c(text)), F.lit(","), F.lit(".")).try_cast(DECIMAL)


def has_prefix(name, prefixes: Iterable[str]) -> Column:
    """the text starts with any of the prefixes."""
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | _c(name).startswith(p)
    return cond


def file_date(name) -> Column:
    """date embedded in a file name: the 8 characters before the first dot,
    ``ddMMyyyy``. A malformed date raises (as the source job does)."""
    stem = F.substring_index(_c(name), ".", 1)
    return F.to_date(F.substring(stem, -8, 8), FILE_DATE_FORMAT)


def file_date_or_null(name) -> Column:
    """Like ``file_date`` but NULL for a malformed date (for a reject report)."""
    stem = F.substring_index(_c(name), ".", 1)
    return F.try_to_date(F.substring(stem, -8, 8), FILE_DATE_FORMAT)


def date_token(d) -> Column:
    """Inverse of ``file_date``: a date as ``ddMMyyyy`` text."""
    return F.date_format(_c(d), FILE_DATE_FORMAT)
