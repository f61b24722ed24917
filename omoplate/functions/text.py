"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and the plain letter each becomes, after
# lower-casing.
ACCENTED = "áéíóúüñ"
PLAIN = "aeiouun"


def normalize_text(c: Column | str) -> Column:
    """Lower case, then strip the Spanish accents; null stays null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.translate(F.lower(col), ACCENTED, PLAIN)


def drop_prefix(c: Column | str, n: int = 2) -> Column:
    """The text after its first ``n`` characters."""
    col = F.col(c) if isinstance(c, str) else c
    return F.substring(col, n + 1, 2147483647)


# The health-card id format checked on raw files: "AN" and ten
# digits, in a column whose name mentions NUHSA or NUSA.
ID_PATTERN = r"^AN[0-9]{10}$"
ID_COLUMN_MARKERS = ("NUHSA", "NUSA")


def matches_id_format(c: Column | str) -> Column:
    """The value has the expected id format (null -> false)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.rlike(ID_PATTERN), F.lit(False))
