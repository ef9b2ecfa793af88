"""Table names.

The schema file name decides the table name: the source name is the base
name minus its last extension; the published name is that, with every run
of characters outside ``[a-zA-Z0-9_]`` replaced by one ``_``, lower-cased,
and prefixed with ``t_`` when it does not start with a letter or ``_``.
An empty result means the name is invalid.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character class kept in table names and the prefix for
# names that start with a digit.
_INVALID_RUN = "[^a-zA-Z0-9_]+"
_PREFIX = "t_"
_INVALID_RUN_RE = re.compile(_INVALID_RUN)


def _base(path: str) -> str:
    stripped = path.rstrip("/")
    if not stripped:
        return "/" if path else "."
    return stripped.rsplit("/", 1)[-1]


def source_table_name(path: str) -> str:
    """W14 — base name minus its last extension, not normalised."""
    base = _base(path)
    dot = base.rfind(".")
    return base[:dot] if dot >= 0 else base


def normalize_table_name(path: str) -> str:
    """W13 on the driver (table specs are driver-side metadata)."""
    name = _INVALID_RUN_RE.sub("_", source_table_name(path)).lower()
    if not name:
        return ""
    if not (name[0].isascii() and name[0].isalpha()) and name[0] != "_":
        name = _PREFIX + name
    return name


def source_name_col(path: str | Column) -> Column:
    """W14 as a column expression: base name minus its last extension."""
    p = F.col(path) if isinstance(path, str) else path
    base = F.regexp_extract(F.regexp_replace(p, "/+$", ""), "([^/]*)$", 1)
    return F.regexp_replace(base, r"\.[^.]*$", "")


def normalize_table_name_col(path: str | Column) -> Column:
    """W13 as a column expression, for many paths at once."""
    stem = source_name_col(path)
    norm = F.lower(F.regexp_replace(stem, _INVALID_RUN, "_"))
    return (F.when(norm == "", F.lit(""))
            .when(norm.rlike("^[a-zA-Z_]"), norm)
            .otherwise(F.concat(F.lit(_PREFIX), norm)))
