"""Id patterns and name clean-up, all as native expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as a user id, a membership id and an offline id kind.
XID_PATTERN = r"\b[0-9a-f]{8}\b-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-\b[0-9a-f]{12}\b"
MCID_PATTERN = r"\b[0-9]{38}"
OFFLINE_ID_KINDS = ["mdw_id", "amg_user_id", "cds_account_number"]
XID_LENGTH = 36


def keep_valid_xids(df: DataFrame, column="xid") -> DataFrame:
    """Rows whose id contains a UUID (an unanchored match)."""
    return df.filter(F.col(column).rlike(XID_PATTERN))


def keep_valid_mcids(df: DataFrame, column="mcid") -> DataFrame:
    return df.filter(F.col(column).rlike(MCID_PATTERN))


def keep_full_length_ids(df: DataFrame, id_column: str, non_empty: str) -> DataFrame:
    """Rows with a 36-character id and a non-empty companion column."""
    companion = F.col(non_empty)
    return df.filter(
        (F.length(id_column) == XID_LENGTH) & companion.isNotNull() & (companion != "")
    )


def vendor_of(name: Column) -> Column:
    """Second underscore-separated token of a workflow name."""
    return F.regexp_extract(name, r"(?<=_)[^_]+(?=_)", 0)


def trailing_number(name: Column, marker: str) -> Column:
    """Integer that follows ``_<marker>_`` in a name, NULL when absent."""
    return F.regexp_extract(name, rf"_{marker}_(\d*)", 1).try_cast("int")


def word_characters(text: Column) -> Column:
    return F.regexp_replace(text, r"\W", "")


def column_slug(name: str) -> str:
    """Tidy column name: lower case, ``::`` to ``__``, blank to ``_``, no dots."""
    slug = name.lower()
    for old, new in (("::", "__"), (" ", "_"), (".", "")):
        slug = slug.replace(old, new)
    return slug


def topic_slug(prefix: str, topic: Column) -> Column:
    """``<prefix>_<topic>`` in lower case, keeping letters, digits and ``_``."""
    joined = F.regexp_replace(topic, "::| ", "_")
    return F.lower(F.concat(F.lit(f"{prefix}_"), F.regexp_replace(joined, r"[^\p{L}\p{N}_]", "")))


def unit_hash(*columns) -> Column:
    """Number in [0, 1) that depends only on the given columns.

    md5 keeps the value the same on every layout, engine and retry.
    """
    text = F.concat_ws("|", *columns)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)
