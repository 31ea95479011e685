"""Row- and column-level protection of views by group membership.

``secured_view`` makes a catalog view that asks ``current_user()`` and the
membership table whenever it is read, so a change of members holds from the
next read on.  The functions below it decide once, for a given user:

Membership is an input table ``(user, group)``.  ``is_member`` is decided
once per view (a tiny lookup: at most one row reaches the driver) and enters
the plan as a literal, so Catalyst folds the CASE away: each viewer gets a
plain projection / filter with no per-row membership test and no join
against the membership table.  As in the lessons, the *group* is the
restricted audience: its members see redacted / masked values and the
filtered rows, everyone else sees the table as is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import mask_keep_last
from quarry.session import scratch_dir


def is_member(members: DataFrame, user: str, group: str) -> bool:
    """True when ``(user, group)`` is in the membership table."""
    return not members.where((F.col("user") == user) & (F.col("group") == group)).limit(1).isEmpty()


def redact(df: DataFrame, columns: Sequence[str], restricted: bool, token: str = "REDACTED") -> DataFrame:
    """Restricted viewers see ``token`` in the listed columns."""
    cols = [F.when(F.lit(restricted), F.lit(token)).otherwise(F.col(c).cast("string")).alias(c)
            if c in columns else F.col(c) for c in df.columns]
    return df.select(*cols)


def row_filter(df: DataFrame, predicate: str | Column, restricted: bool) -> DataFrame:
    """Restricted viewers see only rows where ``predicate`` is TRUE; others all rows."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.where(F.when(F.lit(restricted), F.coalesce(p, F.lit(False))).otherwise(F.lit(True)))


def mask(df: DataFrame, columns: Sequence[str], restricted: bool, keep: int = 2) -> DataFrame:
    """Restricted viewers see all but the last ``keep`` characters as '*'."""
    cols = [F.when(F.lit(restricted), mask_keep_last(F.col(c).cast("string"), keep))
            .otherwise(F.col(c).cast("string")).alias(c) if c in columns else F.col(c) for c in df.columns]
    return df.select(*cols)


def protect(df: DataFrame, members: DataFrame, user: str, group: str, redact_cols: Sequence[str] = (),
            mask_cols: Sequence[str] = (), predicate: str | Column | None = None) -> DataFrame:
    """Row filter, redaction and masking for ``user`` (restricted when in ``group``)."""
    restricted = is_member(members, user, group)
    out = df
    if predicate is not None:
        out = row_filter(out, predicate, restricted)
    if redact_cols:
        out = redact(out, redact_cols, restricted)
    if mask_cols:
        out = mask(out, mask_cols, restricted)
    return out


def members_table(spark, pairs: Sequence[tuple[str, str]], name: str) -> str:
    """A catalog table ``(user, group)`` below the shared scratch folder, filled with ``pairs``."""
    spark.sql(f"CREATE TABLE {name} (`user` STRING, `group` STRING) USING parquet LOCATION '{scratch_dir(spark, name)}'")
    members_frame(spark, pairs).coalesce(1).write.insertInto(name)
    return name


def secured_view(spark, name: str, base: str, members: str, group: str, redact_cols: Sequence[str] = (),
                 mask_cols: Sequence[str] = (), predicate: str | None = None, keep: int = 2, token: str = "REDACTED",
                 temporary: bool = True) -> str:
    """A view over the table or view ``base``: members of ``group`` see it redacted, masked and filtered.

    Who reads is asked when the view is read: one uncorrelated subquery over
    the membership table, run once a read whatever the rows, with
    ``current_user()``.  A permanent view (``temporary=False``) needs a
    permanent ``base``.
    """
    quoted = group.replace("\\", "\\\\").replace("'", "\\'")
    member = f"(SELECT count(*) > 0 FROM {members} WHERE `user` = current_user() AND `group` = '{quoted}')"

    def column(c: str) -> str:
        text = f"CAST(`{c}` AS STRING)"
        if c in redact_cols:
            return f"CASE WHEN {member} THEN '{token}' ELSE {text} END AS `{c}`"
        if c in mask_cols:
            return (f"CASE WHEN {member} AND length({text}) > {keep} THEN "
                    f"concat(repeat('*', length({text}) - {keep}), right({text}, {keep})) ELSE {text} END AS `{c}`")
        return f"`{c}`"

    where = f" WHERE CASE WHEN {member} THEN coalesce({predicate}, false) ELSE true END" if predicate else ""
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {name} AS SELECT {', '.join(map(column, spark.table(base).columns))} FROM {base}{where}")
    return name


def owned_by(df: DataFrame, owner_col: str, user: str) -> DataFrame:
    """Rows keyed to the current user (``owner = current_user()``), user as a parameter."""
    return df.where(F.col(owner_col) == F.lit(user))


def members_frame(spark, pairs: Mapping[str, Sequence[str]] | Sequence[tuple[str, str]]) -> DataFrame:
    """Membership table from (user, group) pairs or {group: [users]}."""
    if isinstance(pairs, Mapping):
        rows = [(u, g) for g, us in pairs.items() for u in us]
    else:
        rows = list(pairs)
    return spark.createDataFrame(rows, "user string, group string")
