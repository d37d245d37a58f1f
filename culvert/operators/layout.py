"""Column order, fixed lookups and the audit table."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def layout(df: DataFrame, first: Sequence[str], drop_regex: str | None = None) -> DataFrame:
    """``first`` columns in front, the rest behind, matches of a regex dropped."""
    kept = [c for c in df.columns if not (drop_regex and re.search(drop_regex, c))]
    return df.select(*first, *[c for c in kept if c not in first])


def attach_lookup(
    df: DataFrame, pairs: Sequence[tuple[str, str]], key: str, name: str = "description"
) -> DataFrame:
    """Adds the text of a fixed code list (a handful of rows, so broadcast)."""
    lookup = df.sparkSession.createDataFrame(list(pairs), f"{key} string, {name} string")
    return df.join(F.broadcast(lookup), key, "left")


def audit(stages: Mapping[str, DataFrame], id_col: str, folded: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Rows and distinct ids of named stages, one row each.

    Ids are first grouped by key, so a stage is counted from partial counts
    and never gathered; a NULL id counts as one id. ``folded`` stages bring
    their rows as counts in a column ``n``.
    """
    out = None
    for name, df in {**stages, **(folded or {})}.items():
        n = F.sum("n") if name in (folded or {}) else F.count("*")
        per_id = df.groupBy(id_col).agg(n.alias("n"))
        row = per_id.agg(
            F.lit(name).alias("stage"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.count("*").alias("id_count"),
        )
        out = row if out is None else out.unionByName(row)
    return out
