"""Secrets in texts: plain patterns, and credentials whose parts are linked.

Access identifiers, secret values and endpoints are weak evidence alone. An interval
join within each text links parts of different kinds that lie within a scope of
characters; a weak part is reported only if a complementary one does. Everything is
DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culvert.llm.frames import ID_KEY, TEXT_KEY, row_key, stored

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_ASSIGNED = 6

#: Weak parts.
WEAK_ID = r"""(?i:access_?key(?:_?id)?|client_?id|key_?id|user_?name|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@=-]{4,}"""
WEAK_SECRET = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{32})(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])[A-Za-z0-9+/_-]++={0,2}"
ENDPOINT = r"""(?:https?|ftp|s3|jdbc:[a-z]+|amqps?|rediss?|postgres(?:ql)?|mongodb)://[A-Za-z0-9._~:/?#@%&+=-]+"""

#: Characters between two parts at most.
SCOPE = 200

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
#: Which class of part a kind is, and with which classes it makes a credential.
_CLASS = {"assign": "secret", "access": "id", "hex": "secret", "weak_id": "id", "weak_secret": "secret", "endpoint": "place"}
_NEEDS = {"id": ("secret",), "secret": ("id", "place"), "place": ("secret",)}

_SPANS = "array<struct<start:long,kind:int,end:long>>"


def _matches(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Spans of a pattern's matches in code points; of those whose ``group`` has
    ``least`` characters."""
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    sizes = F.regexp_extract_all(text, F.lit(pattern), group) if least else hits
    steps = F.zip_with(
        F.arrays_zip(F.slice(pieces, 1, F.size(hits)).alias("p"), hits.alias("h")),
        sizes,
        lambda x, g: F.struct(
            F.length(x["p"]).cast("long").alias("gap"), F.length(x["h"]).cast("long").alias("n"), (F.length(g) >= least).alias("ok")
        ),
    )
    nothing = F.lit(None).cast(_SPANS)
    empty = F.array().cast(_SPANS)
    found = F.aggregate(
        steps,
        F.struct(F.lit(0).cast("long").alias("at"), empty.alias("found")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["n"]).alias("at"),
            F.when(
                x["ok"],
                F.concat(
                    acc["found"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["gap"]).alias("start"),
                            F.lit(KINDS.index(kind)).alias("kind"),
                            (acc["at"] + x["gap"] + x["n"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(acc["found"])
            .alias("found"),
        ),
        lambda acc: acc["found"],
    )
    return F.coalesce(F.when(text.rlike(pattern), found).otherwise(nothing), empty)


def _linked(parts: DataFrame) -> DataFrame:
    """Weak parts with a complementary part within the scope: an interval join on the
    text and the cell of characters in which a part begins or which it comes near."""
    rows = parts.select(ID_KEY, TEXT_KEY, F.explode(F.concat("base", "weak")).alias("s")).distinct()
    group = F.element_at(F.array(*[F.lit(_CLASS[k]) for k in KINDS]), F.col("s.kind") + 1)
    rows = rows.select(ID_KEY, TEXT_KEY, "s", group.alias("class"))
    weak = rows.where(F.col("s.kind") >= KINDS.index("weak_id"))
    needs = F.create_map(*[x for k, v in _NEEDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    cells = F.explode(F.expr(f"sequence(s.start div {SCOPE}, (s.end + {SCOPE}) div {SCOPE})")).alias("cell")
    left = weak.select(ID_KEY, TEXT_KEY, "s", F.explode(needs[F.col("class")]).alias("class"))
    left = left.select("*", cells)
    right = rows.select("*", cells).select(
        ID_KEY, TEXT_KEY, "class", "cell", F.col("s.start").alias("from"), F.col("s.end").alias("to")
    )
    near = (F.col("from") - F.col("s.end") <= SCOPE) & (F.col("s.start") - F.col("to") <= SCOPE)
    return left.join(right, [ID_KEY, TEXT_KEY, "class", "cell"]).where(near).select(ID_KEY, TEXT_KEY, "s").distinct()


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def _of_kind(kind: int) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_assign, n_access, n_hex, base, spans)``, one row per row of ``docs``.

    ``base`` lists the spans of the plain patterns as ``kind:start:end`` in code points,
    end exclusive, by start, then kind, joined by commas; ``spans`` has the linked weak
    parts as well. Missing and empty texts have none. Spans of the same kind never
    overlap, those of different kinds may. Rows equal in id and text are scanned as one
    text; ids may repeat or be missing, other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = F.concat(
        _matches(text, ASSIGN, "assign", 2, LEAST_ASSIGNED), _matches(text, ACCESS, "access"), _matches(text, HEX, "hex")
    )
    weak = F.concat(*[_matches(text, p, k) for p, k in ((WEAK_ID, "weak_id"), (WEAK_SECRET, "weak_secret"), (ENDPOINT, "endpoint"))])
    found = docs.select(
        F.col(id_col).alias("id"), *row_key(docs, id_col, text_col), F.sort_array(base).alias("base"), weak.alias("weak")
    )
    found = stored(found, "secret-parts")
    linked = _linked(found.where(F.size("weak") > 0)).groupBy(ID_KEY, TEXT_KEY).agg(F.collect_list("s").alias("linked"))
    every = F.sort_array(F.concat("base", F.coalesce("linked", F.array().cast(_SPANS))))
    counted = [_of_kind(k).alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.join(linked, [ID_KEY, TEXT_KEY], "left").select(
        F.col("id").alias(id_col), *counted, _listed(F.col("base")).alias("base"), _listed(every).alias("spans")
    )
