"""Secret scan with multipart credential linking, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflog.llm.common import id_and_text
from shelflog.session import materialize

# The base patterns and the order of kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
# Patterns of the weak parts.
USER = r"""(?i:(user|username|login|account|client_id|access_key_id)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9._@-]{3,})"""
OPAQUE = r"[A-Za-z0-9+/]{32,}"
ENDPOINT = r"(?:https?|ftp|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/@-]+"
KINDS = ["assign", "access", "hex", "user", "weak", "opaque", "endpoint"]

MIN_VALUE = 12
MIN_WEAK_VALUE = 6
SCOPE = 300
CHUNK = 256


def _matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that don't overlap, as structs (start, end, all): code points.

    What lies between the matches gives their offsets. The running sum goes over chunks, so
    that its cost stays near linear in the number of matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"))
    sizes = F.transform(
        F.slice(parts, F.lit(1), F.size(found)),
        lambda p: F.struct(F.length(p["gap"]).alias("gap"), F.length(p["hit"]).alias("size"), p["hit"].alias("hit")),
    )

    def total(items: Column) -> Column:
        return F.aggregate(items, F.lit(0), lambda a, p: a + p["gap"] + p["size"])

    def chunk(items: Column, c: Column) -> Column:
        return F.slice(items, c * CHUNK + 1, F.lit(CHUNK))

    kind = "array<struct<start:int,end:int,hit:string>>"

    def placed(items: Column, base: Column) -> Column:
        first = F.struct(base.alias("at"), F.array().cast(kind).alias("out"))
        return F.aggregate(
            items,
            first,
            lambda a, p: F.struct(
                (a["at"] + p["gap"] + p["size"]).alias("at"),
                F.concat(
                    a["out"],
                    F.array(
                        F.struct(
                            (a["at"] + p["gap"]).alias("start"),
                            (a["at"] + p["gap"] + p["size"]).alias("end"),
                            p["hit"].alias("hit"),
                        )
                    ),
                ).alias("out"),
            ),
            lambda a: a["out"],
        )

    last = F.floor((F.size(found) - 1) / CHUNK).cast("int")
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    bases = F.aggregate(
        F.sequence(F.lit(0), last),
        empty,
        lambda a, c: F.struct(
            (a["at"] + total(chunk(sizes, c))).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")
        ),
        lambda a: a["out"],
    )
    spread = F.flatten(F.transform(bases, lambda base, c: placed(chunk(sizes, c), base)))
    return F.when(F.size(found) == 0, F.array().cast(kind)).otherwise(spread)


def _value_size(hit: Column, pattern: str) -> Column:
    return F.length(F.regexp_extract(hit, pattern, 2))


def _named(matches: Column, kind: str) -> Column:
    return F.transform(
        matches,
        lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")),
    )


def _mixed(hit: Column) -> Column:
    return hit.rlike("[0-9]") & hit.rlike("[a-z]") & hit.rlike("[A-Z]")


def _spelt(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: doc_id, base and linked spans.

    ``base`` holds the strong findings (kinds assign, access, hex). ``linked`` holds weak
    candidates: user names, short secret values, opaque mixed strings and endpoints. A weak
    candidate is reported only if a complementary part begins within ``scope`` code points
    before its start or after its end: an identifier (access, user) or endpoint for a
    secret, a secret (assign, hex, weak, opaque) for an identifier or endpoint. Parts are joined
    as intervals on (document, scope cell); a part of either side stands in each cell from its
    start to ``scope`` after its end, so a cell holds no more parts than fit in its few hundred
    characters, however long or frequent a text is, and a part may be of any length. Spans are arrays of (start, kind, end); ``spelt`` writes them as text.

    Cases: a null text is empty; empty texts and tables have no spans. Rows equal in doc_id
    and text get the same spans each. A null doc_id is a value like any other. Other columns
    are not read.
    """
    text = F.col("text")
    rows = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce(text, F.lit("")))
    # A pattern is only run where a cheap test says it can match.
    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")

    def where(test: Column, pattern: str) -> Column:
        return F.when(test, _matches(text, pattern)).otherwise(none)

    found = rows.select(
        "doc_id",
        F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), text), 256).alias("row"),
        where(text.rlike(ASSIGN), ASSIGN).alias("assign"),
        where(text.contains("AKIA"), ACCESS).alias("access"),
        where(text.rlike(HEX), HEX).alias("hex"),
        where(text.rlike(USER), USER).alias("user"),
        where(text.rlike(OPAQUE), OPAQUE).alias("opaque"),
        where(text.contains("://"), ENDPOINT).alias("endpoint"),
    )
    parts = materialize(
        found.select(
            "doc_id",
            "row",
            F.concat(
                _named(F.filter("assign", lambda m: _value_size(m["hit"], ASSIGN) >= MIN_VALUE), "assign"),
                _named(F.col("access"), "access"),
                _named(F.col("hex"), "hex"),
            ).alias("base"),
            F.concat(
                _named(F.col("user"), "user"),
                _named(
                    F.filter(
                        "assign",
                        lambda m: _value_size(m["hit"], ASSIGN).between(MIN_WEAK_VALUE, MIN_VALUE - 1),
                    ),
                    "weak",
                ),
                _named(F.filter("opaque", lambda m: _mixed(m["hit"])), "opaque"),
                _named(F.col("endpoint"), "endpoint"),
            ).alias("weak"),
        ),
        "secret-parts",
    )
    several = parts.where((F.size("weak") > 0) & (F.size("weak") + F.size("base") > 1)).dropDuplicates(["row"])

    def role(kind: Column) -> Column:
        secret = kind.isin([KINDS.index(k) for k in ("assign", "hex", "weak", "opaque")])
        other = kind.isin([KINDS.index(k) for k in ("access", "user", "endpoint")])
        return F.when(secret, 0).when(other, 1)

    candidate = several.select("row", F.explode("weak").alias("part")).select("row", "part.*")
    # Of two parts within ``scope`` the later start lies in the reach of the earlier part or at
    # its edge, so each stands in all cells from its start to its end and ``scope`` further.
    candidate = candidate.withColumn("role", role(F.col("kind")))
    candidate = candidate.withColumn("cell", F.explode(F.sequence(F.expr(f"start div {scope}"), F.expr(f"(end + {scope}) div {scope}"))))
    reach = F.sequence(F.expr(f"start div {scope}"), F.expr(f"(end + {scope}) div {scope}"))
    partner = (
        several.select("row", F.explode(F.concat("base", "weak")).alias("part"))
        .select("row", "part.*")
        .withColumn("role", role(F.col("kind")))
        .where(F.col("role").isNotNull())
        .withColumn("cell", F.explode(reach))
        .select(*[F.col(c).alias(f"p_{c}") for c in ("row", "start", "end", "role", "cell")])
    )
    near = (F.col("p_start") <= F.col("end") + scope) & (F.col("p_end") >= F.col("start") - scope)
    linked = (
        candidate.join(
            partner,
            (F.col("row") == F.col("p_row"))
            & (F.col("cell") == F.col("p_cell"))
            & (F.col("role") == 1 - F.col("p_role"))
            & near,
            "left_semi",
        )
        .select("row", "start", "kind", "end")
        .distinct()
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))
    )
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return parts.join(linked, "row", "left").select(
        "doc_id", "base", F.coalesce("linked", empty).alias("linked"), F.col("row").alias("row_sha256")
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and all spans as text."""

    def count(kind: str) -> Column:
        at = KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == at)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(_spelt(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _spelt(F.concat("base", "linked")).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
    )
