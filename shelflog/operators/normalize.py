"""Bulk normalisation: raw payload JSON of four sources to canonical observations.

Each source states where its leaves are, and every leaf is read from the VARIANT once per
row. Looking at the enclosing objects is only needed where a leaf is missing, so well-formed
payloads skip it. Bad payloads get a reason instead of failing the batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field as default

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflog.functions import (
    event_id,
    field,
    payload_hash,
    read_utc,
    std_code,
)
from shelflog.schemas import SOURCES

EXCERPT_LENGTH = 300
# Constants of every normalised observation.
CURRENCY, LOCATION, SCHEMA_VERSION = "USD", "ONLINE", "1.0"

SEPARATOR = "; "
# JSON text of values that count as missing.
FALSY_JSON = ["null", "false", "0", "0.0", "-0.0", '""', "[]", "{}"]
LEAVES = ["name", "price", "flag", "word", "quantity", "sku", "upc"]


@dataclass(frozen=True)
class Layout:
    """Paths of one source's leaves below ``$``.

    ``price`` may name two keys: the second counts only if the first is absent, while an
    explicit null in the first stays null. ``enclosing`` are objects that must be readable
    if present; ``required`` must be there and not empty.
    """

    name: str
    price: tuple[str, ...]
    flag: str | None = None
    word: str | None = None
    quantity: str | None = None
    sku: str | None = None
    upc: str | None = None
    keeps_store: bool = False
    required: str = ""
    required_reason: str = "empty response"
    enclosing: dict[str, str] = default(default_factory=dict)
    first_of: str | None = None


# Payload layouts, by source.
LAYOUTS: dict[str, Layout] = {
    "TARGET": Layout(
        name=".data.product.item.product_description.title",
        price=(".data.product.price.current_retail",),
        word=".data.product.available_to_promise.availability",
        quantity=".data.product.available_to_promise.available_to_promise_quantity",
        keeps_store=True,
        required=".data.product",
        required_reason="no product data",
        enclosing={
            ".data": "malformed data",
            ".data.product": "malformed product",
            ".data.product.price": "malformed price",
            ".data.product.available_to_promise": "malformed availability",
            ".data.product.item": "malformed item",
            ".data.product.item.product_description": "malformed description",
        },
    ),
    "WALMART": Layout(
        name=".name",
        price=(".salePrice", ".msrp"),
        flag=".availableOnline",
        word=".stock",
        upc=".upc",
    ),
    "POKEMON_CENTER": Layout(
        name=".product.title",
        price=(".product.variants[0].price",),
        flag=".product.variants[0].available",
        sku=".product.variants[0].sku",
        required=".product",
        required_reason="no product data",
        enclosing={".product": "malformed product"},
        first_of=".product.variants",
    ),
    "GAMESTOP": Layout(
        name=".productName",
        price=(".pricing.salePrice", ".pricing.listPrice"),
        flag=".availability.isInStock",
        word=".availability.isPreOrder",
        sku=".sku",
        enclosing={".pricing": "malformed pricing", ".availability": "malformed availability"},
    ),
}

# Availability words of the two sources that use words.
TARGET_WORDS = {
    "IN_STOCK": ["AVAILABLE", "IN_STOCK"],
    "OUT_OF_STOCK": ["UNAVAILABLE", "OUT_OF_STOCK", "NOT_AVAILABLE"],
    "PREORDER": ["PREORDER"],
    "BACKORDER": ["BACKORDER"],
}
WALMART_WORDS = {
    "IN_STOCK": ["available"],
    "OUT_OF_STOCK": ["not available", "unavailable"],
    "PREORDER": ["preorder"],
}


def _at(path: str) -> Column:
    return field(F.col("raw_response"), f"${path}")


def _leaf(layout: Layout, leaf: str) -> Column:
    path = getattr(layout, leaf)
    if path is None:
        return F.lit(None).cast("variant")
    if isinstance(path, tuple):
        return F.coalesce(*[_at(p) for p in path])
    return _at(path)


def _none_below(layout: Layout, path: str) -> Column:
    """No leaf below ``path`` was found; if one was, ``path`` is an object with members."""
    missing = F.lit(True)
    for leaf in LEAVES:
        paths = getattr(layout, leaf) or ()
        if any(p.startswith(path) for p in ([paths] if isinstance(paths, str) else paths)):
            missing = missing & F.col(f"_{leaf}").isNull()
    return missing


def _odd_object(text: Column) -> Column:
    """JSON text of something that should be an object but is neither one nor empty."""
    return ~text.isin(FALSY_JSON) & ~F.startswith(text, F.lit("{"))


def _structure(source: str) -> tuple[dict[str, Column], list[tuple[Column, str]]]:
    """Enclosing values worth a look, and the defects they reveal.

    A value is only printed for its own source and when no leaf below it was found, else it
    is null.
    """
    layout = LAYOUTS[source]
    looks: dict[str, Column] = {}

    def look(path: str) -> Column:
        name = f"_{source}_at_{len(looks)}"
        wanted = (F.col("source") == source) & _none_below(layout, path)
        looks[name] = F.when(wanted, F.coalesce(F.to_json(_at(path)), F.lit("null")))
        return F.col(name)

    defects = [(look(layout.required).isin(FALSY_JSON), layout.required_reason)]
    for path, reason in {"": "not an object", **layout.enclosing}.items():
        defects.append((_odd_object(look(path)), reason))
    if layout.first_of:
        first, variants = look(f"{layout.first_of}[0]"), look(layout.first_of)
        unreadable = ~variants.isin(FALSY_JSON) & ~F.startswith(first, F.lit("{"))
        # Without leaves in the first variant both texts are there.
        defects.append((unreadable, "malformed variants"))
    if layout.word and not layout.flag:
        word = F.col("_word_json")
        odd = ~F.startswith(word, F.lit('"')) & ~word.isin(FALSY_JSON)
        defects.append((odd, "malformed availability"))
    return looks, defects


def _from_words(word: Column, words: dict[str, list[str]]) -> Column:
    status = None
    for code, spellings in words.items():
        hit = word.isin([f'"{spelling}"' for spelling in spellings])
        status = F.when(hit, F.lit(code)) if status is None else status.when(hit, F.lit(code))
    return status.otherwise(F.lit("UNKNOWN"))


def _from_flag(otherwise: Column) -> Column:
    # JSON literals only; the text "true" has quotes here and does not count.
    flag = F.col("_flag_json")
    return (
        F.when(flag == "true", F.lit("IN_STOCK"))
        .when(flag == "false", F.lit("OUT_OF_STOCK"))
        .otherwise(otherwise)
    )


def _status(source: str) -> Column:
    word = F.col("_word_json")
    if source == "TARGET":
        return _from_words(F.upper(word), TARGET_WORDS)
    if source == "WALMART":
        return _from_flag(_from_words(F.lower(word), WALMART_WORDS))
    if source == "GAMESTOP":
        # A false flag decides before the pre-order flag is looked at.
        preorder = F.when(word == "true", F.lit("PREORDER")).otherwise(F.lit("UNKNOWN"))
        return _from_flag(preorder)
    return _from_flag(F.lit("UNKNOWN"))


def _quantity() -> Column:
    """Numbers lose their fraction; text must be a whole number."""
    text = F.try_variant_get("_quantity", "$", "string")
    whole = F.when(F.rlike(F.trim(text), F.lit(r"^[+-]?[0-9]+$")), F.trim(text))
    return F.when(
        F.startswith("_quantity_json", F.lit('"')), whole.try_cast("bigint")
    ).otherwise(F.try_variant_get("_quantity", "$", "bigint"))


def _present(leaf: str) -> Column:
    return F.col(f"_{leaf}_json") != "null"


def _not_text(leaf: str) -> Column:
    return _present(leaf) & ~F.startswith(f"_{leaf}_json", F.lit('"'))


def _value_rules(layout: Layout) -> list[tuple[Column, str]]:
    rules = [
        (
            _not_text("name") & ~F.col("_name_json").isin(FALSY_JSON),
            "name is not text",
        ),
        (_present("price") & F.col("price").isNull(), "price is not a number"),
        (F.col("price") < 0, "price must not be negative"),
    ]
    if layout.quantity:
        count = F.col("quantity_available")
        rules += [
            (_present("quantity") & count.isNull(), "quantity is not a number"),
            (count < 0, "quantity_available must not be negative"),
        ]
    rules += [(_not_text(leaf), f"{leaf} is not text") for leaf in ("sku", "upc") if getattr(layout, leaf)]
    return rules


def _joined(rules: list[tuple[Column, str]]) -> Column:
    """Texts of the rules that hold; empty if none does."""
    return F.concat_ws(SEPARATOR, *[F.when(bad, F.lit(why)) for bad, why in rules])


def _by_source(values: dict[str, Column], kind: str) -> Column:
    """The value of the row's own source; the others' are not evaluated."""
    chosen = None
    for source, value in values.items():
        own = F.col("source") == source
        chosen = F.when(own, value) if chosen is None else chosen.when(own, value)
    return F.lit(None).cast(kind) if chosen is None else chosen.otherwise(F.lit(None).cast(kind))


def _read_payloads(payloads: DataFrame, sources: list[str]) -> DataFrame:
    """Every payload read once, by the layout of its source."""
    layouts = {source: LAYOUTS[source] for source in sources}

    def using(leaf: str) -> dict[str, Layout]:
        return {source: x for source, x in layouts.items() if getattr(x, leaf)}

    looks: dict[str, Column] = {}
    defects: dict[str, Column] = {}
    for source in sources:
        own, found = _structure(source)
        looks |= own
        defects[source] = _joined(found)
    return (
        payloads.where(F.col("source").isin(sources))
        .select(
            "source",
            F.col("run_id").alias("ingestion_run_id"),
            "retailer_product_id",
            read_utc(F.col("observed_at")).alias("observed_at"),
            "extracted_at",
            "raw_response",
            *[
                _by_source({k: _leaf(x, leaf) for k, x in using(leaf).items()}, "variant").alias(f"_{leaf}")
                for leaf in LEAVES
            ],
        )
        .withColumns(
            {f"_{leaf}_json": F.to_json(f"_{leaf}") for leaf in LEAVES}
            | {"price": F.try_variant_get("_price", "$", "double")}
            | looks
        )
        .withColumns(
            {
                "inventory_status": _by_source({k: _status(k) for k in sources}, "string"),
                "quantity_available": _by_source({k: _quantity() for k in using("quantity")}, "bigint"),
            }
        )
        .select(
            "source",
            "ingestion_run_id",
            "retailer_product_id",
            "observed_at",
            "extracted_at",
            "raw_response",
            F.try_variant_get("_name", "$", "string").alias("own_name"),
            *[
                _by_source({k: F.try_variant_get(f"_{leaf}", "$", "string") for k in using(leaf)}, "string").alias(leaf)
                for leaf in ("sku", "upc")
            ],
            "price",
            "inventory_status",
            "quantity_available",
            F.col("source").isin([k for k, x in layouts.items() if x.keeps_store]).alias("keeps_store"),
            _by_source(defects, "string").alias("structure_reasons"),
            _by_source({k: _joined(_value_rules(x)) for k, x in layouts.items()}, "string").alias("value_reasons"),
        )
    )


def examine(payloads: DataFrame, catalog: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """Read every payload by its source's layout; adds ``reason``, empty for a good one.

    ``payloads``: source, run_id, retailer_product_id, observed_at (text), raw_response
    (VARIANT), extracted_at. ``catalog``: columns of PRODUCT_CATALOG. The payloads are scanned
    once, whether or not they are partitioned by source. The catalog may be large; Spark
    picks the join by measured size.
    """
    read = _read_payloads(payloads, list(sources or SOURCES))
    known = catalog.select(
        std_code(F.col("retailer")).alias("source"),
        "retailer_product_id",
        F.col("name").alias("catalog_name"),
        F.col("url").alias("product_url"),
        "category",
        F.col("store_id").alias("catalog_store_id"),
        F.lit(True).alias("in_catalog"),
    )
    late_rules = [
        (F.col("in_catalog").isNull(), "product not in catalog"),
        (F.col("observed_at").isNull(), "unreadable observed_at"),
    ]
    parts_of_reason = [F.col("structure_reasons"), _joined(late_rules), F.col("value_reasons")]
    return read.join(known, ["source", "retailer_product_id"], "left").select(
        "*",
        F.concat_ws(SEPARATOR, *[F.nullif(p, F.lit("")) for p in parts_of_reason]).alias("reason"),
    )


def accepted(examined: DataFrame) -> DataFrame:
    """Canonical observations, in the column order of the landed event files."""
    good = examined.where("reason = ''")
    return good.select(
        event_id(F.col("source"), F.col("retailer_product_id"), F.col("observed_at")).alias(
            "event_id"
        ),
        "source",
        "retailer_product_id",
        F.coalesce(F.nullif("own_name", F.lit("")), F.col("catalog_name")).alias("product_name"),
        "product_url",
        "sku",
        "upc",
        "category",
        "price",
        F.lit(CURRENCY).alias("currency"),
        "inventory_status",
        "quantity_available",
        F.when(F.col("keeps_store"), F.col("catalog_store_id")).alias("store_id"),
        F.lit(LOCATION).alias("location_type"),
        "observed_at",
        "extracted_at",
        "ingestion_run_id",
        F.lit(None).cast("string").alias("raw_file_path"),
        payload_hash(F.col("raw_response")).alias("source_response_hash"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )


def rejected(examined: DataFrame, excerpt_length: int = EXCERPT_LENGTH) -> DataFrame:
    """What was wrong, with a short excerpt of the payload."""
    bad = examined.where("reason <> ''")
    return bad.select(
        "ingestion_run_id",
        "source",
        "reason",
        "retailer_product_id",
        F.substring(F.to_json("raw_response"), 1, excerpt_length).alias("raw_excerpt"),
        F.col("extracted_at").alias("occurred_at"),
    )
