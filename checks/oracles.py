"""The same results in plain SQL, for DuckDB over the same tables."""

from __future__ import annotations

from checks import fixtures as fx
from sluiceway.schemas import (
    DECIMAL_COLUMNS,
    EVENT,
    PRODUCT_COLUMNS,
)


def _select(columns: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(f'{text} AS {name}' for name, text in columns.items())} FROM {source}"


def _discount(original: str, price: str) -> str:
    original, price = f"try_cast({original} AS double)", f"try_cast({price} AS double)"
    return f"round(({original} - {price}) / nullif({original}, 0) * 100, 2)"


def _products(columns: dict[str, str], source: str) -> str:
    cut = _discount("original_price", "price")
    return f"(SELECT *, try_cast({cut} AS decimal(5,2)) AS discount FROM ({_select(columns, source)}))"


PARTS = _products(fx.PART_PRODUCTS, "part")
LINES = _products(fx.LINE_PRODUCTS, "lineitem")
ORDERS = f"({_select(fx.ORDER_PRODUCTS, 'orders')})"
EVENTS = f"({_select(fx.EVENT_PRODUCTS, 'events')})"
HAS_IMAGE = "seq % 10 < 7"


def _columns(decimals: str, columns=PRODUCT_COLUMNS, trim: bool = False) -> str:
    def one(name: str) -> str:
        if name in DECIMAL_COLUMNS:
            return f"cast({name} AS {decimals}) AS {name}"
        if trim and name == "fulfillment_type":
            return f"trim({name}) AS {name}"
        return name

    return ", ".join(one(name) for name in columns)


LAKE = _columns("decimal(12,2)")
STREAMED = f"SELECT {LAKE} FROM {PARTS} WHERE {HAS_IMAGE}"


def _typed(names=PRODUCT_COLUMNS) -> str:
    """Products as the typed table stores them."""
    kinds = {"rating_average": "decimal(3,2)", "discount": "decimal(5,2)"}
    return ", ".join(
        f"cast({n} AS {kinds.get(n, 'decimal(10,2)')}) AS {n}" if n in DECIMAL_COLUMNS else n
        for n in names
    )


# Constraint rules: label, broken, stored value.
def _rules() -> list[tuple[str, str, str]]:
    rules = []
    for name, length in {
        "id": 50, "name": 255, "fulfillment_type": 50, "brand": 100, "current_seller": 255, "category": 100,
    }.items():
        rules.append((f"{name} varchar({length})", f"length(rtrim({name})) > {length}", f"left({name}, {length})"))
    for name, kind in {
        "original_price": "decimal(10,2)", "price": "decimal(10,2)",
        "rating_average": "decimal(3,2)", "discount": "decimal(5,2)",
    }.items():
        stored = f"try_cast({name} AS {kind})"
        rules.append((f"{name} {kind}", f"({name} IS NOT NULL AND {stored} IS NULL)", stored))
    for name in ("review_count", "favourite_count", "number_of_images", "quantity_sold"):
        value = f"round({name})" if name == "favourite_count" else name
        stored = f"try_cast({value} AS integer)"
        rules.append((f"{name} int", f"({name} IS NOT NULL AND {stored} IS NULL)", stored))
    return sorted(rules, key=lambda rule: PRODUCT_COLUMNS.index(rule[0].split()[0]))


RULES = _rules()
_FOUND = ", ".join(f"CASE WHEN {broken} THEN '{label}' END" for label, broken, _ in RULES)
CHECKED = (
    f"(SELECT *, coalesce(nullif(concat_ws('; ', {_FOUND}), ''), 'ok') AS reject_reason FROM {ORDERS})"
)
ACCEPTED = (
    "SELECT " + ", ".join(f"{stored} AS {label.split()[0]}" for label, _, stored in RULES)
    + f" FROM {CHECKED} WHERE reject_reason = 'ok'"
)

KIND = (
    "CASE seq % 10 WHEN 7 THEN 'malformed' WHEN 8 THEN 'tombstone' WHEN 9 THEN 'delete' ELSE 'row' END"
)


def _raw_images() -> str:
    def one(name: str) -> str:
        kind = "decimal(12,2)" if name in DECIMAL_COLUMNS else None
        value = f"CASE WHEN {HAS_IMAGE} THEN {name} END"
        return f"cast({value} AS {kind}) AS {name}" if kind else f"{value} AS {name}"

    return f"SELECT {', '.join(one(name) for name in PRODUCT_COLUMNS)} FROM {PARTS}"


def _unsigned(name: str) -> str:
    """The decimal whose bytes are read without a sign."""
    n = f"cast({name} * 100 AS hugeint)"
    width = " ".join(
        f"WHEN {n} >= {-2 ** (8 * w - 1)} THEN cast('{2 ** (8 * w)}' AS hugeint)" for w in range(1, 8)
    )
    shift = f"CASE WHEN {n} >= 0 THEN 0 {width} END"
    return f"try_cast(cast({n} + {shift} AS decimal(38,0)) / 100 AS decimal(12,2)) AS {name}"


def _event_json() -> str:
    casts = {"string": "varchar", "float": "float", "int": "integer"}
    fields = ", ".join(
        f"json_object('name', '{f.name}', 'type', '{f.dataType.simpleString()}')" for f in EVENT
    )
    values = ", ".join(
        f"'{f.name}', cast({f.name} AS {casts[f.dataType.simpleString()]})" for f in EVENT
    )
    return (
        f"json_object('schema', json_object('type', 'struct', 'fields', json_array({fields})), "
        f"'payload', json_object('created', strftime(ts, '%Y-%m-%d %H:%M:%S'), {values}))::varchar"
    )


def _census() -> str:
    """Counts of the planted fields; declared ones that no message has count 0."""
    image = "p_partkey % 20 NOT IN (11, 12, 13)"
    whole = "p_partkey % 20 <> 11 AND p_partkey % 20 <> 12"
    after = "payload.after."
    planted = [
        ("", "tombstone", "p_partkey % 20 = 11", None, "tombstone"), ("", "malformed", "p_partkey % 20 = 12", None, "malformed"),
        ("payload.op", "STRING", whole, "string", "declared"), ("payload.before.id", "STRING", "p_partkey % 20 = 13", "string", "declared"),
        ("payload.after", "VOID", "p_partkey % 20 = 13", None, "declared"), (f"{after}id", "STRING", image, "string", "declared"),
        (f"{after}colour", "STRING", f"{image} AND p_partkey % 5 = 0", None, "extra"),
        (f"{after}maker.tags.[]", "BIGINT", f"{image} AND p_partkey % 7 = 0", None, "extra"),
        (f"{after}maker.tags.[]", "STRING", f"{image} AND p_partkey % 7 = 0", None, "extra"),
        (f"{after}maker.none", "OBJECT<>", f"{image} AND p_partkey % 7 = 0", None, "extra"),
        (f"{after}review_count", "STRING", f"{image} AND p_partkey % 3 = 0", "int", "mistyped"),
        (f"{after}review_count", "DECIMAL(2,1)", f"{image} AND p_partkey % 3 = 1", "int", "mistyped"),
        (f"{after}review_count", "BIGINT", f"{image} AND p_partkey % 3 = 2", "int", "declared"),
        (f"{after}price", "BIGINT", f"{image} AND p_partkey % 4 = 0", "string", "mistyped"),
        (f"{after}price", "STRING", f"{image} AND p_partkey % 4 <> 0", "string", "declared"),
        (f"{after}brand.en", "STRING", f"{image} AND p_partkey % 9 = 0", None, "deeper"),
        (f"{after}brand", "VOID", f"{image} AND p_partkey % 9 <> 0", "string", "declared"),
    ]
    seen = {row[0] for row in planted}
    counts = {"review_count": "int", "favourite_count": "int", "number_of_images": "int", "quantity_sold": "int"}
    rows = [
        f"SELECT '{path}' AS path, '{kind}' AS type, count(*) * {2 if kind == 'BIGINT' and 'tags' in path else 1} AS occurrences, "
        f"{f"'{declared}'" if declared else 'NULL::VARCHAR'} AS declared, '{status}' AS status FROM part WHERE {condition}"
        for path, kind, condition, declared, status in planted]
    rows += [f"SELECT '{after}{name}', NULL, 0, '{counts.get(name, 'string')}', 'unseen'"
             for name in PRODUCT_COLUMNS if f"{after}{name}" not in seen]
    return " UNION ALL ".join(rows)


_EVENT_CASTS = {"string": "varchar", "float": "float", "int": "integer"}
_CUT_LINES = _discount("l_extendedprice", "(l_extendedprice * (1 - l_discount))")

ORACLES: dict[str, str] = {
    "csv_scan": "SELECT * FROM part",
    "csv_scan_inferred": "SELECT * REPLACE (cast(p_partkey AS integer) AS p_partkey) FROM part",
    "csv_scan_limit": (
        "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders "
        f"ORDER BY o_orderkey LIMIT {fx.LOAD_ROWS}"
    ),
    "csv_head_file_order": (
        "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders "
        f"ORDER BY o_orderkey LIMIT {fx.LOAD_ROWS}"
    ),
    "csv_multiline_records": f"SELECT o_orderkey, {fx.NOTE} AS note, o_totalprice FROM orders",
    "csv_sink_roundtrip": (
        f"SELECT {_columns('double', trim=True)} FROM {PARTS}"
    ),
    "drop_columns": f"SELECT {', '.join(n for n in PRODUCT_COLUMNS if n != 'discount')} FROM {PARTS}",
    "trim_replace": f"SELECT id, trim(fulfillment_type) AS fulfillment_type FROM {PARTS}",
    "discount_pct": (
        "SELECT id, original_price, price, "
        f"cast({_discount('original_price', 'price')} AS decimal(12,2)) AS discount FROM {PARTS}"
    ),
    "discount_pct_lines": (
        f"SELECT l_orderkey, l_linenumber, cast({_CUT_LINES} AS decimal(12,2)) AS discount FROM lineitem"
    ),
    "discount_pct_text": (
        f"SELECT p_partkey AS id, cast({_discount(f'({fx.TEXT_ORIGINAL})', f'({fx.TEXT_PRICE})')} AS decimal(12,2)) "
        "AS discount FROM part"
    ),
    "positional_bind": f"SELECT {', '.join(PRODUCT_COLUMNS)} FROM {PARTS}",
    "timestamp_format": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created FROM events",
    "constraint_split": f"SELECT id, reject_reason FROM {CHECKED}",
    "constraint_accepted": ACCEPTED,
    "constraint_rejected": (
        f"SELECT id, name, number_of_images, reject_reason FROM {CHECKED} WHERE reject_reason <> 'ok'"
    ),
    "constraint_reasons": f"SELECT reject_reason, count(*) AS row_count FROM {CHECKED} GROUP BY reject_reason",
    "typed_table_recreate": f"SELECT {_typed()} FROM {PARTS}",
    "table_append": f"{ACCEPTED} UNION ALL SELECT {_typed()} FROM {PARTS}",
    "load_repeated": f"{ACCEPTED} UNION ALL SELECT {_typed()} FROM {PARTS}",
    "load_ledger": (
        "SELECT *, rows_taken AS rows_in_table FROM (SELECT 'orders' AS source, 3::BIGINT AS portions, count(*) AS rows_in, "
        "count(*) FILTER (reject_reason = 'ok') AS rows_taken, count(*) FILTER (reject_reason <> 'ok') AS rows_rejected, "
        f"true AS balanced FROM {CHECKED} UNION ALL "
        f"SELECT 'parts', 3, count(*), count(*), 0, true FROM {PARTS})"
    ),
    "product_file_rejects": (
        "SELECT cast(o_orderkey AS varchar) AS id, "
        f"CASE WHEN o_orderkey % 7 <> 5 THEN {fx.BROKEN_COUNT} END AS review_count, "
        f"CASE WHEN o_orderkey % 7 <> 5 THEN {fx.BROKEN_PRICE} END AS price, "
        "CASE WHEN o_orderkey % 7 = 1 THEN 'price decimal(10,2)' WHEN o_orderkey % 7 IN (2, 3) "
        "THEN 'review_count int' ELSE 'corrupt record' END AS reject_reason "
        "FROM orders WHERE o_orderkey % 7 BETWEEN 1 AND 5"
    ),
    "product_file_accepted": (
        "SELECT cast(o_orderkey AS varchar) AS id, cast(12.5 AS decimal(10,2)) AS price, "
        "cast(5 AS integer) AS review_count FROM orders WHERE o_orderkey % 7 NOT BETWEEN 1 AND 5"
    ),
    "product_file_load": (
        f"SELECT {_typed().replace('fulfillment_type', 'trim(fulfillment_type) AS fulfillment_type')} FROM {PARTS}"
    ),
    "product_file_broken": (
        f"WITH lines AS (SELECT o_orderkey % 7 AS kind, cast(o_orderkey AS varchar) AS id, {fx.BROKEN_PRICE} AS price, "
        f"{fx.BROKEN_COUNT} AS review_count, {fx.BROKEN_RAW_LINE} AS line FROM orders) "
        "SELECT id, price, review_count, CASE WHEN kind <> 1 THEN '37.5' || CASE WHEN kind IN (2, 3) THEN '' ELSE '0' END END "
        "AS discount, cast(NULL AS varchar) AS line, CASE kind WHEN 0 THEN 'ok' WHEN 1 THEN 'price decimal(10,2)' "
        "ELSE 'review_count int' END AS reason FROM lines WHERE kind < 4 "
        "UNION ALL SELECT id, price, review_count, '37.5', line, 'corrupt record' FROM lines WHERE kind = 4 "
        "UNION ALL SELECT id, NULL, NULL, NULL, line, 'corrupt record' FROM lines WHERE kind = 5 "
        "UNION ALL SELECT id, NULL, NULL, NULL, string_split(line, chr(10))[1], 'corrupt record' FROM lines WHERE kind = 6 "
        "UNION ALL SELECT '20.00', 'b', '1', NULL, string_split(line, chr(10))[2], 'corrupt record' "
        "FROM lines WHERE kind = 6"
    ),
    "cdc_value_cast": "SELECT doc_id, text FROM documents",
    "cdc_table_filter": (
        "SELECT cast(seq AS varchar) AS key, 'sales.public.products' AS topic, "
        "cast(seq % 4 AS integer) AS partition, cast(seq AS bigint) AS \"offset\" "
        f"FROM {PARTS} WHERE seq % 4 <> 0"
    ),
    "cdc_flatten_raw": _raw_images(),
    "cdc_classify": f"SELECT cast(seq AS varchar) AS key, {KIND} AS kind FROM {PARTS}",
    "cdc_clean_rows": (
        f"SELECT {', '.join(n for n in PRODUCT_COLUMNS if n not in DECIMAL_COLUMNS)} "
        f"FROM {PARTS} WHERE {HAS_IMAGE}"
    ),
    "cdc_decode_decimals": f"SELECT {LAKE} FROM {PARTS}",
    "cdc_decode_unsigned": f"SELECT id, {', '.join(_unsigned(n) for n in DECIMAL_COLUMNS)} FROM {PARTS}",
    "cdc_decode_decimals_lines": f"SELECT {LAKE} FROM {LINES} WHERE {HAS_IMAGE}",
    "decimal_codec_roundtrip": (
        "SELECT l_orderkey, l_linenumber, "
        "cast(CASE WHEN l_linenumber % 2 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS decimal(12,2)) AS price, "
        "cast(cast(l_discount AS decimal(12,2)) - cast(l_tax AS decimal(12,2)) AS decimal(12,2)) AS margin "
        "FROM lineitem"
    ),
    "cdc_topic_scan": (
        "SELECT cast(seq AS varchar) AS key, seq % 10 = 8 AS value_is_null, "
        "'sales.public.products' AS topic, cast(seq % 4 AS integer) AS partition, "
        "cast(seq AS bigint) AS \"offset\", cast(seq + 1704067200 AS bigint) AS sent_at, "
        f"cast(0 AS integer) AS timestamp_type FROM {PARTS}"
    ),
    "cdc_stream_append": STREAMED,
    "cdc_stream_append_lines": f"SELECT {LAKE} FROM {LINES} WHERE {HAS_IMAGE}",
    "cdc_stream_restart": STREAMED,
    "cdc_stream_rejects": (
        "SELECT cast(seq AS varchar) AS key, CASE seq % 10 WHEN 7 THEN '{bad' WHEN 9 THEN "
        "json_object('payload', json_object('before', json_object('id', id), 'op', 'd'))::varchar END AS value, "
        f"{KIND} AS kind FROM {PARTS} WHERE NOT ({HAS_IMAGE})"
    ),
    "cdc_undecodable_rejects": (
        "SELECT cast(o_orderkey AS varchar) AS key, 'undecodable' AS kind FROM orders "
        "WHERE o_orderkey % 5 BETWEEN 1 AND 3"
    ),
    "cdc_undecodable_rows": (
        "SELECT cast(o_orderkey AS varchar) AS id, "
        "cast(CASE WHEN o_orderkey % 5 = 0 THEN -1 END AS decimal(12,2)) AS price, "
        "cast(5 AS integer) AS review_count FROM orders WHERE o_orderkey % 5 IN (0, 4)"
    ),
    "cdc_batch_stream_parity": (
        "SELECT count(*) AS batch_rows, cast(0 AS bigint) AS only_batch, cast(0 AS bigint) AS only_stream "
        f"FROM {PARTS} WHERE {HAS_IMAGE}"
    ),
    "replay_stream": "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders",
    "lake_table_scan": STREAMED,
    "lake_double_view": (
        "SELECT " + ", ".join(
            f"cast(cast({n} AS decimal(12,2)) AS double) AS {n}" if n in DECIMAL_COLUMNS else n
            for n in PRODUCT_COLUMNS
        ) + f" FROM {PARTS} WHERE {HAS_IMAGE}"
    ),
    "lake_partition_prune": f"SELECT id, price, brand FROM {LINES} WHERE brand = 'Brand#1'",
    "lake_adhoc_sql": (
        "SELECT brand, count(*) AS row_count, cast(sum(price) AS decimal(20,2)) AS total_price, "
        f"max(discount) AS max_discount FROM {LINES} GROUP BY brand"
    ),
    "view_passthrough": STREAMED,
    "cdc_field_census": _census(),
    "cdc_routed_rows": STREAMED,
    "cdc_routed_rejects": (
        "SELECT cast(seq AS varchar) AS key, CASE seq % 10 WHEN 7 THEN '{bad' WHEN 9 THEN "
        "json_object('payload', json_object('before', json_object('id', id), 'op', 'd'))::varchar END AS value, "
        f"{KIND} AS kind FROM {PARTS} WHERE NOT ({HAS_IMAGE})"
    ),
    "lake_digest_parity": (
        f"WITH kept AS (SELECT id, brand, seq FROM {PARTS} WHERE {HAS_IMAGE}), "
        "lost AS (SELECT brand FROM kept ORDER BY seq LIMIT 1), twice AS (SELECT brand FROM kept ORDER BY seq DESC LIMIT 1), "
        "sizes AS (SELECT brand, count(*) AS n FROM kept GROUP BY brand) "
        "SELECT brand, n AS left_rows, n - (SELECT count(*) FROM lost WHERE lost.brand IS NOT DISTINCT FROM sizes.brand) "
        "+ (SELECT count(*) FROM twice WHERE twice.brand IS NOT DISTINCT FROM sizes.brand) AS right_rows, 'damaged' AS table "
        "FROM sizes WHERE EXISTS (SELECT 1 FROM (SELECT * FROM lost UNION ALL SELECT * FROM twice) x "
        "WHERE x.brand IS NOT DISTINCT FROM sizes.brand)"
    ),
    "split_predicates": "SELECT count(*) AS row_count, 0::BIGINT AS rows_not_in_one, true AS even FROM lineitem",
    "lake_compacted": (
        "SELECT brand, count(*) AS row_count, cast(sum(price) AS decimal(20,2)) AS total_price, true AS one_file "
        f"FROM ({STREAMED}) GROUP BY brand"
    ),
    "lake_dynamic_prune": (
        f"SELECT id, price, brand FROM {LINES} JOIN nation ON brand = concat('Brand#', n_nationkey) WHERE n_regionkey = 1"
    ),
    "topic_offset_gaps": (
        "SELECT 'sales.public.products' AS topic, \"partition\", first_missing, last_missing, "
        "last_missing - first_missing + 1 AS missing FROM ("
        'SELECT "partition", coalesce(lag("offset") OVER (PARTITION BY "partition" ORDER BY "offset") + 1, 0) AS first_missing, '
        '"offset" - 1 AS last_missing FROM ('
        f"SELECT cast(o_orderkey % 4 AS integer) AS \"partition\", {fx.OFFSET} AS \"offset\" FROM orders WHERE NOT {fx.EXPIRED})) "
        "WHERE first_missing <= last_missing"
    ),
    "avro_schema_projection": (
        "SELECT " + ", ".join(
            f"cast({f.name} AS {_EVENT_CASTS[f.dataType.simpleString()]}) AS {f.name}"
            for f in EVENT if f.name != "product_id"
        ) + f" FROM {PARTS}"
    ),
    "event_schema_by_id": (
        "SELECT cast(own AS varchar) AS product_id, name, cast(CASE own WHEN 0 THEN cast(price AS float) WHEN 1 THEN "
        "trunc(price) ELSE price END AS double) AS price, brand, cast(CASE own WHEN 0 THEN review_count WHEN 2 THEN "
        "CASE WHEN review_count % 3 > 0 THEN review_count END END AS bigint) AS review_count, "
        "CASE WHEN own = 1 THEN 'unknown' ELSE category END AS category "
        f"FROM (SELECT *, product_id % 4 AS own FROM {EVENTS}) WHERE own < 3 AND name IS NOT NULL AND price IS NOT NULL"
    ),
    "event_schema_rejects": (
        "SELECT cast(own AS varchar) AS product_id, CASE WHEN own = 3 THEN 'no schema' ELSE 'null in price' END AS reason, "
        f"count(*) AS row_count FROM (SELECT *, product_id % 4 AS own FROM {EVENTS}) "
        "WHERE own = 3 OR price IS NULL GROUP BY ALL"
    ),
    "envelope_encode": f"SELECT event_id, {_event_json()} AS value FROM {EVENTS}",
    "event_publish": f"SELECT 'product_input' AS topic, {_event_json()} AS value FROM {EVENTS}",
}
