"""The queries of ``queries.py`` written independently as SQL, for a second engine."""

from __future__ import annotations

from tickloom.plans.queries import AS_OF, EARLIER_LOAD, FIRST_LOAD_END
from tickloom.schemas import (
    DECIMAL_COLUMNS,
    LATEST_SCHEMA,
    LEADERS_SCHEMA,
    MOVERS_SCHEMA,
    TABLE_COLUMNS,
    TICKER_FIELDS,
    WIRE_COLUMNS,
)

_NOW = f"TIMESTAMP '{AS_OF}'"


def _decimal(name: str) -> str:
    kind = DECIMAL_COLUMNS[name]
    return f"DECIMAL({kind.precision},{kind.scale})"


def _cast(name: str, source: str | None = None) -> str:
    return f"TRY_CAST(NULLIF({source or name}, '') AS {_decimal(name)})"


def _price(e: str) -> str:
    return f"CAST(CAST({e} AS DECIMAL(20,8)) AS VARCHAR)"


def _bad(place: int, e: str) -> str:
    """The optional number of this place, bad on its own rows."""
    bad = "repeat('9', 30)" if place % 2 else "'junk'"
    return f"CASE WHEN event_id % 211 = {17 * (place + 1)} THEN {bad} ELSE {e} END"


def _bronze(symbol: str, value: str) -> str:
    blank_pct = f"CASE WHEN event_id % 83 = 3 THEN '' ELSE CAST(CAST({value} - 100 AS DECIMAL(20,4)) AS VARCHAR) END"
    return f"""
    SELECT event_id + 1 AS id,
           CASE WHEN event_id % 101 <> 7 THEN {symbol} END AS symbol,
           {_bad(0, _price(f"{value} - 100"))} AS price_change,
           {_bad(1, blank_pct)} AS price_change_pct,
           {_bad(2, _price(value))} AS weighted_avg_price,
           {_bad(3, _price(value))} AS prev_close_price,
           CASE WHEN event_id % 97 = 5 THEN '' WHEN event_id % 89 = 5 THEN 'n/a' ELSE {_price(value)} END AS last_price,
           {_bad(4, _price(value))} AS last_qty,
           {_bad(5, _price(value))} AS bid_price,
           {_bad(6, _price(value))} AS ask_price,
           {_bad(7, _price(f"{value} * 0.95::DOUBLE"))} AS open_price,
           {_bad(8, _price(f"{value} * 1.05::DOUBLE"))} AS high_price,
           {_bad(9, _price(f"{value} * 0.9::DOUBLE"))} AS low_price,
           CASE WHEN event_id % 89 = 5 AND event_id % 2 = 0 THEN 'junk'
                WHEN event_id % 107 = 9 THEN '' ELSE {_price(f"{value} * 10")} END AS volume,
           {_bad(10, _price(f"{value} * {value}"))} AS quote_volume,
           epoch_us(ts) // 1000 - 86400000 AS open_time,
           epoch_us(ts) // 1000 AS close_time,
           event_id % 1000 AS trade_count,
           ts AS ingested_at
    FROM events"""


def _silver(source: str) -> str:
    typed = [
        f"{_cast(c)} AS {c}" if c in DECIMAL_COLUMNS else f"make_timestamp({c} * 1000) AS {c}" if c.endswith("_time") else c
        for c in TABLE_COLUMNS
    ]
    return f"""
    SELECT id, {", ".join(typed)}, ingested_at AS bronze_ingested_at, ingested_at AS transformed_at
    FROM {source}
    WHERE symbol IS NOT NULL AND length(symbol) <= 20
      AND {_cast("last_price")} IS NOT NULL AND {_cast("volume")} IS NOT NULL"""


def _latest(source: str) -> str:
    measures = [c for c in LATEST_SCHEMA.names if c not in ("symbol", "updated_at")]
    return f"""
    SELECT symbol, {", ".join(measures)}, transformed_at AS updated_at
    FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY transformed_at DESC, id DESC) AS rn FROM {source})
    WHERE rn = 1"""


def _board(order: str, key: str, columns: list[str]) -> str:
    carried = ", ".join(c for c in columns if c not in ("rank", "updated_at"))
    return f"""
    SELECT CAST(row_number() OVER (ORDER BY {key} {order}, symbol) AS INTEGER) AS rank, {carried}, {_NOW} AS updated_at
    FROM latest WHERE {key} IS NOT NULL
    ORDER BY {key} {order}, symbol LIMIT 20"""


def _average(name: str, scale: int) -> str:
    """The exact mean in whole units of the last digit, rounded half away from zero; the engine's own is a double."""
    units, n = f"sum(CAST({name} * {10**scale} AS HUGEINT))", f"count({name})"
    rounded = f"sign({units}) * ((2 * abs({units}) + {n}) // (2 * {n}))"
    return f"CAST(CAST({rounded} AS DECIMAL(20,0)) * CAST(0.1 ** {scale} AS DECIMAL(9,{scale})) AS {_decimal(name)})"


def _hourly(source: str, created: str, where: str = "TRUE") -> str:
    return f"""
    SELECT symbol, date_trunc('hour', transformed_at) AS hour,
           min(open_price) AS open_price, max(high_price) AS high_price, min(low_price) AS low_price,
           max(last_price) AS close_price,
           CAST(sum(volume) AS DECIMAL(30,8)) AS total_volume,
           CAST(sum(quote_volume) AS DECIMAL(30,8)) AS total_quote_volume,
           {_average("price_change_pct", 4)} AS avg_price_change_pct,
           CAST(count(*) AS INTEGER) AS record_count, {created} AS created_at
    FROM {source} WHERE {where} GROUP BY symbol, date_trunc('hour', transformed_at)"""


_WIRE_JSON = "CAST(to_json(struct_pack({})) AS VARCHAR)".format(
    ", ".join(f'"{w}" := "{w}"' for w in WIRE_COLUMNS)
)
_BRONZE_JSON = "CAST(to_json(struct_pack({})) AS VARCHAR)".format(
    ", ".join(f'"{c}" := "{c}"' for c in ["id", *TABLE_COLUMNS])
)
_SORTED_JSON = "CAST(to_json(struct_pack({})) AS VARCHAR)".format(
    ", ".join(f'"{w}" := "{w}"' for w in sorted(WIRE_COLUMNS))
)
_WIRE_FIELDS = ", ".join(f'CASE WHEN decode_ok THEN {t} END AS "{w}"' for w, t, _ in TICKER_FIELDS)
_FULL_JSON = "CAST(to_json(struct_pack({})) AS VARCHAR)".format(
    ", ".join(f'"{w}" := {t}' for w, t, _ in TICKER_FIELDS)
)


def _present_json(weighted_last: bool = False) -> str:
    """A tick as JSON without its null fields, which only the symbol can be."""
    price = lambda w, t: "weighted_avg_price" if weighted_last and w == "lastPrice" else t
    rest = ", ".join(f'"{w}" := {price(w, t)}' for w, t, _ in TICKER_FIELDS[1:])
    named = f'"symbol" := symbol, {rest}'
    pack = "CAST(to_json(struct_pack({})) AS VARCHAR)"
    return f"CASE WHEN symbol IS NULL THEN {pack.format(rest)} ELSE {pack.format(named)} END"


_PRESENT_JSON, _PRESENT_FLAT_JSON = _present_json(), _present_json(True)
_MOVERS = MOVERS_SCHEMA.names
_LEADERS = LEADERS_SCHEMA.names

_VIEWS = {
    "bronze": _bronze("concat('SYM', user_id % 50)", "value"),
    "earlier_bronze": _bronze("concat('SYM', user_id % 50 + 25)", "(value + event_id % 7 - 3 + 5)"),
    "wire": f"""
    SELECT ingested_at AS kafka_timestamp, 'ticker' AS topic, CAST((id - 1) % 8 AS INTEGER) AS "partition",
           (id - 1) // 8 AS "offset", decode_ok, value, id, {_WIRE_FIELDS}
    FROM (SELECT *, (id - 1) % 113 <> 11 AS decode_ok,
                 CASE WHEN (id - 1) % 113 = 11 THEN substring({_FULL_JSON}, 1, 20) ELSE {_FULL_JSON} END AS value
          FROM bronze)""",
    "snapshot_documents": f"""
    SELECT concat('{{"fetched_at":"', strftime(ingested_at, '%Y-%m-%dT%H:%M:%SZ'), '","count":2,"tickers":[',
                  {_PRESENT_JSON}, ',', {_PRESENT_FLAT_JSON}, ']}}') AS value
    FROM bronze""",
    "checked": f"""
    SELECT *, CASE WHEN NOT decode_ok THEN 'decode_error' WHEN error_message IS NOT NULL THEN 'validation_error' END
              AS error_type
    FROM (SELECT *, CASE
            WHEN NOT decode_ok THEN 'Value could not be decoded'
            WHEN coalesce(symbol, '') = '' THEN 'Missing required field: ''symbol'''
            WHEN coalesce("lastPrice", '') = '' THEN 'Missing required field: ''lastPrice'''
            WHEN coalesce(volume, '') = '' THEN 'Missing required field: ''volume'''
            WHEN {_cast("last_price", '"lastPrice"')} IS NULL
              THEN concat('Non-numeric price/volume: could not convert string to float: ''', "lastPrice", '''')
            WHEN {_cast("volume")} IS NULL
              THEN concat('Non-numeric price/volume: could not convert string to float: ''', volume, '''') END
            AS error_message FROM wire)""",
    "consumer_rejects": f"""
    SELECT 'consumer' AS source, error_type, error_message,
           CASE WHEN error_type = 'decode_error' THEN base64(encode(value)) ELSE {_WIRE_JSON} END AS raw_payload,
           topic AS kafka_topic, "partition" AS kafka_partition, "offset" AS kafka_offset,
           kafka_timestamp AS occurred_at
    FROM checked WHERE error_type IS NOT NULL""",
    "dlq_rows": f"""
    SELECT 'dlq_consumer' AS source, error_type, error_message,
           CASE WHEN error_type = 'decode_error' THEN concat('"', base64(encode(value)), '"') ELSE {_SORTED_JSON} END
             AS raw_payload,
           topic AS kafka_topic, "partition" AS kafka_partition, "offset" AS kafka_offset, {_NOW} AS occurred_at
    FROM checked WHERE error_type IS NOT NULL
    UNION ALL
    SELECT 'dlq_consumer', 'dlq_parse_error', 'Dead-letter value is not a JSON object', base64(encode(text)),
           NULL, CAST(turn AS INTEGER), conv_id, {_NOW}
    FROM conversations""",
    "letters": """
    SELECT DISTINCT 'ticker-dlq' AS topic, kafka_partition AS "partition", kafka_offset AS "offset",
           kafka_offset // 100 % 2 = 0 OR kafka_offset % 3 = 0 AS stored FROM dlq_rows""",
    "silver": _silver("bronze"),
    "earlier_silver": _silver("earlier_bronze"),
    "silver_rejects": f"""
    SELECT 'transformer' AS source,
           CASE WHEN symbol IS NULL OR coalesce(last_price, '') = '' OR coalesce(volume, '') = ''
                THEN 'validation_error' ELSE 'cast_error' END AS error_type,
           CASE WHEN symbol IS NULL THEN 'Missing required field: ''symbol'''
                WHEN coalesce(last_price, '') = '' THEN 'Missing required field: ''last_price'''
                WHEN coalesce(volume, '') = '' THEN 'Missing required field: ''volume'''
                WHEN {_cast("last_price")} IS NULL
                  THEN concat('Cannot cast last_price to DECIMAL(20,8): ''', last_price, '''')
                ELSE concat('Cannot cast volume to DECIMAL(30,8): ''', volume, '''') END AS error_message,
           {_BRONZE_JSON} AS raw_payload, CAST(NULL AS VARCHAR) AS kafka_topic,
           CAST(NULL AS INTEGER) AS kafka_partition, CAST(NULL AS BIGINT) AS kafka_offset, ingested_at AS occurred_at
    FROM bronze
    WHERE symbol IS NULL OR {_cast("last_price")} IS NULL OR {_cast("volume")} IS NULL""",
    "error_log": """
    SELECT * FROM consumer_rejects UNION ALL SELECT * FROM silver_rejects UNION ALL SELECT * FROM dlq_rows""",
    "latest": _latest("silver"),
    "earlier_latest": _latest("earlier_silver"),
    "gainers": _board("DESC", "price_change_pct", _MOVERS),
    "losers": _board("ASC", "price_change_pct", _MOVERS),
    "leaders": _board("DESC", "quote_volume", _LEADERS),
    "hourly": _hourly("silver", _NOW),
    "earlier_hourly": _hourly("earlier_silver", f"TIMESTAMP '{EARLIER_LOAD}'"),
    "windows": f"""
    SELECT symbol, w AS window_start, w + INTERVAL 5 MINUTE AS window_end,
           {_average("last_price", 8)} AS avg_price, max(high_price) AS max_price,
           min(low_price) AS min_price, CAST(sum(volume) AS DECIMAL(30,8)) AS total_volume,
           {_average("price_change_pct", 4)} AS avg_price_change_pct, count(*) AS record_count,
           {_NOW} AS computed_at
    FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, close_time) AS w FROM silver) GROUP BY symbol, w""",
}


def _band(steps: str) -> str:
    return f"CASE WHEN price_change_pct IS NULL THEN NULL {steps} END"


_GAINER = _band("WHEN price_change_pct >= 2 THEN 'green' ELSE 'yellow'")
_LOSER = _band("WHEN price_change_pct >= -2 THEN 'yellow' ELSE 'red'")
_LEADER = _band("WHEN price_change_pct >= 2 THEN 'green' WHEN price_change_pct >= 0 THEN 'yellow' ELSE 'red'")
_MEASURES = [c for c in LATEST_SCHEMA.names if c != "symbol"]
_FIELDS = ", ".join(f'"{w}"' for w in WIRE_COLUMNS)
_FLAT = ", ".join(f'{"weighted_avg_price" if w == "lastPrice" else t} AS "{w}"' for w, t, _ in TICKER_FIELDS)
_PLAIN = ", ".join(f'{t} AS "{w}"' for w, t, _ in TICKER_FIELDS)
_ENCODABLE = 'symbol IS NOT NULL AND "lastPrice" IS NOT NULL AND volume IS NOT NULL'
_RECENT = f"{_NOW} - INTERVAL 10 MINUTE"
_DAY = f"{_NOW} - INTERVAL 24 HOUR"


def _counted(name: str) -> str:
    return f"(SELECT count(*) FROM {name})"


def _per_minute(source: str, ts: str, label: str) -> str:
    return f"""SELECT date_trunc('minute', {ts}) AS "time", count(*) AS "{label}"
    FROM {source} WHERE {ts} >= {_DAY} GROUP BY 1 ORDER BY 1"""


_SELECTS = {
    "decode_json": f"""SELECT kafka_timestamp, topic, "partition", "offset", {_FIELDS}, decode_ok FROM wire""",
    "decode_rejects": "SELECT * FROM consumer_rejects WHERE error_type = 'decode_error'",
    "snapshot_explode": f"""
    SELECT strftime(ingested_at, '%Y-%m-%dT%H:%M:%SZ') AS fetched_at, {_PLAIN} FROM bronze
    UNION ALL SELECT strftime(ingested_at, '%Y-%m-%dT%H:%M:%SZ') AS fetched_at, {_FLAT} FROM bronze""",
    "snapshot_rejects": f"""
    SELECT 'producer' AS source, 'snapshot_parse_error' AS error_type,
           concat('File is not a snapshot document: snapshots/', n, ' from byte 0') AS error_message,
           base64(encode(CASE n WHEN 3 THEN substring(value, 1, 60) ELSE concat(value, ']') END)) AS raw_payload,
           CAST(NULL AS VARCHAR) AS kafka_topic, CAST(NULL AS INTEGER) AS kafka_partition,
           CAST(NULL AS BIGINT) AS kafka_offset, {_NOW} AS occurred_at
    FROM (SELECT value, length(value) % 29 AS n FROM snapshot_documents) WHERE n IN (3, 5)""",
    "landing_rejects": f"""
    SELECT 'producer' AS source, 'landing_parse_error' AS error_type,
           concat('Line is not a ticker object: landing/', "partition", ' from byte ', "offset") AS error_message,
           base64(encode(value)) AS raw_payload, CAST(NULL AS VARCHAR) AS kafka_topic,
           CAST(NULL AS INTEGER) AS kafka_partition, CAST(NULL AS BIGINT) AS kafka_offset, {_NOW} AS occurred_at
    FROM wire WHERE NOT decode_ok""",
    "landing_tickers": f"SELECT {_FIELDS} FROM wire WHERE decode_ok",
    "snapshot_header": f"""SELECT strftime({_NOW}, '%Y-%m-%dT%H:%M:%SZ') AS fetched_at, count(*) AS "count" FROM wire""",
    "normalize_ticker": "SELECT {} FROM wire".format(
        ", ".join(
            f"""coalesce("{w}", '{"" if w == "symbol" else "0"}') AS "{w}" """ if w in ("symbol", "lastPrice", "volume") else f'"{w}"'
            for w in WIRE_COLUMNS
        )
    ),
    "publish_payload": f'SELECT symbol AS "key", {_WIRE_JSON} AS "value" FROM wire WHERE {_ENCODABLE}',
    "publish_rejects": f"""
    SELECT 'producer' AS source, 'encode_error' AS error_type,
           CASE WHEN symbol IS NULL THEN 'Null in required field: ''symbol'''
                WHEN "lastPrice" IS NULL THEN 'Null in required field: ''lastPrice'''
                ELSE 'Null in required field: ''volume''' END AS error_message,
           {_WIRE_JSON} AS raw_payload, CAST(NULL AS VARCHAR) AS kafka_topic,
           CAST(NULL AS INTEGER) AS kafka_partition, CAST(NULL AS BIGINT) AS kafka_offset, {_NOW} AS occurred_at
    FROM wire WHERE NOT ({_ENCODABLE})""",
    "publish_tallies": f"""SELECT count(*) FILTER (WHERE {_ENCODABLE}) AS sent,
    count(*) FILTER (WHERE NOT ({_ENCODABLE})) AS errors FROM wire""",
    "bronze_valid": "SELECT id, {}, kafka_timestamp AS ingested_at FROM checked WHERE error_type IS NULL".format(
        ", ".join(f'"{w}" AS {t}' for w, t, _ in TICKER_FIELDS)
    ),
    "bronze_rejects": "SELECT * FROM consumer_rejects WHERE error_type = 'validation_error'",
    "ingest_tallies": """SELECT count(*) AS total, count(*) FILTER (WHERE error_type IS NOT NULL) AS rejected,
    count(*) FILTER (WHERE error_type IS NULL) AS sent FROM checked""",
    "dlq_payload": """
    SELECT concat_ws('-', kafka_topic, kafka_partition, kafka_offset) AS "key",
           concat('{"error_type":"', error_type, '","error_message":"', error_message, '","original_topic":"',
                  kafka_topic, '","offset":', kafka_offset, ',"payload":',
                  CASE WHEN error_type = 'decode_error' THEN concat('"', raw_payload, '"') ELSE raw_payload END, '}')
             AS "value"
    FROM consumer_rejects""",
    "dlq_to_error_log": "SELECT * FROM dlq_rows",
    "dlq_insert_absent": """
    SELECT error_type, source, kafka_topic, kafka_partition, kafka_offset FROM dlq_rows WHERE kafka_offset % 3 <> 0""",
    "dlq_intervals": """
    SELECT topic, "partition", min("offset") AS "first", max("offset") AS "last"
    FROM (SELECT *, "offset" - row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS island FROM letters WHERE stored)
    GROUP BY topic, "partition", island""",
    "dlq_replayed": """SELECT topic, "partition", "offset" FROM letters WHERE NOT stored""",
    "silver_typed": "SELECT * FROM silver",
    "silver_rejects": "SELECT * FROM silver_rejects",
    "silver_incremental": f"""
    SELECT * FROM silver
    WHERE id > (SELECT coalesce(max(id), 0) FROM bronze WHERE ingested_at < TIMESTAMP '{FIRST_LOAD_END}')""",
    "next_watermark": "SELECT coalesce(max(id), 0) AS id FROM bronze",
    "cast_failures": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE NULLIF({c}, '') IS NOT NULL AND {_cast(c)} IS NULL)
        AS failures FROM bronze"""
        for c in DECIMAL_COLUMNS
    ),
    "latest_prices": "SELECT * FROM latest",
    "latest_upsert": """
    SELECT * FROM latest
    UNION ALL SELECT * FROM earlier_latest e WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.symbol = e.symbol)""",
    "latest_refresh": f"""
    SELECT symbol, {", ".join(_MEASURES)}
    FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY updated_at DESC, fresh DESC) AS rn
          FROM (SELECT *, 0 AS fresh FROM earlier_latest UNION ALL SELECT *, 1 AS fresh FROM latest))
    WHERE rn = 1""",
    "top_gainers": "SELECT * FROM gainers",
    "top_losers": "SELECT * FROM losers",
    "volume_leaders": "SELECT * FROM leaders",
    "hourly_summary": _hourly(
        "silver",
        _NOW,
        f"transformed_at >= date_trunc('hour', {_NOW}) - INTERVAL 2 HOUR AND transformed_at < date_trunc('hour', {_NOW})",
    ),
    "hourly_history": "SELECT * FROM hourly",
    "hourly_upsert": """
    SELECT coalesce(o.symbol, n.symbol) AS symbol, coalesce(o.hour, n.hour) AS hour,
           CASE WHEN o.symbol IS NOT NULL THEN o.open_price ELSE n.open_price END AS open_price,
           greatest(o.high_price, n.high_price) AS high_price, least(o.low_price, n.low_price) AS low_price,
           CASE WHEN n.symbol IS NOT NULL THEN n.close_price ELSE o.close_price END AS close_price,
           CASE WHEN n.symbol IS NOT NULL THEN n.total_volume ELSE o.total_volume END AS total_volume,
           CASE WHEN n.symbol IS NOT NULL THEN n.total_quote_volume ELSE o.total_quote_volume END AS total_quote_volume,
           CASE WHEN n.symbol IS NOT NULL THEN n.avg_price_change_pct ELSE o.avg_price_change_pct END
             AS avg_price_change_pct,
           CASE WHEN n.symbol IS NOT NULL THEN n.record_count ELSE o.record_count END AS record_count,
           CASE WHEN o.symbol IS NOT NULL THEN o.created_at ELSE n.created_at END AS created_at
    FROM earlier_hourly o FULL OUTER JOIN hourly n ON o.symbol = n.symbol AND o.hour = n.hour""",
    "hourly_merged": "SELECT * FROM hourly",
    "window_5m": "SELECT * FROM windows",
    "window_5m_merged": "SELECT * FROM windows",
    "recent_bronze": f"SELECT count(*) AS new_rows FROM bronze WHERE ingested_at >= {_RECENT}",
    "silver_quality": f"""
    SELECT count(*) AS total, count(*) FILTER (WHERE last_price IS NULL) AS null_prices,
           count(*) FILTER (WHERE symbol IS NULL) AS null_symbols, count(*) FILTER (WHERE volume IS NULL) AS null_volumes
    FROM silver WHERE transformed_at >= {_RECENT}""",
    "gold_counts": f"""SELECT {_counted("latest")} AS latest, {_counted("gainers")} AS gainers,
    {_counted("losers")} AS losers, {_counted("leaders")} AS volume""",
    "errors_by_type": "SELECT error_type, count(*) AS cnt FROM error_log GROUP BY error_type ORDER BY cnt DESC, 1",
    "recent_errors_by_type": f"""SELECT error_type, count(*) AS cnt FROM error_log
    WHERE occurred_at >= {_RECENT} GROUP BY error_type ORDER BY cnt DESC, 1""",
    "health_snapshot": f"""SELECT {_NOW} AS checked_at, {_counted("bronze")} AS bronze_count,
    {_counted("silver")} AS silver_count, {_counted("latest")} AS gold_count, {_counted("error_log")} AS error_count,
    (SELECT count(*) FROM error_log WHERE source = 'dlq_consumer') AS dlq_count""",
    "quality_gates": f"""
    SELECT gate, value, CAST(threshold AS BIGINT) AS threshold,
           CASE WHEN at_most THEN value <= threshold ELSE value >= threshold END AS passed
    FROM (SELECT 'bronze_fresh' AS gate, (SELECT count(*) FROM bronze WHERE ingested_at >= {_RECENT}) AS value,
                 1 AS threshold, FALSE AS at_most
          UNION ALL SELECT 'silver_rows', (SELECT count(*) FROM silver WHERE transformed_at >= {_RECENT}), 1, FALSE
          UNION ALL SELECT 'silver_null_symbols',
                 (SELECT count(*) FROM silver WHERE transformed_at >= {_RECENT} AND symbol IS NULL), 0, TRUE
          UNION ALL SELECT 'gold_filled', {_counted("latest")}, 1, FALSE
          UNION ALL SELECT 'recent_errors', (SELECT count(*) FROM error_log WHERE occurred_at >= {_RECENT}), 100, TRUE)""",
    "layer_counts": f"""SELECT 'bronze' AS layer, {_counted("bronze")} AS "count"
    UNION ALL SELECT 'silver', {_counted("silver")} UNION ALL SELECT 'gold', {_counted("latest")}""",
    "last_refresh": "SELECT max(updated_at) AS value FROM latest",
    "bronze_per_minute": _per_minute("bronze", "ingested_at", "Bronze"),
    "silver_per_minute": _per_minute("silver", "transformed_at", "Silver"),
    "gainers_panel": f'SELECT symbol, price_change_pct AS "Change %", {_GAINER} AS band FROM gainers ORDER BY rank',
    "losers_panel": f'SELECT symbol, price_change_pct AS "Change %", {_LOSER} AS band FROM losers ORDER BY rank',
    "leaders_panel": f"""SELECT rank AS "#", symbol AS "Symbol", last_price AS "Price",
    quote_volume AS "Quote Volume", price_change_pct AS "Change %", trade_count AS "Trades", updated_at AS "Updated",
    {_LEADER} AS band FROM leaders ORDER BY rank""",
    "gainers_top10": "SELECT symbol, price_change_pct, last_price FROM gainers ORDER BY rank LIMIT 10",
    "leaders_top10": "SELECT symbol, quote_volume, last_price FROM leaders ORDER BY rank LIMIT 10",
    "hourly_top10": f"""SELECT hour AS "time", symbol, total_volume AS "Volume" FROM hourly
    WHERE symbol IN (SELECT symbol FROM leaders WHERE rank <= 10) AND hour >= {_DAY} ORDER BY hour, symbol""",
    "window_5m_latest10": "SELECT * FROM windows ORDER BY computed_at DESC, window_start DESC, symbol LIMIT 10",
    "change_bands": f"""SELECT symbol, price_change_pct, {_GAINER} AS gainer_band, {_LOSER} AS loser_band,
    {_LEADER} AS leader_band FROM latest""",
}

_WITH = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in _VIEWS.items())

EXPECTED_SQL = {name: f"{_WITH}\n{select}" for name, select in _SELECTS.items()}
