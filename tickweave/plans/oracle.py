"""Shared pieces of the checking SQL (DuckDB dialect), written apart from the Spark code."""

from __future__ import annotations

DAY_US, HOUR_US = 86_400_000_000, 3_600_000_000

BASE = """base AS (
  SELECT event_type AS instrument, event_id AS trade_id, ts AS event_time, event_id, user_id,
         CAST(value AS DECIMAL(18,2)) AS price, CAST(json_extract_string(props, '$.k') AS DECIMAL(18,0)) AS qty,
         CASE WHEN user_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side,
         event_id + CASE WHEN event_id % 7 = 0 THEN 400 ELSE 0 END AS off, 0 AS dup
  FROM events)"""

TAPE = BASE + """, tape AS (
  SELECT * FROM base UNION ALL
  SELECT instrument, trade_id, event_time, event_id, user_id, price, qty, side, off + 5, 1
  FROM base WHERE trade_id % 11 = 0)"""

ORDER = "off, dup, trade_id"


def window_start(ts: str, size_us: int) -> str:
    return f"make_timestamp(epoch_us({ts}) - epoch_us({ts}) % {size_us})"


def vwap(notional: str, volume: str, decimals: int = 6) -> str:
    """Half-up quotient to six decimals in whole numbers: notional has two decimals, volume none."""
    scale = 10 ** (decimals - 2)
    cents = f"(CAST({notional} * 100 AS HUGEINT) * {scale})"
    return (f"CASE WHEN {volume} = 0 THEN 0.0 ELSE CAST(({cents} * 2 + CAST({volume} AS HUGEINT)) // "
            f"(2 * CAST({volume} AS HUGEINT)) AS DOUBLE) / {10 ** decimals} END")


def uuid3(name: str) -> str:
    h = f"md5({name})"
    return (f"concat(substr({h},1,8), '-', substr({h},9,4), '-3', substr({h},14,3), '-', "
            f"translate(substr({h},17,1), '0123456789abcdef', '89ab89ab89ab89ab'), substr({h},18,3), '-', "
            f"substr({h},21,12))")


def marked(source: str = "base", size_us: int = DAY_US, grace_us: int = HOUR_US) -> str:
    return f"""timed AS (
  SELECT *, {window_start('event_time', size_us)} AS window_start,
         make_timestamp(epoch_us(event_time) - epoch_us(event_time) % {size_us} + {size_us}) AS window_end,
         max(event_time) OVER (PARTITION BY instrument ORDER BY {ORDER} ROWS UNBOUNDED PRECEDING) AS stream_time
  FROM {source}), marked AS (
  SELECT *, epoch_us(window_end) + {grace_us} <= epoch_us(stream_time) AS late FROM timed)"""


def candles(source: str = "marked", keys: str = "instrument, window_start, window_end",
            where: str = "NOT late", name: str = "candles", extra: str = "") -> str:
    return f"""{name} AS (
  SELECT {keys},
         CAST(first(price ORDER BY {ORDER}) AS DECIMAL(38,2)) AS open, CAST(max(price) AS DECIMAL(38,2)) AS high,
         CAST(min(price) AS DECIMAL(38,2)) AS low, CAST(last(price ORDER BY {ORDER}) AS DECIMAL(38,2)) AS close,
         CAST(sum(qty) AS DECIMAL(38,2)) AS volume, CAST(sum(price * qty) AS DECIMAL(38,2)) AS quote_volume,
         CAST(sum(CASE WHEN side = 'BUY' THEN qty ELSE 0 END) AS DECIMAL(38,2)) AS buy_volume,
         CAST(sum(CASE WHEN side = 'SELL' THEN qty ELSE 0 END) AS DECIMAL(38,2)) AS sell_volume,
         count(*) AS trade_count{extra}
  FROM {source} WHERE {where} GROUP BY {keys})"""


def final_candles(source: str = "base", size_us: int = DAY_US, grace_us: int = HOUR_US) -> str:
    """CTEs up to ``finality``: candles with ``is_final``."""
    return f"""{marked(source, size_us, grace_us)}, {candles()},
clock AS (SELECT instrument, max(event_time) AS clock FROM {source} GROUP BY instrument),
finality AS (
  SELECT c.*, epoch_us(c.window_end) + {grace_us} <= epoch_us(k.clock) AS is_final
  FROM candles c JOIN clock k USING (instrument))"""


CANDLE_COLUMNS = ("instrument, window_start, window_end, open, high, low, close, volume, quote_volume, "
                  + vwap("quote_volume", "volume") + " AS vwap, buy_volume, sell_volume, trade_count")

# What each frame must become, worked out from the event and its fault code alone.
EXPECTED = """coded AS (
  SELECT event_id, event_type, user_id, ts, event_id % 50 AS code, CAST(value AS DECIMAL(18,2)) AS price,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(18,0)) AS qty,
         CASE WHEN user_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side, date_trunc('millisecond', ts) AS ts_ms,
         date_trunc('millisecond', ts + INTERVAL 50 MILLISECONDS) AS received_at
  FROM events),
items AS (
  SELECT *, 0 AS ordinal FROM coded UNION ALL
  SELECT event_id, event_type, user_id, ts, code, price, qty, CASE WHEN side = 'BUY' THEN 'SELL' ELSE 'BUY' END,
         ts_ms, received_at, 1 FROM coded WHERE code = 21),
judged AS (
  SELECT *, CASE WHEN code IN (1, 19) THEN 'dead'
      WHEN code IN (2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 20, 23, 26) THEN 'invalid'
      WHEN qty = 0 AND code <> 24 THEN 'invalid' ELSE 'trade' END AS route,
    CASE WHEN code IN (1, 19) THEN NULL WHEN code IN (2, 26) THEN 'UNKNOWN_TYPE'
      WHEN code IN (3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 20) THEN 'SCHEMA_INVALID'
      WHEN code = 23 OR (qty = 0 AND code <> 24) THEN 'IMPOSSIBLE_STATE' END AS reason,
    regexp_replace(CAST(price AS VARCHAR), '\\.?0+$', '') AS shown_price,
    upper(event_type) AS symbol
  FROM items),
expected AS (
  SELECT *, CASE WHEN route <> 'invalid' THEN NULL
      WHEN code = 2 THEN 'channel=ticker' WHEN code = 26 THEN 'channel=null'
      WHEN code IN (3, 20) THEN 'trade frame has no data array'
      WHEN code IN (4, 5, 6) THEN 'trade at index 0 has no symbol'
      WHEN code = 7 THEN 'unusable symbol ''A|B'': instrument must not contain ''|'': ''A|B'''
      WHEN code = 8 THEN 'unknown side ''hold''' WHEN code = 9 THEN 'unknown side ''null'''
      WHEN code IN (10, 11, 12) THEN 'price or qty missing or not numeric'
      ELSE concat('non-positive price or quantity: ', CASE WHEN code = 23 THEN '-' ELSE '' END,
                  CASE WHEN code = 13 THEN CAST(price AS VARCHAR) ELSE shown_price END, ' @ ', CAST(qty AS VARCHAR))
      END AS detail,
    CASE WHEN code IN (16, 17, 18) OR ts_ms < received_at - INTERVAL 24 HOURS THEN 'INGESTION_FALLBACK'
         ELSE 'EXCHANGE' END AS event_time_source,
    CASE WHEN code IN (16, 17, 18) THEN received_at ELSE ts_ms END AS event_time,
    CASE WHEN code = 24 THEN CAST(0 AS DECIMAL(18,0)) ELSE qty END AS quantity
  FROM judged),
trades AS (
  SELECT *, CASE WHEN code IN (14, 15) OR ordinal = 1 THEN concat('c:', symbol, ':',
        CAST(epoch_ms(event_time) AS VARCHAR), ':', CAST(CAST(price AS DECIMAL(38,18)) AS VARCHAR), ':',
        CAST(CAST(quantity AS DECIMAL(38,18)) AS VARCHAR), ':', side, ':', CAST(ordinal AS VARCHAR))
      ELSE CAST(event_id AS VARCHAR) END AS trade_id
  FROM expected WHERE route = 'trade')"""


def half_up(numerator: str, denominator: str, decimals: int = 6) -> str:
    """Quotient of whole numbers, halves away from zero, as a double."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return (f"CASE WHEN {d} = 0 THEN 0.0 ELSE sign({n}) * CAST((abs({n}) * {2 * 10 ** decimals} + {d}) // (2 * {d}) AS DOUBLE)"
            f" / {10 ** decimals} END")


STALE_MS, RESYNC_MS, ANSWER_MS, REQUESTS = 3_600_000, 7_200_000, 10_800_000, 3


def _failed(asked: str, now: str) -> str:
    """Requests made from ``asked`` on that have failed by ``now``: one for each whole span that lies before it."""
    return f"greatest(0, least({REQUESTS}, CAST(ceil(({now} - {asked}) / {ANSWER_MS}.0) AS BIGINT) - 1))"


def _settled(kind: str, tries: str, asked: str, now: str) -> str:
    return (f"CASE WHEN {kind} = 'RESET' THEN 'UNINITIALISED' WHEN {kind} = 'SNAP' AND {tries} < 3 THEN 'LOADING_SNAPSHOT'"
            f" WHEN {_failed(asked, now)} >= {REQUESTS} THEN 'INVALID' ELSE 'RESYNCHRONISING' END")


# Book messages of the events, and the state each leaves its book in.
BOOK = f"""msgs AS (
  SELECT event_id AS n, CASE WHEN event_type = 'signup' AND ts >= TIMESTAMP '2024-01-28' THEN 'purchase' ELSE event_type END AS instrument,
         ts, epoch_us(ts) // 1000 AS t, user_id % 14 AS shift, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE WHEN event_id % 1999 = 7 THEN 'RESET' WHEN event_id % 211 = 0 THEN 'SNAPSHOT' ELSE 'UPDATE' END AS kind,
         event_id % 401 = 0 OR event_id % 633 = 0 AS wrong, event_id % 769 = 3 AS unchecked,
         CASE WHEN event_id % 2 = 0 THEN 'BID' ELSE 'ASK' END AS side,
         event_id % 953 = 11 AS crosses, event_id % 877 = 5 AS negative, event_id % 1201 = 13 AS skips FROM events),
numbered AS (
  SELECT *, sum(CASE WHEN kind <> 'UPDATE' THEN 1 ELSE 0 END) OVER log AS epoch,
         sum(CASE WHEN kind = 'SNAPSHOT' THEN 1 ELSE 0 END) OVER log AS snapshots,
         row_number() OVER log AS place, lag(t) OVER log AS before_t, t - lag(t) OVER log AS gap_ms,
         CASE WHEN kind = 'UPDATE' AND (crosses OR negative) THEN 'IMPOSSIBLE_STATE'
              WHEN kind = 'UPDATE' AND skips AND lag(t) OVER log IS NOT NULL THEN 'SEQUENCE_GAP'
              WHEN kind <> 'RESET' AND (wrong OR unchecked) THEN 'CHECKSUM_MISMATCH' END AS trouble
  FROM msgs WINDOW log AS (PARTITION BY instrument ORDER BY n)),
broken AS (
  SELECT *, CASE WHEN kind = 'RESET' THEN 'RESET' WHEN kind = 'SNAPSHOT' AND trouble IS NOT NULL THEN 'SNAP'
      WHEN kind = 'UPDATE' AND gap_ms > {RESYNC_MS} THEN 'LONG' WHEN trouble IS NOT NULL THEN 'FAULT' END AS brk FROM numbered),
firsts AS (
  SELECT *, min(CASE WHEN brk IS NOT NULL THEN n END) OVER (PARTITION BY instrument, epoch) AS first_n,
         snapshots - coalesce(max(CASE WHEN kind = 'SNAPSHOT' AND trouble IS NULL THEN snapshots END) OVER (
           PARTITION BY instrument ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS tries FROM broken),
kinds AS (
  SELECT *, max(CASE WHEN n = first_n THEN brk END) OVER (PARTITION BY instrument, epoch) AS first_kind,
    max(CASE WHEN n = first_n THEN CASE WHEN brk = 'LONG' THEN before_t + {RESYNC_MS} ELSE t END END) OVER (PARTITION BY instrument, epoch) AS asked FROM firsts),
settled AS (
  SELECT *, CASE WHEN epoch = 0 THEN 'UNINITIALISED' WHEN first_n IS NULL OR n < first_n THEN 'LIVE'
    ELSE {_settled('first_kind', 'tries', 'asked', 't')} END AS rests,
    CASE WHEN epoch > 0 AND n >= first_n AND first_kind <> 'RESET' AND (first_kind <> 'SNAP' OR tries >= 3) THEN asked END AS asked_t,
    epoch > 0 AND n = first_n AND brk <> 'RESET' AS broke FROM kinds),
states AS (
  SELECT *, CASE WHEN broke AND (brk = 'FAULT' OR (brk = 'SNAP' AND tries >= 3)) THEN 'INVALID' ELSE rests END AS book_state,
    coalesce(lag(rests) OVER (PARTITION BY instrument ORDER BY n), 'UNINITIALISED') AS was,
    lag(asked_t) OVER (PARTITION BY instrument ORDER BY n) AS was_asked FROM settled),
changes AS (
  SELECT n, instrument, epoch, 'BID' AS side, 50 + shift AS price, 1 + k % 9 AS qty, 0 AS pos FROM numbered WHERE kind = 'SNAPSHOT'
  UNION ALL SELECT n, instrument, epoch, 'BID', 45, 3, 1 FROM numbered WHERE kind = 'SNAPSHOT'
  UNION ALL SELECT n, instrument, epoch, 'ASK', 110 + shift, 1 + k % 9, 0 FROM numbered WHERE kind = 'SNAPSHOT'
  UNION ALL SELECT n, instrument, epoch, 'ASK', 155, 3, 1 FROM numbered WHERE kind = 'SNAPSHOT'
  UNION ALL SELECT n, instrument, epoch, side,
    CASE WHEN crosses THEN CASE side WHEN 'BID' THEN 200 ELSE 10 END WHEN side = 'BID' THEN 50 + shift ELSE 110 + shift END,
    CASE WHEN crosses THEN 5 WHEN negative THEN -2 ELSE k % 10 END, 0 FROM numbered WHERE kind = 'UPDATE'),
held AS (
  SELECT s.n, s.instrument, c.side, c.price, c.qty, row_number() OVER (
    PARTITION BY s.n, c.side, c.price ORDER BY c.n DESC, c.pos DESC) AS age
  FROM numbered s JOIN changes c ON s.instrument = c.instrument AND s.epoch = c.epoch AND c.n <= s.n),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n, side ORDER BY CASE WHEN side = 'BID' THEN -price ELSE price END) AS level
  FROM held WHERE age = 1 AND qty > 0),
tops AS (
  SELECT n, instrument, max(price) FILTER (WHERE side = 'BID') AS bid, min(price) FILTER (WHERE side = 'ASK') AS ask,
    max(qty) FILTER (WHERE side = 'BID' AND level = 1) AS bid_qty, max(qty) FILTER (WHERE side = 'ASK' AND level = 1) AS ask_qty,
    coalesce(sum(qty) FILTER (WHERE side = 'BID' AND level <= 10), 0) AS bid_depth,
    coalesce(sum(qty) FILTER (WHERE side = 'ASK' AND level <= 10), 0) AS ask_depth
  FROM (SELECT n FROM states WHERE book_state = 'LIVE') JOIN ranked USING (n) GROUP BY 1, 2)"""

# CRC-32, byte by byte through its table of 256 remainders.
CRC = """crc_table AS (
  SELECT list(v ORDER BY i) AS entries FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM (SELECT range::bigint AS i FROM range(256)))),
book_texts AS (
  SELECT m.n, coalesce(string_agg(concat(price * 100, qty * 1000), '' ORDER BY r.side, level) FILTER (WHERE level <= 10), '') AS body
  FROM msgs m LEFT JOIN ranked r ON r.n = m.n GROUP BY m.n),
checksums AS (
  SELECT n, xor(list_reduce(list_concat([4294967295::bigint], [ascii(c)::bigint FOR c IN string_split(body, '') IF c <> '']),
    lambda c, b: xor(c // 256, entries[xor(c % 256, b) + 1])), 4294967295) AS crc FROM book_texts, crc_table)"""

# What moves a book: the silence before a message (or before the end of the log), then the message.
MOVES = f"""log_end AS (SELECT max(t) AS end_t FROM msgs),
spans AS (
  SELECT instrument, was, was_asked, before_t, t, n, kind, trouble, book_state, rests FROM states
  UNION ALL SELECT instrument, rests, asked_t, t, end_t, NULL, NULL, NULL, NULL, NULL
  FROM states, log_end WHERE n IN (SELECT max(n) FROM states GROUP BY instrument)),
quiet AS (
  SELECT *, was = 'LIVE' AND coalesce(t - before_t > {STALE_MS}, false) AS stale, was = 'LIVE' AND coalesce(t - before_t > {RESYNC_MS}, false) AS left_alone,
    CASE WHEN was = 'LIVE' AND t - before_t > {RESYNC_MS} THEN before_t + {RESYNC_MS} WHEN was = 'RESYNCHRONISING' THEN was_asked END AS waiting FROM spans),
waits AS (
  SELECT *, CASE WHEN waiting IS NULL THEN 0 ELSE {_failed('waiting', 't')} END AS failed,
    CASE WHEN waiting IS NULL OR left_alone THEN 0 ELSE {_failed('waiting', 'before_t')} END AS failed_before FROM quiet),
arrived AS (
  SELECT *, CASE WHEN waiting IS NOT NULL THEN CASE WHEN failed >= {REQUESTS} THEN 'INVALID' ELSE 'RESYNCHRONISING' END
    WHEN stale THEN 'STALE' ELSE was END AS came FROM waits),
tries_over AS (SELECT *, unnest(range(failed_before + 1, failed + 1)) AS try FROM arrived),
steps AS (
  SELECT *, kind = 'SNAPSHOT' AND NOT (came IN ('LIVE', 'STALE') AND book_state = 'LIVE') AS loads FROM arrived WHERE n IS NOT NULL),
moves AS (
  SELECT instrument, before_t + {STALE_MS} AS at_ms, 'LIVE' AS from_state, 'STALE' AS to_state FROM arrived WHERE stale
  UNION ALL SELECT instrument, before_t + {RESYNC_MS}, 'STALE', 'RESYNCHRONISING' FROM arrived WHERE left_alone
  UNION ALL SELECT instrument, waiting + try * {ANSWER_MS}, 'RESYNCHRONISING', 'INVALID' FROM tries_over
  UNION ALL SELECT instrument, waiting + try * {ANSWER_MS}, 'INVALID', 'RESYNCHRONISING' FROM tries_over WHERE try < {REQUESTS}
  UNION ALL SELECT instrument, t, came, 'LOADING_SNAPSHOT' FROM steps WHERE loads AND (came <> 'LOADING_SNAPSHOT' OR book_state = 'LOADING_SNAPSHOT')
  UNION ALL SELECT instrument, t, 'LOADING_SNAPSHOT', book_state FROM steps WHERE loads AND book_state <> 'LOADING_SNAPSHOT'
  UNION ALL SELECT instrument, t, came, book_state FROM steps WHERE NOT loads AND came <> book_state
  UNION ALL SELECT instrument, t, 'INVALID', 'RESYNCHRONISING' FROM steps WHERE book_state = 'INVALID' AND rests = 'RESYNCHRONISING')"""
