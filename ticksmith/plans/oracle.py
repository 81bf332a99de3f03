"""DuckDB oracle SQL for the registered queries.

Each statement computes the expected result straight from the driver's
tables with plain SQL, following the fixture rules of
``ticksmith.plans.fixtures`` (document = day + chunk of 500 event ids,
symbol = event type, one bar per event).
"""

from __future__ import annotations

from ticksmith.plans.fixtures import DOC_CHUNK, SYMBOL_META
from ticksmith.plans.registry import SECOND_STAMP, STAMP

DOC = f"strftime(ts, '%Y-%m-%d') || '_' || lpad(CAST(event_id // {DOC_CHUNK} AS VARCHAR), 8, '0')"
DEC = "CAST(value AS DECIMAL(18,2))"


def _meta_case(i: int, symbol: str = "symbol") -> str:
    arms = " ".join(f"WHEN '{s}' THEN '{v[i]}'" for s, v in SYMBOL_META.items())
    return f"CASE {symbol} {arms} END"


def fact_select(stamp: str | None = STAMP, date_col: str = "price_date") -> str:
    stamp_sql = f"'{stamp}'" if stamp is not None else "CAST(NULL AS VARCHAR)"
    return f"""event_type AS symbol,
        strftime(ts, '%Y-%m-%d') AS {date_col},
        CAST({DEC} AS VARCHAR) AS open,
        CAST({DEC} + 1 AS VARCHAR) AS high,
        CAST({DEC} - 1 AS VARCHAR) AS low,
        CAST({DEC} AS VARCHAR) AS close,
        CASE WHEN user_id % 7 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS volume,
        {stamp_sql} AS extracted_at_utc"""


def dim_select(drop_error_meta: bool = True, stamp: str = STAMP) -> str:
    interval = "CASE WHEN symbol = 'error' THEN NULL ELSE '1day' END" if drop_error_meta else "'1day'"
    cols = ["currency", "exchange", "mic_code", "type"]
    parts = []
    for i, c in enumerate(cols):
        expr = _meta_case(i)
        if drop_error_meta:
            expr = f"CASE WHEN symbol = 'error' THEN NULL ELSE {expr} END"
        parts.append(f"{expr} AS {c}")
    return f"symbol, {interval} AS interval, " + ", ".join(parts) + f", '{stamp}' AS extracted_at_utc"


DOC_SYMBOLS = f"""SELECT DISTINCT {DOC} AS doc_id, event_type AS symbol FROM events
    UNION ALL SELECT DISTINCT {DOC} AS doc_id, 'empty' AS symbol FROM events"""

ORACLE: dict[str, str] = {}

ORACLE["fact_rows"] = f"SELECT {fact_select()} FROM events"

ORACLE["fact_rows_explore"] = f"SELECT {fact_select(date_col='datetime')} FROM events"

ORACLE["explode_symbols"] = DOC_SYMBOLS

ORACLE["explode_values"] = f"""SELECT {DOC} AS doc_id, event_type AS symbol,
    row_number() OVER (PARTITION BY {DOC}, event_type ORDER BY event_id) - 1 AS bar_idx,
    strftime(ts, '%Y-%m-%d') AS price_date
    FROM events"""

ORACLE["dim_rows"] = f"""SELECT {dim_select()} FROM (SELECT DISTINCT {DOC} AS doc_id, event_type AS symbol FROM events)
    UNION ALL
    SELECT 'empty' AS symbol, '1day' AS interval, NULL AS currency, NULL AS exchange, NULL AS mic_code,
           NULL AS type, '{STAMP}' AS extracted_at_utc
    FROM (SELECT DISTINCT {DOC} AS doc_id FROM events)"""

ORACLE["dim_distinct"] = f"""SELECT {dim_select(drop_error_meta=False)}
    FROM (SELECT DISTINCT {DOC} AS doc_id, event_type AS symbol FROM events)"""

ORACLE["missing_keys"] = f"""WITH d AS ({DOC_SYMBOLS}),
    e AS (SELECT symbol, count(*) AS entries,
                 count(*) FILTER (WHERE symbol = 'error') AS entries_without_meta
          FROM d GROUP BY symbol),
    b AS (SELECT event_type AS symbol, count(*) AS bars,
                 count(*) FILTER (WHERE user_id % 7 = 0) AS bars_without_volume
          FROM events GROUP BY event_type)
    SELECT e.symbol, e.entries, e.entries_without_meta,
           coalesce(b.bars, 0) AS bars, coalesce(b.bars_without_volume, 0) AS bars_without_volume
    FROM e LEFT JOIN b ON e.symbol = b.symbol"""

ORACLE["stamp"] = f"""SELECT 'fact' AS table_name, '{STAMP}' AS extracted_at_utc, count(*) AS row_count FROM events
    UNION ALL
    SELECT 'dim', '{STAMP}', count(*) FROM ({DOC_SYMBOLS})"""

ORACLE["run_counts"] = f"""SELECT {DOC} AS doc_id, count(*) AS fact_row_count,
    count(DISTINCT event_type) + 1 AS dim_row_count
    FROM events GROUP BY 1"""

ORACLE["preview"] = f"""SELECT {fact_select(date_col='datetime')} FROM events
    ORDER BY {DOC}, event_type, event_id LIMIT 5"""

ORACLE["union_runs"] = f"""SELECT {fact_select()} FROM events
    UNION ALL SELECT {fact_select(stamp=SECOND_STAMP)} FROM events"""

ORACLE["run_stamp"] = """WITH r AS (SELECT CAST(ts AS DATE) AS day, max(ts) AS m FROM events GROUP BY 1)
    SELECT strftime(day, '%Y-%m-%d') AS day,
           strftime(m, '%Y%m%dT%H%M%SZ') AS run_id,
           strftime(m, '%Y-%m-%d') AS extract_date,
           strftime(m, '%Y-%m-%dT%H:%M:%S')
             || CASE WHEN strftime(m, '%f') = '000000' THEN '' ELSE '.' || strftime(m, '%f') END
             || '+00:00' AS extracted_at_utc
    FROM r"""

ORACLE["reject_documents"] = f"""SELECT DISTINCT {DOC} AS doc_id, 'entry_not_object' AS reject_reason
    FROM events WHERE dayofmonth(ts) % 5 = 0"""

ORACLE["reject_keep_rest"] = f"SELECT {fact_select()} FROM events WHERE dayofmonth(ts) % 5 <> 0"


# --- requests -------------------------------------------------------------------

def _requests_cte() -> str:
    from ticksmith.constants import (API_BASE_URL, BAD_BODY_ERROR, DEFAULT_END_DATE, DEFAULT_START_DATE,
                                     DEFAULT_SYMBOLS)
    from ticksmith.operators.requests import ERR_BODY_BASE64, ERR_BODY_OBJECT, ERR_SYMBOLS
    from ticksmith.plans.fixtures import REQUEST_CASES

    defaults = ",".join(DEFAULT_SYMBOLS)
    return f"""WITH r AS (
        SELECT CAST(event_id AS VARCHAR) AS request_id, event_id % {REQUEST_CASES} AS c, event_type AS sym,
               CAST(user_id AS VARCHAR) AS uid, strftime(ts, '%Y-%m-%d') AS day FROM events),
    n AS (SELECT request_id, c,
        CASE WHEN c IN (0, 1, 2, 10, 11) THEN 'direct' WHEN c IN (3, 4, 5, 6, 12) THEN 'body'
             ELSE 'default' END AS route,
        CASE WHEN c IN (5, 6, 10, 11, 12) THEN 500 ELSE 200 END AS status,
        CASE c WHEN 5 THEN '{BAD_BODY_ERROR}' WHEN 6 THEN '{ERR_BODY_OBJECT}'
               WHEN 10 THEN '{ERR_SYMBOLS}' WHEN 11 THEN '{ERR_SYMBOLS}'
               WHEN 12 THEN '{ERR_BODY_BASE64}' END AS error,
        CASE WHEN c = 0 THEN sym || ',S' || uid WHEN c IN (3, 4) THEN sym
             WHEN c IN (1, 2, 7, 8, 9) THEN '{defaults}' END AS symbols,
        CASE WHEN c IN (0, 1) THEN day WHEN c IN (2, 3, 4, 7, 8, 9) THEN '{DEFAULT_START_DATE}' END AS start_date,
        CASE WHEN c IN (0, 2, 3) THEN day WHEN c IN (1, 4, 7, 8, 9) THEN '{DEFAULT_END_DATE}' END AS end_date,
        CASE c WHEN 3 THEN '{{"symbols":["' || sym || '"],"end_date":"' || day || '"}}'
               WHEN 4 THEN '{{"symbols":["' || sym || '"]}}'
               WHEN 5 THEN '{{oops ' || uid WHEN 6 THEN '[' || uid || ']' END AS body_text,
        '{API_BASE_URL}' AS base_url
        FROM r)"""


ORACLE["request_scan"] = _requests_cte() + " SELECT request_id, route, status FROM n"
ORACLE["request_route"] = _requests_cte() + " SELECT request_id, route, status, error FROM n"
ORACLE["request_defaults"] = _requests_cte() + " SELECT request_id, symbols, start_date, end_date FROM n"
ORACLE["request_base64"] = _requests_cte() + " SELECT request_id, body_text FROM n"
ORACLE["request_bad_json"] = _requests_cte() + """ SELECT error, count(*) AS requests FROM n
    WHERE status = 500 GROUP BY error"""
ORACLE["request_null_event"] = _requests_cte() + " SELECT route, count(*) AS requests FROM n GROUP BY route"
ORACLE["symbols_join"] = _requests_cte() + " SELECT request_id, symbols AS symbol_param FROM n"
ORACLE["request_url"] = _requests_cte() + """ SELECT request_id,
    CASE WHEN status = 200 THEN base_url || '?interval=1day&start_date=' || start_date || '&end_date='
         || end_date || '&symbol=' || replace(symbols, ',', '%2C') END AS url FROM n"""


def _top_level_sql(start: str, null_event_fails: bool) -> str:
    """The direct handlers, by the fixture's thirteen shapes: 0-2 and 10-11 have request keys, 8 is a null event."""
    bad = "c IN (8, 10, 11)" if null_event_fails else "c IN (10, 11)"
    null_route = "WHEN c = 8 THEN NULL" if null_event_fails else ""
    return f"""WITH r AS (
        SELECT CAST(event_id AS VARCHAR) AS request_id, event_id % 13 AS c, event_type AS sym,
               CAST(user_id AS VARCHAR) AS uid, strftime(ts, '%Y-%m-%d') AS day FROM events)
    SELECT request_id,
           CASE {null_route} WHEN c IN (0, 1, 2, 10, 11) THEN 'direct' ELSE 'default' END AS route,
           CASE WHEN {bad} THEN 500 ELSE 200 END AS status,
           CASE WHEN {bad} THEN NULL WHEN c = 0 THEN sym || ',S' || uid ELSE 'AAPL,GOOG,NVDA' END AS symbols,
           CASE WHEN {bad} THEN NULL WHEN c IN (0, 1) THEN day ELSE '{start}' END AS start_date,
           CASE WHEN {bad} THEN NULL WHEN c IN (0, 2) THEN day ELSE '2026-03-31' END AS end_date
    FROM r"""


ORACLE["request_direct"] = _top_level_sql("2026-01-01", False)
ORACLE["request_packaged"] = _top_level_sql("2026-03-01", True)


# --- sinks and runs ---------------------------------------------------------------

def _oracle_runs():
    from ticksmith.plans.registry import _two_runs
    return _two_runs()


def _sinks():
    from ticksmith.constants import ERROR_MESSAGE, SUCCESS_MESSAGE
    from ticksmith.functions.stamps import FIXED_STAMP
    from ticksmith.sinks.files import run_key

    entry = """CASE WHEN event_type = 'error' THEN '' ELSE '"meta":{"interval":"1day","currency":"' ||
        CASE event_type WHEN 'purchase' THEN 'EUR' ELSE 'USD' END || '","exchange":"' ||
        CASE event_type WHEN 'view' THEN 'NYSE' WHEN 'purchase' THEN 'XETRA' ELSE 'NASDAQ' END || '","mic_code":"' ||
        CASE event_type WHEN 'click' THEN 'XNGS' WHEN 'view' THEN 'XNYS' WHEN 'purchase' THEN 'XETR' ELSE 'XNAS' END || '","type":"' ||
        CASE WHEN event_type IN ('click', 'view') THEN 'Common Stock' ELSE 'ETF' END || '"},' END"""
    bar = """'{"datetime":"' || strftime(ts, '%Y-%m-%d') || '","open":"' || CAST(value AS DECIMAL(18,2)) || '","high":"' ||
        CAST(CAST(value AS DECIMAL(18,2)) + 1 AS VARCHAR) || '","low":"' || CAST(CAST(value AS DECIMAL(18,2)) - 1 AS VARCHAR) || '","close":"' ||
        CAST(value AS DECIMAL(18,2)) || '"' || CASE WHEN user_id % 7 = 0 THEN '' ELSE ',"volume":"' || user_id || '"' END || '}'"""
    # the documents' text, built once more from the table
    ORACLE["sink_raw"] = f"""WITH s AS (SELECT {DOC} AS doc, event_type, '"' || event_type || '":{{' || {entry} || '"values":[' ||
            string_agg({bar}, ',' ORDER BY event_id) || ']}}' AS entry FROM events GROUP BY doc, event_type)
        SELECT '{{' || string_agg(entry, ',' ORDER BY event_type) || ',"empty":{{"meta":{{"interval":"1day"}},"values":[]}}}}' AS body
        FROM s GROUP BY doc"""
    ORACLE["sink_fact_csv"] = ORACLE["fact_rows"]
    ORACLE["sink_dim_csv"] = ORACLE["dim_rows"]
    parts = []
    for s in _oracle_runs():
        parts.append(f"SELECT {fact_select(stamp=s.extracted_at_utc)}, '{s.extract_date}' AS extract_date, "
                     f"'{s.run_id}' AS run_id FROM events")
    ORACLE["read_partitioned"] = " UNION ALL ".join(parts)
    parts = []
    for s in _oracle_runs():
        d, r = s.extract_date, s.run_id
        parts.append(f"""SELECT 200 AS status, '{SUCCESS_MESSAGE}' AS message,
            '{run_key("raw", d, r)}' AS raw_key, '{run_key("fact", d, r)}' AS fact_key,
            '{run_key("dim", d, r)}' AS dim_key,
            (SELECT count(*) FROM events) AS fact_row_count,
            (SELECT count(*) FROM ({DOC_SYMBOLS})) AS dim_row_count,
            CAST(0 AS BIGINT) AS rejected_count, '{d}' AS extract_date, '{r}' AS run_id""")
    ORACLE["run_manifest"] = " UNION ALL ".join(parts)
    ORACLE["error_manifest"] = _requests_cte() + f""" SELECT request_id, status, '{ERROR_MESSAGE}' AS message,
        error, '{FIXED_STAMP.run_id}' AS run_id FROM n WHERE status <> 200"""


_sinks()


# --- API source -------------------------------------------------------------------

BAR_COLS = """event_type AS symbol, strftime(ts, '%Y-%m-%d') AS price_date,
    CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS open,
    CAST(CAST(value AS DECIMAL(18,2)) + 1 AS VARCHAR) AS high,
    CAST(CAST(value AS DECIMAL(18,2)) - 1 AS VARCHAR) AS low,
    CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS close,
    CASE WHEN user_id % 7 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS volume"""

ORACLE["api_source_scan"] = f"SELECT {BAR_COLS} FROM events"
ORACLE["filter_symbols"] = f"SELECT {BAR_COLS} FROM events WHERE event_type IN ('click', 'view')"
ORACLE["filter_dates"] = f"""SELECT {BAR_COLS} FROM events
    WHERE strftime(ts, '%Y-%m-%d') BETWEEN '2024-01-10' AND '2024-01-20'"""

ORACLE["http_status_reject"] = """WITH b AS (SELECT min(CAST(ts AS DATE)) AS d0, max(CAST(ts AS DATE)) AS d1 FROM events),
    w AS (SELECT CAST(d0 + 7 * k AS DATE) AS ws, CAST(least(d0 + 7 * k + 6, d1) AS DATE) AS we
          FROM b, (SELECT CAST(range AS INTEGER) AS k FROM range(0, 10000)) r WHERE d0 + 7 * k <= d1),
    s AS (SELECT DISTINCT event_type AS sym FROM events UNION ALL SELECT 'UNKNOWN'),
    c AS (SELECT sym, ws, we FROM s, w),
    n AS (SELECT c.sym, c.ws, c.we, count(e.event_id) AS bars
          FROM c LEFT JOIN events e ON e.event_type = c.sym AND CAST(e.ts AS DATE) BETWEEN c.ws AND c.we
          GROUP BY ALL)
    SELECT sym AS symbols, strftime(ws, '%Y-%m-%d') AS start_date, strftime(we, '%Y-%m-%d') AS end_date,
           CASE WHEN sym = 'UNKNOWN' THEN 404 ELSE 200 END AS http_status,
           CASE WHEN sym = 'UNKNOWN' THEN 'http_status' END AS reject_reason,
           CASE WHEN sym = 'UNKNOWN' THEN NULL ELSE bars END AS bars
    FROM n"""

ORACLE["response_scan"] = ORACLE["run_counts"]

ORACLE["fetch_plan"] = _requests_cte() + """,
    daily AS (SELECT event_type AS sym, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY ALL)
    SELECT n.request_id, CAST(1 AS BIGINT) AS calls,
           CAST(CASE WHEN n.c IN (1, 2, 7, 8, 9) THEN 1 ELSE 0 END AS BIGINT) AS rejected_calls,
           CAST(coalesce(CASE WHEN n.c = 0 THEN d.n END, 0) AS HUGEINT) AS bars
    FROM n JOIN r ON r.request_id = n.request_id
    LEFT JOIN daily d ON d.sym = r.sym AND d.day = r.day
    WHERE n.status = 200"""

ORACLE["stream_ingest"] = ORACLE["fact_rows"]


# --- URLs ---------------------------------------------------------------------------

def _pct(x: str, cls: str) -> str:
    cls_sql = cls.replace("'", "''")
    valid = "regexp_matches(t, '^[0-9A-Fa-f]{2}')"
    parts = f"string_split({x}, '%')"
    up = (f"array_to_string(list_concat([{parts}[1]], list_transform({parts}[2:], lambda t: "
          f"CASE WHEN {valid} THEN upper(t[1:2]) || t[3:] ELSE t END)), '%')")
    allvalid = f"(len(list_filter({parts}[2:], lambda t: {valid})) = len({parts}) - 1)"
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string(list_transform(string_split({up}, ''), "
            f"lambda c: CASE WHEN regexp_full_match(c, '{cls_sql}') OR (c = '%' AND {allvalid}) THEN c "
            f"ELSE regexp_replace(hex(encode(c)), '(..)', '%\\1', 'g') END), '') END")


def _dots_list(p: str) -> str:
    return (f"list_reduce(string_split({p}, '/'), lambda acc, s: CASE WHEN s = '.' THEN acc "
            f"WHEN s <> '..' THEN list_append(acc, s) WHEN len(acc) > 0 THEN acc[1:len(acc)-1] ELSE acc END, "
            f"[]::VARCHAR[])")


def _urls_sql() -> str:
    from ticksmith.operators import urls as U

    sq = lambda s: s.replace("'", "''")
    # the SQL engine's patterns know no possessive repetition, and don't need it
    uri, hp = sq(U.URI), sq(U.HOST_PORT).replace("++", "+").replace(")*+", ")*")
    return f"""WITH src AS (
        SELECT page_id, CAST(-1 AS BIGINT) AS link_idx, url FROM pages
        UNION ALL
        SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS link_idx, unnest(l) AS url
        FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)),
    a AS (SELECT *, CASE WHEN regexp_matches(url, '{sq(U.SCHEME_START)}') THEN url ELSE '//' || url END AS pu FROM src),
    b AS (SELECT page_id, link_idx, url,
            CASE WHEN regexp_extract(pu, '{uri}', 1) <> '' THEN lower(regexp_extract(pu, '{uri}', 2)) END AS sch,
            CASE WHEN regexp_extract(pu, '{uri}', 4) <> '' THEN regexp_extract(pu, '{uri}', 4) END AS authority,
            regexp_extract(pu, '{uri}', 5) AS p,
            CASE WHEN regexp_extract(pu, '{uri}', 6) <> '' THEN regexp_extract(pu, '{uri}', 7) END AS q,
            CASE WHEN regexp_extract(pu, '{uri}', 8) <> '' THEN regexp_extract(pu, '{uri}', 9) END AS f
          FROM a),
    c AS (SELECT *, regexp_extract(authority, '([^@]*)$', 1) AS hp,
            CASE WHEN contains(authority, '@') THEN regexp_extract(authority, '^(.*)@', 1) END AS auth_raw,
            (sch IS NULL OR sch IN ('http', 'https')) AS norm FROM b),
    d AS (SELECT *, coalesce(regexp_matches(hp, '{hp}'), false) AS hp_ok FROM c),
    e AS (SELECT *,
            (authority IS NOT NULL AND NOT hp_ok) AS bad_host,
            CASE WHEN authority IS NOT NULL AND auth_raw <> '' THEN auth_raw END AS auth0,
            CASE WHEN authority IS NOT NULL AND hp_ok THEN regexp_extract(hp, '{hp}', 1) END AS host0,
            CASE WHEN authority IS NOT NULL AND hp_ok AND regexp_extract(hp, '{hp}', 2) <> ''
                 THEN CAST(regexp_extract(hp, '{hp}', 2) AS INTEGER) END AS port0
          FROM d),
    e1 AS (SELECT *, {_dots_list('p')} AS o FROM e),
    e2 AS (SELECT *, CASE WHEN starts_with(p, '/') AND (len(o) = 0 OR o[1] <> '') THEN list_prepend('', o)
                          ELSE o END AS o2 FROM e1),
    e3 AS (SELECT *, array_to_string(CASE WHEN suffix(p, '/.') OR suffix(p, '/..') THEN list_append(o2, '')
                                          ELSE o2 END, '/') AS pdots FROM e2),
    g AS (SELECT *,
            CASE WHEN norm AND p <> '' THEN {_pct('pdots', U.PATH_CHARS)} ELSE p END AS pn,
            CASE WHEN norm AND q <> '' THEN {_pct('q', U.QUERY_CHARS)} ELSE q END AS qn,
            CASE WHEN norm AND f <> '' THEN {_pct('f', U.QUERY_CHARS)} ELSE f END AS fn,
            (bad_host OR coalesce(port0 > 65535, false)) AS bad,
            (url IS NULL OR url = '') AS empty
          FROM e3),
    h AS (SELECT page_id, link_idx,
            CASE WHEN NOT bad AND NOT empty THEN sch END AS scheme,
            CASE WHEN NOT bad AND NOT empty THEN
                 CASE WHEN auth0 IS NOT NULL AND norm THEN {_pct('auth0', U.USERINFO_CHARS)} ELSE auth0 END END AS auth,
            CASE WHEN NOT bad AND NOT empty THEN
                 CASE WHEN norm AND host0 <> '' THEN
                      CASE WHEN starts_with(host0, '[') AND contains(host0, '%')
                           THEN lower(split_part(host0, '%', 1)) || host0[instr(host0, '%'):]
                           ELSE lower(host0) END
                      ELSE host0 END END AS host,
            CASE WHEN NOT bad AND NOT empty THEN port0 END AS port,
            CASE WHEN NOT bad AND NOT empty THEN
                 CASE WHEN pn <> '' THEN CASE WHEN starts_with(pn, '/') THEN pn ELSE '/' || pn END
                      WHEN q IS NOT NULL OR f IS NOT NULL THEN '' END END AS path,
            CASE WHEN NOT bad AND NOT empty THEN qn END AS query,
            CASE WHEN NOT bad AND NOT empty THEN fn END AS fragment,
            (bad AND NOT empty) AS parse_error
          FROM g)"""


ORACLE["url_parts"] = _urls_sql() + " SELECT * FROM h"
ORACLE["url_normalise"] = _urls_sql() + """ SELECT page_id, link_idx,
    CASE WHEN NOT parse_error THEN
        coalesce(scheme || '://', '') || coalesce(auth || '@', '') || coalesce(host, '')
        || coalesce(':' || CAST(port AS VARCHAR), '') || coalesce(path, '') || coalesce('?' || query, '')
        || coalesce('#' || fragment, '') END AS normalised_url
    FROM h"""


# --- text profiles ------------------------------------------------------------------------
# The corpus is written in Latin scripts; the oracle's character facts cover
# U+0000..U+024F, generated by the same unicodedata rules, with the JDK's
# names of the five blocks in that range.

def _facts_values() -> str:
    from ticksmith.operators.textprofile import char_facts

    def block(cp):
        if cp < 32:
            return "Control character"
        if cp < 128:
            return "Basic Latin"
        if cp < 256:
            return "Latin-1 Supplement"
        if cp < 384:
            return "Latin Extended-A"
        return "Latin Extended-B"

    rows = []
    b = lambda v: "true" if v else "false"
    for cp in range(0, 0x250):
        f = char_facts(chr(cp), block(cp))
        (_, _, blk, alpha, upper, _lower, space, digit, printable, lower_ch, acc, latin, base, punct, sym,
         emo, unpr, safe) = f
        rows.append(f"({cp}, '{blk}', {b(alpha)}, {b(upper)}, {b(space)}, {b(digit)}, {b(printable)}, "
                    f"{ord(lower_ch[0]) if len(lower_ch) == 1 else cp}, {b(acc)}, {b(latin)}, {ord(base)}, "
                    f"{b(punct)}, {b(sym)}, {b(emo)}, {b(unpr)}, {b(safe)})")
    return ("facts AS (SELECT chr(cp) AS ch, cp, block, is_alpha, is_upper, is_space, is_digit, is_printable, "
            "chr(lower_cp) AS lower_ch, accentuated, latin, chr(base_cp) AS base_ch, punct, sym, emoticon, "
            "unprintable, safe_ascii FROM (VALUES " + ", ".join(rows) + ") t(cp, block, is_alpha, is_upper, "
            "is_space, is_digit, is_printable, lower_cp, accentuated, latin, base_cp, punct, sym, emoticon, "
            "unprintable, safe_ascii))")


def _round4_sql(num: str, den: str) -> str:
    """Half-to-even rounding of num/den to 4 decimals with integer arithmetic."""
    scaled = f"(CAST({num} AS BIGINT) * 10000)"
    d = f"CAST({den} AS BIGINT)"
    rem = f"({scaled} % {d})"
    k = f"(({scaled} - {rem}) // {d})"
    return (f"(({k} + CASE WHEN {rem} * 2 > {d} THEN 1 WHEN {rem} * 2 < {d} THEN 0 ELSE {k} % 2 END) "
            f"/ 10000.0)")


def _text_cte(chunk_chars: int = 8192) -> str:
    return f"""WITH {_facts_values()},
    chars AS (SELECT doc_id, lang, CAST(generate_subscripts(cs, 1) - 1 AS BIGINT) AS pos, unnest(cs) AS ch
              FROM (SELECT doc_id, lang, string_split(text, '') AS cs FROM documents WHERE length(text) > 0)),
    hist AS (SELECT doc_id, pos // {chunk_chars} AS chunk, ch, count(*) AS n, min(pos) AS first_pos
             FROM chars GROUP BY ALL),
    letters AS (SELECT h.doc_id, h.chunk, h.ch, h.n, h.first_pos, f.block, f.lower_ch
                FROM hist h JOIN facts f ON f.ch = h.ch WHERE f.is_alpha),
    layer_of AS (SELECT doc_id, chunk, arg_min(block, first_pos) AS layer FROM letters GROUP BY ALL),
    per AS (SELECT l.doc_id, l.chunk, y.layer, l.lower_ch AS ch, sum(l.n) AS n, min(l.first_pos) AS first_pos
            FROM letters l JOIN layer_of y USING (doc_id, chunk) GROUP BY ALL),
    ranks AS (SELECT *, row_number() OVER (PARTITION BY doc_id, chunk, layer ORDER BY n DESC, first_pos) - 1 AS rank,
                     sum(n) OVER (PARTITION BY doc_id, chunk, layer) AS layer_size,
                     count(*) OVER (PARTITION BY doc_id, chunk, layer) AS layer_letters
              FROM per)"""


def _profiles_cte() -> str:
    return """,
    lc AS (SELECT c.lang, f.lower_ch AS ch, count(*) AS n FROM chars c JOIN facts f ON f.ch = c.ch
           WHERE f.is_alpha AND c.lang IS NOT NULL GROUP BY ALL),
    lr AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, ch) - 1 AS r,
                  sum(n) OVER (PARTITION BY lang) AS total FROM lc),
    prof0 AS (SELECT lang AS language, ch, r AS lang_rank FROM lr WHERE n * 1000 >= total
              UNION ALL SELECT lang || '—', ch, r FROM lr WHERE n * 10000 >= total),
    prof AS (SELECT p.*, count(*) OVER (PARTITION BY language) AS profile_size,
                    bool_or(coalesce(f.accentuated, false)) OVER (PARTITION BY language) AS has_accents
             FROM prof0 p LEFT JOIN facts f ON f.ch = p.ch),
    big AS (SELECT * FROM ranks WHERE layer_size > 32),
    src_acc AS (SELECT b.doc_id, b.chunk, b.layer, bool_or(coalesce(f.accentuated, false)) AS source_accents
                FROM big b LEFT JOIN facts f ON f.ch = b.ch GROUP BY ALL),
    cand AS (SELECT b.doc_id, b.chunk, b.layer, p.language, count(*) / max(p.profile_size) AS share
             FROM big b JOIN prof p ON p.ch = b.ch JOIN src_acc s USING (doc_id, chunk, layer)
             WHERE p.has_accents OR NOT s.source_accents
             GROUP BY ALL HAVING count(*) / max(p.profile_size) >= 0.2),
    common AS (SELECT b.doc_id, b.chunk, b.layer, p.language, b.ch, b.rank, b.layer_letters, p.lang_rank,
                      p.profile_size
               FROM big b JOIN prof p ON p.ch = b.ch JOIN cand c USING (doc_id, chunk, layer, language)),
    counts AS (SELECT a.doc_id, a.chunk, a.layer, a.language, a.ch, a.rank, a.lang_rank, a.profile_size,
                      a.layer_letters,
                      count(*) FILTER (WHERE o.lang_rank < a.lang_rank AND o.rank < a.rank) AS before,
                      count(*) FILTER (WHERE o.lang_rank >= a.lang_rank AND o.rank >= a.rank) AS after
               FROM common a JOIN common o USING (doc_id, chunk, layer, language) GROUP BY ALL),
    judged AS (SELECT *, CAST(floor(rank * (profile_size / layer_letters)) AS INTEGER) AS proj FROM counts),
    ok AS (SELECT doc_id, chunk, layer, language, layer_letters,
                  CASE WHEN profile_size <= 26 AND abs(proj - lang_rank) > 4 THEN 0
                       WHEN profile_size > 26 AND abs(proj - lang_rank) < profile_size / 3 THEN 1
                       WHEN lang_rank = 0 AND before <= 4 THEN 1
                       WHEN profile_size - lang_rank = 0 AND after <= 4 THEN 1
                       WHEN lang_rank > 0 AND before / lang_rank >= 0.4 THEN 1
                       WHEN profile_size - lang_rank > 0 AND after / (profile_size - lang_rank) >= 0.4 THEN 1
                       ELSE 0 END AS approved
           FROM judged),
    coh0 AS (SELECT doc_id, chunk, layer, language, sum(approved) AS n_ok, max(layer_letters) AS letters
             FROM ok GROUP BY ALL),
    coh AS (SELECT doc_id, chunk, layer, language, """ + _round4_sql('n_ok', 'letters') + """ AS ratio FROM coh0
            WHERE """ + _round4_sql('n_ok', 'letters') + """ >= 0.1),
    named AS (SELECT *, replace(language, '—', '') AS base_language FROM coh),
    twice AS (SELECT doc_id, chunk, max(k) > 1 AS has_dup
              FROM (SELECT doc_id, chunk, base_language, count(*) AS k FROM named GROUP BY ALL) GROUP BY ALL),
    best AS (SELECT n.doc_id, n.chunk, n.base_language AS language, max(n.ratio) AS ratio
             FROM named n JOIN twice t USING (doc_id, chunk) WHERE t.has_dup GROUP BY ALL
             UNION ALL SELECT n.doc_id, n.chunk, n.language, n.ratio
             FROM named n JOIN twice t USING (doc_id, chunk) WHERE NOT t.has_dup),
    merged AS (SELECT doc_id, language, """ + _round4_sql('sum(CAST(round(ratio * 10000) AS BIGINT))', 'count(*) * 10000') + """
               AS ratio FROM best GROUP BY ALL)"""


ORACLE["char_blocks"] = _text_cte() + """ SELECT h.doc_id, f.block, sum(h.n) AS chars
    FROM hist h JOIN facts f ON f.ch = h.ch GROUP BY ALL"""
ORACLE["char_rank"] = _text_cte(1 << 40) + """ SELECT doc_id, layer, ch, n, first_pos,
    CAST(rank AS BIGINT) AS rank FROM ranks"""
ORACLE["lang_candidates"] = _text_cte() + _profiles_cte() + """ SELECT doc_id, CAST(chunk AS BIGINT) AS chunk,
    layer, language, share FROM cand"""
ORACLE["lang_coherence"] = _text_cte() + _profiles_cte() + """ SELECT doc_id, CAST(chunk AS BIGINT) AS chunk,
    layer, language, ratio FROM coh"""
ORACLE["lang_merge"] = _text_cte() + _profiles_cte() + " SELECT * FROM merged"
ORACLE["lang_best"] = _text_cte() + _profiles_cte() + """ SELECT doc_id, CAST(chunk AS BIGINT) AS chunk,
    language, ratio FROM best"""

ORACLE["noise_counts"] = _text_cte() + """,
    per9 AS (SELECT h.doc_id, sum(h.n) AS chars,
                   sum(CASE WHEN f.is_alpha THEN h.n ELSE 0 END) AS letters,
                   sum(CASE WHEN f.is_alpha AND f.accentuated THEN h.n ELSE 0 END) AS accented,
                   sum(CASE WHEN f.unprintable THEN h.n ELSE 0 END) AS unprintable
            FROM hist h LEFT JOIN facts f ON f.ch = h.ch GROUP BY ALL),
    allp AS (SELECT d.doc_id, coalesce(chars, 0) AS chars, coalesce(letters, 0) AS letters,
                    coalesce(accented, 0) AS accented, coalesce(unprintable, 0) AS unprintable
             FROM documents d LEFT JOIN per9 USING (doc_id))
    SELECT doc_id,
           CASE WHEN letters >= 8 AND accented / letters >= 0.35 THEN accented / letters ELSE 0.0 END AS accent_ratio,
           unprintable * 8 / (chars + 1) AS unprintable_ratio
    FROM allp"""

ORACLE["noise_neighbours"] = _text_cte() + """,
    c AS (SELECT c.doc_id, c.pos, c.ch, f.*  EXCLUDE (ch),
                 coalesce(f.is_printable, false) AS pr,
                 coalesce(f.is_alpha AND f.latin, false) AS ll,
                 (f.is_space OR f.punct OR f.safe_ascii) AS cut
          FROM chars c LEFT JOIN facts f ON f.ch = c.ch),
    w AS (SELECT *,
            last_value(CASE WHEN pr THEN ch END IGNORE NULLS) OVER win AS prev_printable,
            last_value(CASE WHEN pr THEN cut END IGNORE NULLS) OVER win AS prev_cut,
            last_value(CASE WHEN pr THEN block END IGNORE NULLS) OVER win AS prev_block,
            last_value(CASE WHEN ll THEN accentuated END IGNORE NULLS) OVER win AS prev_acc,
            last_value(CASE WHEN ll THEN is_upper END IGNORE NULLS) OVER win AS prev_up,
            last_value(CASE WHEN ll THEN base_ch END IGNORE NULLS) OVER win AS prev_base
          FROM c WINDOW win AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    pts AS (SELECT doc_id, pr, ll,
              CASE WHEN pr AND ch IS DISTINCT FROM prev_printable AND NOT coalesce(safe_ascii, false) THEN
                   CASE WHEN punct THEN 1 WHEN NOT is_digit AND sym AND NOT emoticon THEN 2 ELSE 0 END
                   ELSE 0 END AS sp,
              (pr AND NOT cut AND prev_cut IS NOT NULL AND NOT prev_cut
                  AND NOT (prev_block = block OR (contains(prev_block, 'Latin') AND contains(block, 'Latin')))) AS jump,
              CASE WHEN ll AND prev_acc IS NOT NULL AND accentuated AND prev_acc THEN
                   (CASE WHEN is_upper AND prev_up THEN 1 ELSE 0 END) + (CASE WHEN base_ch = prev_base THEN 1 ELSE 0 END)
                   ELSE 0 END AS pp
            FROM w),
    per10 AS (SELECT doc_id, count(*) FILTER (WHERE pr) AS printable, sum(sp) AS sym_points,
                   count(*) FILTER (WHERE jump) AS jumps, count(*) FILTER (WHERE ll) AS latin_letters,
                   sum(pp) AS pair_points FROM pts GROUP BY doc_id),
    allp AS (SELECT d.doc_id, coalesce(printable, 0) AS printable, coalesce(sym_points, 0) AS sym_points,
                    coalesce(jumps, 0) AS jumps, coalesce(latin_letters, 0) AS latin_letters,
                    coalesce(pair_points, 0) AS pair_points
             FROM documents d LEFT JOIN per10 USING (doc_id))
    SELECT doc_id,
           CASE WHEN printable > 0 AND sym_points / printable >= 0.3 THEN sym_points / printable ELSE 0.0 END
             AS symbol_ratio,
           CASE WHEN printable > 13 THEN jumps * 2 / printable ELSE 0.0 END AS range_ratio,
           CASE WHEN latin_letters > 0 THEN pair_points * 2 / latin_letters ELSE 0.0 END AS accent_pair_ratio
    FROM allp"""

ORACLE["request_ingest"] = _requests_cte() + """,
    daily AS (SELECT event_type AS sym, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY ALL)
    SELECT n.request_id,
           CASE WHEN n.c IN (1, 2, 7, 8, 9) THEN 500 ELSE n.status END AS status,
           CASE WHEN n.status <> 200 THEN NULL WHEN n.c IN (1, 2, 7, 8, 9) THEN CAST(0 AS BIGINT)
                ELSE CAST(coalesce(CASE WHEN n.c = 0 THEN d.n END, 0) AS BIGINT) END AS fact_row_count,
           CASE WHEN n.status <> 200 THEN NULL WHEN n.c IN (1, 2, 7, 8, 9) THEN CAST(0 AS BIGINT)
                WHEN n.c = 0 THEN CAST(2 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS dim_row_count,
           CASE WHEN n.status <> 200 THEN NULL WHEN n.c IN (1, 2, 7, 8, 9) THEN CAST(1 AS BIGINT)
                ELSE CAST(0 AS BIGINT) END AS rejected_count
    FROM n JOIN r ON r.request_id = n.request_id
    LEFT JOIN daily d ON d.sym = r.sym AND d.day = r.day"""

ORACLE["handler_run"] = ORACLE["fact_rows"]
ORACLE["stream_requests"] = ORACLE["request_ingest"]
