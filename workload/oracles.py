"""The same results in plain SQL, straight from the tables and without the library.

Small text builders stand for repeated expressions; every entry is one self-contained statement.
"""

from __future__ import annotations

from .derive import CATALOGUE_SQL, POLICY, SOURCE_SQL

BLANKS = " \t\n\r\x0b\x0c  " + "".join(chr(c) for c in range(0x2000, 0x200B)) + "    　﻿"
SP = r"[ \t\n\r\x0B\f\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"

CAT = f"cat AS ({CATALOGUE_SQL})"
SRC = f"src AS ({SOURCE_SQL})"


def strip(x: str) -> str:
    return f"trim({x}, '{BLANKS}')"


def drop_chars(x: str, chars: str) -> str:
    return f"translate({x}, '{chars}', '')"


def parts(x: str, pattern: str) -> str:
    return (
        f"list_filter(list_transform(string_split_regex({x}, '{pattern}'), lambda p: {strip('p')}), "
        "lambda p: p <> '')"
    )


def cents(x: str) -> str:
    return f"CAST(floor(CAST({x} AS DOUBLE) * 100 + 0.5) AS BIGINT)"


def parse_number(x: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({strip(x)}, '^([+-]?(?:\\d+\\.?\\d*|\\.\\d+)(?:[eE][+-]?\\d+)?)', 1), '') AS DOUBLE)"


def parse_integer(x: str) -> str:
    return f"nullif(TRY_CAST(nullif(regexp_extract({strip(x)}, '^([+-]?\\d+)', 1), '') AS BIGINT), 0)"


def json_text(*pairs: tuple[str, str]) -> str:
    """Compact JSON object text from (name, JSON text of the value)."""
    inner = " || ',' || ".join(f"'\"{name}\":' || {value}" for name, value in pairs)
    return f"'{{' || {inner} || '}}'"


def j_str(x: str) -> str:
    return f"coalesce('\"' || {x} || '\"', 'null')"


def j_num(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), 'null')"


def j_list(x: str) -> str:
    return f"coalesce('[' || array_to_string(list_transform({x}, lambda q: '\"' || q || '\"'), ',') || ']', 'null')"


# ---------------------------------------------------------------- rules

ACRONYMS = "'DFF','WOFF','MQ','LOV','SOPFFO'"
WIDE = "^M{0,4}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$"
NARROW = "^(X{0,3})(IX|IV|V?I{0,3})$"


def label(x: str, roman: str = WIDE) -> str:
    title = (
        f"array_to_string(list_transform(string_split(lower({x}), ' '), "
        "lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')"
    )
    return (
        f"CASE WHEN upper({x}) = 'THEATRHYTHM' THEN 'Theatrhythm' WHEN upper({x}) = 'MOBIUS' THEN 'Mobius' "
        f"WHEN upper({x}) = 'PICTLOGICA' THEN 'Pictlogica' WHEN upper({x}) = 'TYPE-0' THEN 'Type-0' "
        f"WHEN upper({x}) = 'WORLD OF FINAL FANTASY' THEN 'WOFF' WHEN upper({x}) = 'LORD OF VERMILION' THEN 'LOV' "
        f"WHEN regexp_matches({x}, '{roman}', 'i') THEN upper({x}) "
        f"WHEN {x} = upper({x}) AND length({x}) > 1 AND {x} NOT IN ({ACRONYMS}) AND NOT starts_with({x}, 'FF') "
        f"THEN {title} ELSE {x} END"
    )


def label_list(x: str, separators: str, roman: str) -> str:
    decoded = f"replace({x}, '&middot;', '·')"
    return f"coalesce(list_transform({parts(decoded, separators)}, lambda c: {label('c', roman)}), [])"


def priority_first(cats: str) -> str:
    at = f"list_position({cats}, 'DFF')"
    return f"CASE WHEN {at} > 1 THEN ['DFF'] || {cats}[1:{at} - 1] || {cats}[{at} + 1:] ELSE {cats} END"


def distinct_in_order(x: str) -> str:
    return f"list_filter({x}, lambda e, i: list_position({x}, e) = i)"


def compact(x: str) -> str:
    return f"upper({drop_chars(x, '-.,;' + BLANKS)})"


def normal_code(c: str) -> str:
    def padded(prefix: str, pattern: str) -> str:
        g = f"nullif(regexp_extract({c}, '{pattern}', 1), '')"
        return f"'{prefix}' || lpad({g}, 3, '0')"

    return (
        f"CASE WHEN {c} LIKE 'P%' THEN {padded('PR-', '^PR?0*([0-9]{1,3})')} "
        f"WHEN {c} LIKE 'A%' THEN {padded('A-', '^A0*([0-9]{1,3})')} "
        f"WHEN {c} LIKE 'B%' THEN {padded('B-', '^B0*([0-9]{1,3})')} "
        f"WHEN {c} LIKE 'C%' THEN {padded('C-', '^C0*([0-9]{1,3})')} "
        f"WHEN regexp_matches({c}, '^RE0*([0-9]{{1,3}})([A-Z])$') THEN {padded('Re-', '^RE0*([0-9]{1,3})([A-Z])$')} || right({c}, 1) "
        f"WHEN regexp_matches({c}, '^[0-9]{{1,2}}[0-9]{{3}}[A-Z]$') "
        f"AND CAST(left({c}, length({c}) - 4) AS INT) >= 1 "
        f"THEN left({c}, length({c}) - 4) || '-' || right({c}, 4) END"
    )


def codes_of(x: str) -> str:
    clean = f"list_transform(string_split_regex({x}, '[,;/]'), lambda p: {compact('p')})"
    every = f"list_filter(list_transform({clean}, lambda c: {normal_code('c')}), lambda n: n IS NOT NULL)"
    return every


def coded(rest: str = "") -> str:
    """Catalogue rows with their list of codes (null when there is none)."""
    return (
        f"raw_codes AS (SELECT *, {codes_of('number_text')} AS every FROM cat), "
        f"coded AS (SELECT *, CASE WHEN len(every) > 0 THEN {distinct_in_order('every')} END AS codes FROM raw_codes)"
    )


VALID = "^(PR-[0-9]{3}|[0-9]{1,2}-[0-9]{3}[A-Z]|[ABC]-[0-9]{3}|Re-[0-9]{3}[A-Z])$"
VALID_SOURCE = "^(PR-[0-9]{3}|[1-9][0-9]?-[0-9]{3}[A-Z]|[ABC]-[0-9]{3}|Re-[0-9]{3}[A-Z])$"


def primary(c: str = "codes") -> str:
    lead = f"list_filter({c}, lambda n: NOT starts_with(n, 'Re-'))[1]"
    return f"coalesce({lead}, {c}[-1])"


def form(x: str) -> str:
    return f"upper({drop_chars(x, '-.,;/' + BLANKS)})"


def loose(x: str) -> str:
    c = form(x)
    return (
        f"CASE WHEN regexp_matches({c}, '^PR0*[0-9]{{1,3}}') THEN 'PR-' || lpad(regexp_extract({c}, '^PR0*([0-9]{{1,3}})', 1), 3, '0') "
        f"WHEN regexp_matches({c}, '^A[0-9]{{3}}') THEN 'A-' || substr({c}, 2, 3) "
        f"WHEN regexp_matches({c}, '^[0-9]{{1,2}}[0-9]{{3}}[A-Z]?$') "
        f"THEN regexp_replace({c}, '^([0-9]{{1,2}})([0-9]{{3}})([A-Z]?)$', '\\1-\\2\\3') ELSE {c} END"
    )


DASH = "[-–—]"


def first_gone(x: str, patterns: list[str], keep: str = "") -> str:
    for p in patterns:
        x = f"regexp_replace({x}, '{p}', '{keep if p.endswith('$)') else ''}')"
    return x


def search_name(x: str) -> str:
    bare = strip(
        first_gone(
            x,
            [
                rf"{SP}*{DASH}{SP}*PR-?\d+/[^(\s]+",
                rf"{SP}*{DASH}{SP}*PR-?\d+",
                rf"{SP}*{DASH}{SP}*\d{{1,2}}-\d{{3}}[A-Z]",
                rf"{SP}*{DASH}{SP}*[A-C]-\d{{3}}",
                rf"{SP}*{DASH}{SP}*PR\b",
            ],
        )
    )
    mark = rf"regexp_extract({bare}, '\b(EX|LB)\b', 1)"
    clean = strip(rf"regexp_replace({bare}, '{SP}*\([^)]+\)', '', 'g')")
    return f"CASE WHEN {mark} <> '' AND NOT contains({clean}, {mark}) THEN {clean} || ' ' || {mark} ELSE {clean} END"


MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
KEPT = (
    "Full Art|Promo|Road to World Championship|Champion|Anniversary|Prerelease Promo|Alternate Art Promo|"
    "Full Art Reprint|Buy A Box Promo|Class Zero Cadet"
)


def display_steps(name: str, table: str, key: str, promo: str) -> str:
    """CTEs that end in ``shown(key, name)``."""
    ahead = rf"({SP}*\(|$)"
    strips = [
        rf"{SP}*\(PR-?\d+\)",
        rf"{SP}*\(\d{{1,2}}-\d{{3}}[A-Z]\)",
        rf"{SP}*\([A-C]-\d{{3}}\)",
        rf"(?:{SP}*{DASH}{SP}*PR)?-?\d+/[^(\s]+{ahead}",
        rf"{SP}*{DASH}{SP}*PR-?\d+{ahead}",
        rf"{SP}*{DASH}{SP}*\d{{1,2}}-\d{{3}}[A-Z]{ahead}",
        rf"{SP}*{DASH}{SP}*[A-C]-\d{{3}}{ahead}",
        rf"{SP}*{DASH}{SP}*PR\b",
        rf"{SP}*{DASH}{SP}*\d+[^(\s]*{ahead}",
    ]
    remark = (
        "CASE WHEN r = '' OR regexp_matches(r, '^(Common|Rare|PR-?\\d+|PR|PR-.*|\\d{1,2}|\\d{1,2}-\\d{3}[A-Z]|[A-C]|[A-C]-\\d{3})$') THEN NULL "
        f"WHEN regexp_matches(r, '^\\d+{SP}+\\((.+)$') THEN '(' || regexp_extract(r, '^\\d+{SP}+\\((.+)$', 1) || ')' "
        f"WHEN regexp_matches(r, '{KEPT}|^({MONTHS}){SP}+\\d{{4}}$') OR (regexp_matches(r, '\\b\\d{{4}}\\b') AND NOT regexp_matches(r, '^\\d+$')) "
        "THEN '(' || r || ')' END"
    )
    bare = strip(first_gone(name, strips, "\\1"))
    cut = strip(rf"regexp_replace(bare, '{SP}*\([A-C1-9][^)]*$', '')")
    return rf"""
      bared AS (SELECT {key} AS id, {name} AS given, {promo} AS promo, {bare} AS bare FROM {table}),
      whole AS (SELECT id, given, promo, CASE WHEN regexp_matches(bare, '\([A-C1-9]([^)]|$)') THEN {cut} ELSE bare END AS bare FROM bared),
      split AS (SELECT id, promo OR regexp_matches(given, 'PR-?\d+') AS promo,
          regexp_extract(bare, '(?s)^(.*?)(?:{SP}*\((?-s:.*?)\).*)?$', 1) AS base,
          list_filter(list_transform(regexp_extract_all(bare, '\((.*?)\)', 1), lambda r: {remark}), lambda r: r IS NOT NULL) AS kept FROM whole),
      shown AS (SELECT id, {strip("regexp_replace(base || ' ' || array_to_string(CASE WHEN promo AND len(kept) = 0 THEN ['(Promo)'] ELSE kept END, ' '), '" + SP + "+', ' ', 'g')")} AS name FROM split)
    """


def ruled_text(x: str) -> str:
    """Rules text of a non-empty text column or expression."""
    t = rf"regexp_replace(regexp_replace(nullif({x}, ''), '\bex burst\b', 'EX BURST', 'gi'), '<[^>]+>Dull</[^>]+>', 'Dull', 'g')"
    left = f"rtrim(string_split(t, ':')[1], '{BLANKS}')"
    right = f"ltrim(string_split(t, ':')[2], '{BLANKS}')"
    cut = rf"replace(regexp_replace(replace({left}, '[Dull]', chr(1)), '\bDull\b', '', 'g'), chr(1), '[Dull]')"
    return (
        f"[CASE WHEN length(t) - length(replace(t, ':', '')) = 1 THEN "
        f"(CASE WHEN {strip(left)} = 'Dull' THEN {left} ELSE {cut} END) || ': ' || "
        rf"replace(regexp_replace({right}, '\bDull{SP}+Dull\b', 'Dull', 'g'), '[Dull]', 'Dull') "
        f"ELSE t END FOR t IN [{t}]][1]"
    )


def translated(x: str) -> str:
    t = f"replace(replace(replace({x}, '[[br]]', chr(10)), '[[i]]', '<em>'), '[[/]]', '</em>')"
    for a, b in zip("火氷風土雷水光闇", "FIWELWLD"):
        t = f"replace({t}, '《{a}》', '{{{b}}}')"
    return ruled_text(rf"regexp_replace({t}, '《(\d+)》', '{{\1}}', 'g')")


def elements_of(kind: str = "card_type", number: str = "number_text") -> str:
    listed = (
        f"list_transform({parts('element', '[;,]')}, lambda e: upper(substr(e, 1, 1)) || lower(substr(e, 2)))"
    )
    return (
        f"CASE WHEN lower({kind}) = 'crystal' OR upper({number}) LIKE 'C-%' THEN ['Crystal'] "
        f"ELSE coalesce({listed}, []) END"
    )


NON_CARD = (
    "NOT (coalesce(lower(card_type) <> 'sealed product', false) OR coalesce(number_text <> '', false) "
    "OR coalesce(power_text <> '', false) OR coalesce(job <> '', false))"
)
TYPE = "CASE WHEN upper(number_text) LIKE 'C-%' THEN 'Crystal' ELSE card_type END"

SRC_CRYSTAL = "(type = 'Crystal' OR code LIKE 'C-%')"
SRC_ELEMENT = f"CASE WHEN {SRC_CRYSTAL} THEN 'Crystal' WHEN element = '火' THEN 'Fire' WHEN element = '水' THEN 'Water' ELSE element END"

HOST = POLICY.source_host
REST = POLICY.placeholder_url


def url_columns(u: str = "url") -> dict[str, str]:
    host = f"contains({u}, '{HOST}')"
    full = f"({host} AND contains({u}, '/cards/full/'))"
    thumb = f"({host} AND contains({u}, '/cards/thumbs/') AND NOT contains({u}, '/cards/full/'))"

    def market(mark: str) -> str:
        return rf"regexp_replace({u}, '_[^.]+\.', '{mark}')"

    valid = (
        f"coalesce({u} <> '' AND NOT contains({u}, 'image-missing.svg') AND CASE WHEN {host} "
        f"THEN contains({u}, '_eg.jpg') AND (contains({u}, '/cards/full/') OR contains({u}, '/cards/thumbs/')) "
        f"ELSE contains({u}, '_in_1000x1000.') OR contains({u}, '_400w.') OR contains({u}, '_200w.') END, false)"
    )
    return {
        "valid": valid,
        "full_url": f"CASE WHEN {thumb} THEN NULL WHEN {host} THEN {u} ELSE {market('_in_1000x1000.')} END",
        "high_url": f"CASE WHEN {full} THEN {u} WHEN NOT {host} THEN {market('_400w.')} END",
        "low_url": f"CASE WHEN {thumb} THEN {u} WHEN NOT {host} THEN {market('_200w.')} END",
    }


URLS = url_columns()
IMAGES = url_columns("image_url")

# ---------------------------------------------------------------- prices

PRICES = """
  p AS (SELECT l_partkey AS product_id, CASE WHEN l_linenumber % 2 = 0 THEN l_discount END AS direct_low,
      l_extendedprice AS high, l_quantity AS low, CASE WHEN l_linenumber <> 3 THEN l_extendedprice - l_quantity END AS market,
      l_tax AS mid, CASE l_returnflag WHEN 'N' THEN 'Normal' WHEN 'R' THEN 'Foil' ELSE 'Promo' END AS sub,
      row_number() OVER (PARTITION BY l_partkey, l_returnflag
        ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_shipdate DESC, l_extendedprice DESC, l_quantity DESC) AS rn
    FROM lineitem),
  k AS (SELECT DISTINCT product_id FROM p),
  n AS (SELECT * FROM p WHERE sub = 'Normal' AND rn = 1),
  f AS (SELECT * FROM p WHERE sub = 'Foil' AND rn = 1),
  v AS (SELECT k.product_id, n.product_id IS NOT NULL AS has_n, f.product_id IS NOT NULL AS has_f, {columns}
    FROM k LEFT JOIN n USING (product_id) LEFT JOIN f USING (product_id))
"""


def _price_columns() -> str:
    out = []
    for alias, name in (("n", "normal"), ("f", "foil")):
        for field in ("direct_low", "high", "low", "market", "mid"):
            value = cents(f"{alias}.{field}")
            if field != "direct_low":
                value = f"CASE WHEN {alias}.product_id IS NOT NULL THEN coalesce({value}, 0) END"
            out.append(f"{value} AS {name}_{field}")
    return ", ".join(out)


PRICE_CTES = PRICES.format(columns=_price_columns())
PRICE_NAMES = [f"{v}_{f}" for v in ("normal", "foil") for f in ("direct_low", "high", "low", "market", "mid")]


def _price_json(name: str, label_: str, has: str) -> str:
    body = json_text(
        *[(f, j_num(f"{name}_{f}")) for f in ("direct_low", "high", "low", "market", "mid")], ("sub_type_name", f"'\"{label_}\"'")
    )
    return f"CASE WHEN {has} THEN {body} ELSE 'null' END"


# ---------------------------------------------------------------- orders

ORDER_JSON = json_text(
    ("o_custkey", j_num("o_custkey")),
    ("o_orderstatus", j_str("o_orderstatus")),
    ("total_cents", j_num(cents("o_totalprice"))),
    ("o_orderpriority", j_str("o_orderpriority")),
)
ORDERS = f"""
  h AS (SELECT o_orderkey, o_custkey, o_orderstatus, {cents('o_totalprice')} AS total_cents, o_orderpriority,
      md5({ORDER_JSON}) AS content_hash FROM orders),
  s AS (SELECT o_orderkey, o_custkey, o_orderstatus, total_cents,
      CASE WHEN o_orderkey % 7 = 0 THEN 'OLD' ELSE o_orderpriority END AS o_orderpriority,
      CASE WHEN o_orderkey % 7 = 0 THEN md5(content_hash) ELSE content_hash END AS content_hash,
      CASE WHEN o_orderkey % 11 <> 0 THEN CAST(3 AS BIGINT) END AS data_version FROM h WHERE o_orderkey % 5 <> 0)
"""
KIND = """CASE WHEN s.o_orderkey IS NULL THEN 'new' WHEN h.content_hash <> s.content_hash THEN 'changed'
  WHEN s.data_version IS NULL THEN 'unstamped' ELSE 'unchanged' END"""

# ---------------------------------------------------------------- customers

CUSTOMER_UPDATES = """
  u AS (SELECT CASE WHEN c_custkey % 6 = 0 THEN c_custkey ELSE -c_custkey - 1 END AS k,
      CASE WHEN c_custkey % 9 <> 0 THEN lower(c_name) END AS name, lower(c_mktsegment) AS segment,
      c_custkey % 12 = 0 AS only_name FROM customer WHERE c_custkey % 3 = 0)
"""


def merged_customers(join: str) -> str:
    return f"""WITH {CUSTOMER_UPDATES}
      SELECT coalesce(c.c_custkey, u.k) AS c_custkey,
        CASE WHEN u.k IS NOT NULL THEN u.name ELSE c.c_name END AS c_name,
        CASE WHEN u.k IS NOT NULL AND NOT only_name THEN u.segment ELSE c.c_mktsegment END AS segment,
        CAST(c.c_nationkey AS BIGINT) AS nation,
        CASE WHEN u.k IS NOT NULL AND NOT only_name THEN NULL ELSE {cents('c.c_acctbal')} END AS balance
      FROM customer c {join} JOIN u ON c.c_custkey = u.k"""


# ---------------------------------------------------------------- matching

PROMO = "^(PR?|A)-[0-9]{3}"


def match_keys() -> str:
    every = f"list_filter(coalesce(codes, []) || [array_to_string(codes, '/'), number_text, {primary()}], lambda e: e IS NOT NULL)"
    usable = (
        f"list_filter(list_transform({every}, lambda e: CASE WHEN regexp_matches(e, '{PROMO}') "
        "THEN nullif(regexp_extract(e, 'PR-[0-9]+/(.+)', 1), '') ELSE e END), lambda e: e IS NOT NULL)"
    )
    keyed = f"list_transform(CASE WHEN codes IS NULL THEN {usable} ELSE {usable} || [array_to_string(codes, '/')] END, lambda e: {form('e')})"
    return f"list_distinct(list_filter({keyed}, lambda e: e <> ''))"


SIDES = f"""
  {CAT}, {coded()}, {SRC},
  l AS (SELECT product_id, {match_keys()} AS keys, coalesce(codes, []) AS exact,
      CASE WHEN set_name IS NOT NULL THEN [lower(trim(set_name))] WHEN product_id % 2 = 0 THEN [] END AS sets
    FROM coded WHERE card_type IS DISTINCT FROM 'Sealed Product'),
  allrows AS (SELECT product_id, coalesce(codes, []) AS exact FROM coded),
  r AS (SELECT row_id, code, list_transform(string_split(code, '/'), lambda e: {form('e')}) AS keys,
      CASE WHEN set_name IS NOT NULL THEN [lower(trim(set_name))] END AS sets FROM src),
  lk AS (SELECT product_id, sets, unnest(keys) AS key FROM l),
  rk AS (SELECT row_id, sets, unnest(keys) AS key FROM r),
  found AS (SELECT product_id, min(row_id) AS row_id FROM lk JOIN rk USING (key)
    WHERE lk.sets IS NULL OR rk.sets IS NULL OR list_has_any(lk.sets, rk.sets) GROUP BY product_id)
"""

# ---------------------------------------------------------------- facets

FACETS = """
  raw AS (SELECT 'p_type' AS field, p_type AS value, NULL::DOUBLE AS number FROM part
    UNION ALL SELECT 'p_brand', p_brand, NULL FROM part
    UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR), CAST(p_size AS DOUBLE) FROM part
    UNION ALL SELECT 'words', unnest(string_split(p_name, ' ')), NULL FROM part
    UNION ALL SELECT 'label', unnest([{type_label}, p_brand]), NULL FROM part),
  vals AS (SELECT DISTINCT field, value, number FROM raw),
  placed AS (SELECT field, value, CAST(row_number() OVER (PARTITION BY field ORDER BY number NULLS LAST,
      list_transform(string_split(value, ' '), lambda w: lower(w)), value) AS BIGINT) AS position FROM vals)
""".replace("{type_label}", label("p_type", NARROW))

GROUPS = """
  g AS (SELECT CAST(n_nationkey AS BIGINT) AS group_id, CASE WHEN n_nationkey % 5 = 0 THEN n_name || ' Deck' ELSE n_name END AS name,
      1700000000 - n_nationkey * 86400 AS published FROM nation)
"""


# ---------------------------------------------------------------- search


def name_terms(x: str) -> str:
    t = f"trim(lower({x}))"
    return f"coalesce(list_transform(range(1, length({t}) + 1), lambda n: substr({t}, 1, n)), [])"


def code_terms(codes: str = "codes") -> str:
    c = "lower(c)"
    head = f"string_split({c}, '-')[1]"
    whole = f"({head} || '-' || string_split({c}, '-')[2])"
    one = (
        f"[substr({c}, 1, 1), {head}] || list_transform(range(length({head}) + 1, length({whole}) + 1), "
        f"lambda n: substr({whole}, 1, n)) || CASE WHEN {head} = 're' THEN [{c}] ELSE [] END"
    )
    return f"list_distinct(flatten(list_transform({codes}, lambda c: {one})))"


SEARCHABLE = f"""
  {CAT}, {coded()},
  named AS (SELECT product_id, {search_name('raw_name')} AS clean_name, codes FROM coded WHERE codes IS NOT NULL),
  listed AS (SELECT product_id, codes, list_sort(list_distinct({name_terms('clean_name')} || {code_terms()})) AS terms FROM named),
  indexed AS (SELECT product_id, codes, terms, md5({j_list('terms')}) AS search_hash FROM listed)
"""

LOGS = f"""
  logs AS (SELECT event_id, ts, user_id, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'WARNING' ELSE 'INFO' END AS level,
      {cents('value')} AS cents, 'code ' || CAST(user_id % 5 AS VARCHAR) AS message, 'hour ' || strftime(ts, '%H') AS context FROM events)
"""
BAND = "CASE WHEN rate >= 0.10 THEN 'CRITICAL' WHEN rate >= 0.05 THEN 'WARNING' ELSE 'OK' END"

RUNS = """
  e AS (SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS a, max(ts) AS b, count(*) AS items_processed,
      count(*) FILTER (event_type = 'error') AS n_errors FROM events GROUP BY ALL),
  r AS (SELECT CAST(user_id AS VARCHAR) || '/' || strftime(day, '%Y-%m-%d') AS run_id,
      CAST(user_id * 1000 + dayofyear(day) AS BIGINT) AS version, CASE WHEN n_errors = 0 THEN 'completed' ELSE 'failed' END AS sync_status,
      a, CAST(floor((epoch_us(b) - epoch_us(a)) / 1000000.0 + 0.5) AS BIGINT) AS sync_duration, items_processed, n_errors FROM e)
"""

ORDER_RULES = {
    "price": "o_totalprice > 50000",
    "status": "o_orderstatus IN ('O', 'F')",
    "priority": "(o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '2-%')",
}

SNAPSHOT = """
  SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events
"""

CLEAN_CTES = f"""
  {CAT}, {coded()}, {GROUPS},
  {display_steps('raw_name', 'coded', 'product_id', "coalesce(len(list_filter(codes, lambda n: starts_with(n, 'PR-'))) > 0, false)")},
  clean AS (SELECT c.product_id, s.name, {search_name('raw_name')} AS clean_name, codes, {primary()} AS primary_card_number,
      array_to_string(codes, '/') AS full_card_number, nullif({TYPE}, '') AS card_type,
      {priority_first(label_list('category', '[;·]', WIDE))} AS cats, {parse_number('cost_text')} AS cost, {parse_number('power_text')} AS power,
      {ruled_text('description')} AS description, {elements_of()} AS elements, nullif(job, '') AS job, rarity, {NON_CARD} AS is_non_card,
      CASE WHEN g.name IS NULL THEN [] ELSE [g.name] END AS sets,
      CASE WHEN {IMAGES['valid']} THEN coalesce({IMAGES['low_url']}, {IMAGES['high_url']}, {IMAGES['full_url']}, '{REST}') ELSE '{REST}' END AS low_res_url,
      raw_name, nullif(number_text, '') AS number, nullif(category, '') AS raw_category
    FROM coded c JOIN shown s ON c.product_id = s.id LEFT JOIN g USING (group_id))
"""
CARD_JSON = json_text(
    ("name", j_str("raw_name")),
    ("cleanName", j_str("raw_name")),
    ("modifiedOn", "'\"2024-01-01\"'"),
    ("cardType", j_str("card_type")),
    ("number", j_str("number")),
    ("rarity", j_str("rarity")),
    ("cost", j_num("CAST(cost AS BIGINT)")),
    ("power", j_num("CAST(power AS BIGINT)")),
    ("elements", j_list("elements")),
    ("set", "'[\"Unknown\"]'"),
    ("category", j_str("raw_category")),
    ("cardNumbers", j_list("codes")),
    ("fullCardNumber", j_str("full_card_number")),
)


def enriched(stored: bool) -> str:
    """CTEs that end in ``o``: matched cards with merged fields.

    ``stored``: the second source went through its own table first, so texts are translated twice, rows
    have a composite key and of several rows with one key the last counts.
    """
    if stored:
        set_name = "coalesce(set_name, 'row ' || row_id)"
        doc = f"replace(code, '/', ';') || '_' || regexp_replace({set_name}, '[^a-zA-Z0-9]', '', 'g')"
        sd = (
            f"sd AS (SELECT * REPLACE ({set_name} AS set_name, {translated('text')} AS text), {doc} AS doc_id FROM src "
            f"QUALIFY row_number() OVER (PARTITION BY {doc} ORDER BY row_id DESC) = 1)"
        )
    else:
        sd = "sd AS (SELECT *, replace(code, '/', ';') || '_' || lpad(CAST(row_id AS VARCHAR), 12, '0') AS doc_id FROM src)"
    cats = f"{label_list('s.category_1', '·', NARROW)} || {label_list('s.category_2', '·', NARROW)}"
    valid = f"list_filter({parts('s.code', '/')}, lambda n: regexp_matches(n, '{VALID_SOURCE}'))"
    every = "list_filter(coalesce(codes, []) || [full_card_number, number, primary_card_number], lambda e: e IS NOT NULL)"
    usable = (
        f"list_filter(list_transform({every}, lambda e: CASE WHEN regexp_matches(e, '{PROMO}') "
        "THEN nullif(regexp_extract(e, 'PR-[0-9]+/(.+)', 1), '') ELSE e END), lambda e: e IS NOT NULL)"
    )
    keyed = f"list_transform(CASE WHEN codes IS NULL THEN {usable} ELSE {usable} || [full_card_number] END, lambda e: {form('e')})"
    promo = f"coalesce(len(list_filter(c.codes, lambda n: regexp_matches(n, '{PROMO}'))) > 0, false)"
    source_text = translated("s.text")
    return f"""{CLEAN_CTES}, {SRC}, {sd},
      lk AS (SELECT product_id, list_transform(sets, lambda x: lower(trim(x))) AS sets, unnest(list_distinct({keyed})) AS key FROM clean WHERE NOT is_non_card),
      rk AS (SELECT doc_id, lower(trim(set_name)) AS set_name, unnest(list_transform(string_split(code, '/'), lambda e: {form('e')})) AS key FROM sd),
      m AS (SELECT product_id, min(doc_id) AS doc_id FROM lk JOIN rk USING (key)
        WHERE key <> '' AND (rk.set_name IS NULL OR list_contains(lk.sets, rk.set_name)) GROUP BY product_id),
      j AS (SELECT c.*, s.*, {promo} AS promo, {valid} AS ok, {cats} AS both_cats, {source_text} AS new_text,
          CASE WHEN s.set_name IS NULL THEN [] ELSE [s.set_name] END AS new_sets,
          [CASE WHEN {SRC_CRYSTAL.replace('type', 's.type').replace('code', 's.code')} THEN 'Crystal' WHEN s.element = '火' THEN 'Fire' WHEN s.element = '水' THEN 'Water' ELSE s.element END] AS new_elements,
          CASE WHEN {SRC_CRYSTAL.replace('type', 's.type').replace('code', 's.code')} THEN 'Crystal' ELSE s.type END AS new_type,
          CASE WHEN s.type = 'Summon' THEN '' ELSE s.job END AS new_job,
          CASE WHEN {promo} THEN 'Promo' ELSE CASE s.rarity WHEN 'C' THEN 'Common' WHEN 'R' THEN 'Rare' WHEN 'H' THEN 'Hero' WHEN 'L' THEN 'Legend' WHEN 'S' THEN 'Starter' ELSE s.rarity END END AS new_rarity,
          s.name AS s_name, s.cost AS s_cost, s.power AS s_power, s.text AS s_text, s.doc_id AS s_doc
        FROM m JOIN clean c USING (product_id) JOIN sd s USING (doc_id)),
      k AS (SELECT *, list_filter(both_cats, lambda e: contains(e, 'DFF')) || both_cats AS all_cats,
          ok || list_filter(coalesce(codes, []), lambda n: starts_with(n, 'Re-')) AS all_codes FROM j),
      o AS (SELECT product_id, s_doc AS doc_id,
          CASE WHEN promo OR (regexp_matches(name, '\\(.*?\\)') AND regexp_matches(name, 'Full Art|Promo|Road|Champion|Anniversary', 'i')) THEN name ELSE s_name END AS name,
          new_type AS card_type, new_job AS job, new_rarity AS rarity,
          CASE WHEN len(ok) > 0 THEN {distinct_in_order('all_codes')} END AS new_codes,
          CASE WHEN len(ok) > 0 THEN array_to_string({distinct_in_order('all_codes')}, '/') END AS full_card_number,
          CASE WHEN len(ok) > 0 THEN coalesce(list_filter(ok, lambda n: NOT starts_with(n, 'Re-'))[1], ok[1]) END AS primary_card_number,
          CASE WHEN len(all_cats) > 0 THEN array_to_string({distinct_in_order('all_cats')}, '·') WHEN len(cats) > 0 THEN array_to_string(cats, '·') END AS category,
          s_cost AS cost, s_power AS power,
          CASE WHEN trim(s_text) <> '' THEN CASE WHEN trim(new_text) <> '' AND length(new_text) * 2 >= length(s_text) THEN new_text ELSE s_text END
            ELSE nullif(description, '') END AS description,
          array_to_string(CASE WHEN list_sort(list_transform(elements, lambda e: lower(e))) = list_transform(new_elements, lambda e: lower(e)) THEN elements ELSE new_elements END, '|') AS elements,
          array_to_string(CASE WHEN list_transform(sets, lambda e: lower(trim(e))) = list_transform(new_sets, lambda e: lower(trim(e))) THEN sets ELSE new_sets END, '|') AS set
        FROM k)"""


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["column_scan"] = "SELECT o_orderkey, o_orderpriority FROM orders"
    q["point_lookup"] = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey = 77"
    q["row_count"] = "SELECT count(*) AS n_rows FROM lineitem"
    q["equality_filter"] = "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'"
    q["older_rows"] = "SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-06-01'"
    q["prefix_filter"] = "SELECT p_partkey, p_brand FROM part WHERE p_brand LIKE 'Brand#1%'"
    q["substring_filter"] = "SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%red%'"
    q["present_filter"] = f"WITH {CAT} SELECT product_id, number_text FROM cat WHERE number_text IS NOT NULL AND card_type IS NOT NULL"
    q["window_filter"] = (
        "SELECT event_id, user_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-20' AND event_type = 'error'"
    )
    q["page_after"] = "SELECT c_custkey, c_name FROM customer WHERE c_custkey > 70 ORDER BY c_custkey LIMIT 25"
    q["top_groups"] = "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey DESC LIMIT 10"
    q["limit_per_group"] = (
        "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <= 3"
    )
    q["newest_first"] = "SELECT event_id, user_id FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id LIMIT 20"
    q["index_order"] = "SELECT p_name, p_size, p_partkey FROM part ORDER BY p_name, p_size DESC"

    q["attribute_lookup"] = (
        "SELECT event_id, json_extract_string(props, '$.k') AS k_text, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_number FROM events"
    )
    q["number_parse"] = (
        f"WITH {CAT} SELECT product_id, CAST({parse_number('cost_text')} AS BIGINT) AS cost, {parse_integer('power_text')} AS power FROM cat"
    )
    q["cents_normalize"] = (
        f"SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {cents('l_extendedprice')} AS price_cents, "
        f"{cents('l_discount')} AS discount_cents, {cents('-l_tax')} AS negative_cents FROM lineitem"
    )
    q["code_normalize"] = (
        f"WITH {CAT}, {coded()} SELECT product_id, array_to_string(codes, '|') AS codes, {primary()} AS primary_code, "
        "array_to_string(codes, '/') AS full_code, coalesce(len(list_filter(codes, lambda n: regexp_matches(n, '"
        + PROMO + "'))) > 0, false) AS is_promo FROM coded"
    )
    q["code_compare"] = (
        f"WITH {CAT}, a AS (SELECT 'part' AS origin, p_partkey AS id, p_brand AS v FROM part UNION ALL SELECT 'customer', c_custkey, c_name FROM customer "
        f"UNION ALL SELECT 'catalogue', product_id, number_text FROM cat) SELECT origin, id, {form('v')} AS form, {loose('v')} AS loose FROM a"
    )
    q["label_normalize"] = (
        "WITH a AS (SELECT 'part' AS origin, p_partkey AS id, p_type AS v FROM part UNION ALL SELECT 'customer', c_custkey, c_mktsegment FROM customer "
        f"UNION ALL SELECT 'region', CAST(r_regionkey AS BIGINT), r_name FROM region) SELECT origin, id, {label('v')} AS wide, {label('v', NARROW)} AS narrow FROM a"
    )
    q["list_normalize"] = (
        f"WITH {CAT}, a AS (SELECT product_id, {label_list('category', '[;·]', WIDE)} AS c FROM cat), "
        f"b AS (SELECT product_id, {priority_first('c')} AS c FROM a) "
        "SELECT product_id, CASE WHEN len(c) > 0 THEN array_to_string(c, '·') END AS category, CAST(len(c) AS BIGINT) AS n_categories FROM b"
    )
    q["category_merge"] = (
        f"WITH {SRC}, a AS (SELECT row_id, {label_list('category_1', '·', NARROW)} || {label_list('category_2', '·', NARROW)} AS c FROM src), "
        "b AS (SELECT row_id, list_filter(c, lambda x: contains(x, 'DFF')) || c AS c FROM a) "
        f"SELECT row_id, array_to_string({distinct_in_order('c')}, '|') AS categories FROM b"
    )
    q["search_names"] = f"WITH {CAT} SELECT product_id, {search_name('raw_name')} AS clean_name FROM cat"
    q["display_names"] = (
        f"WITH {CAT}, {display_steps('raw_name', 'cat', 'product_id', 'product_id % 9 = 1')} SELECT id AS product_id, name FROM shown"
    )
    nested = rf"^(.*?){SP}*\(\d+{SP}+\((.*?)\)$"
    kept = "|".join(rf"\({k}\)" for k in KEPT.split("|")) + rf"|\(({MONTHS})"
    month_year = rf"(regexp_matches(raw_name, '{MONTHS}') AND regexp_matches(raw_name, '\b\d{{4}}\b'))"
    q["name_repair"] = (
        f"WITH {CAT}, a AS (SELECT product_id, raw_name AS old, CASE WHEN regexp_matches(raw_name, '{nested}') AND NOT {month_year} "
        rf"THEN regexp_replace(raw_name, '{nested}', '\1 (\2)') WHEN regexp_matches(raw_name, '\([A-C1-9]([^)]|$)') AND NOT regexp_matches(raw_name, '{kept}') "
        rf"AND NOT {month_year} THEN trim(regexp_replace(raw_name, '{SP}*\([A-C1-9][^)]*$', '')) ELSE raw_name END AS raw_name FROM cat) "
        "SELECT product_id, raw_name FROM a WHERE raw_name <> old"
    )
    q["text_rules"] = (
        f"WITH a AS (SELECT doc_id, {ruled_text('text')} AS t FROM documents) "
        "SELECT doc_id, md5(t) AS ruled_md5, CAST(length(t) AS BIGINT) AS ruled_length FROM a"
    )
    q["text_translate"] = f"WITH {CAT} SELECT product_id, {translated('description')} AS description FROM cat"
    q["text_precedence"] = (
        f"WITH {CAT}, {SRC}, a AS (SELECT product_id, description AS own, text AS raw, {translated('text')} AS done FROM cat JOIN src ON product_id = row_id) "
        "SELECT product_id, CASE WHEN trim(raw) <> '' THEN CASE WHEN trim(done) <> '' AND length(done) * 2 >= length(raw) THEN done ELSE raw END ELSE nullif(own, '') END AS description, "
        "CASE WHEN coalesce(length(done), 0) * 2 < length(raw) THEN 'raw' WHEN coalesce(length(done), 0) < floor(length(raw) * 0.8::DOUBLE) THEN 'warn' ELSE 'ok' END AS level FROM a"
    )
    status = "CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled' ELSE o_orderstatus END"
    q["dictionary_translate"] = f"SELECT o_orderkey, {status} AS status, {status} || '|Filled' AS statuses FROM orders"
    q["rarity_labels"] = (
        f"WITH {CAT} SELECT product_id, CASE WHEN product_id % 9 = 1 THEN 'Promo' WHEN rarity = 'C' THEN 'Common' WHEN rarity = 'R' THEN 'Rare' "
        "WHEN rarity = 'H' THEN 'Hero' WHEN rarity = 'L' THEN 'Legend' WHEN rarity = 'S' THEN 'Starter' ELSE rarity END AS rarity FROM cat"
    )
    q["element_rules"] = (
        f"WITH {CAT} SELECT product_id, array_to_string({elements_of()}, '|') AS elements, {TYPE} AS card_type, {NON_CARD} AS is_non_card FROM cat"
    )
    q["source_element_rules"] = (
        f"WITH {SRC} SELECT row_id, {SRC_ELEMENT} AS elements, CASE WHEN {SRC_CRYSTAL} THEN 'Crystal' ELSE type END AS card_type, "
        "CASE WHEN type = 'Summon' THEN '' ELSE job END AS job FROM src"
    )
    shown = ", ".join(f"{sql} AS {name}" for name, sql in URLS.items())
    q["url_variants"] = (
        f"WITH {CAT}, a AS (SELECT 'page' AS origin, page_id AS id, url FROM pages UNION ALL SELECT 'image', product_id, image_url FROM cat), "
        f"b AS (SELECT origin, id, url, {shown} FROM a) SELECT origin, id, valid, full_url, high_url, low_url, "
        f"CASE WHEN valid THEN coalesce(full_url, high_url, low_url, '{REST}') ELSE '{REST}' END AS full_res_url, "
        f"CASE WHEN valid THEN coalesce(low_url, high_url, full_url, '{REST}') ELSE '{REST}' END AS low_res_url, "
        "CASE WHEN coalesce(url, '') = '' THEN 'Image URL missing' WHEN NOT valid THEN 'Invalid image URL' END AS reason FROM b"
    )
    q["image_paths"] = f"WITH {CAT} SELECT product_id, " + ", ".join(
        f"'{POLICY.root}/' || group_id || '/' || product_id || '{suffix}.jpg' AS {name}_path"
        for name, suffix in (("full", "_in_1000x1000"), ("high", "_400w"), ("low", "_200w"))
    ) + " FROM cat"
    q["composite_key_roundtrip"] = (
        "SELECT DISTINCT l_partkey, l_suppkey, l_partkey || ';' || l_suppkey || '_' || CASE WHEN l_partkey % 3 > 0 THEN 'Set' || (l_suppkey % 7) ELSE 'Unknown' END AS doc_id, "
        "l_partkey || '/' || l_suppkey AS code FROM lineitem"
    )
    q["code_repair"] = (
        f"WITH {CAT}, {coded()} SELECT product_id, array_to_string(list_filter(codes, lambda n: NOT starts_with(n, 'Re-')) || [codes[1]], '|') AS card_numbers "
        "FROM coded WHERE starts_with(codes[1], 'Re-')"
    )

    q["code_validity"] = (
        f"WITH {CAT}, a AS (SELECT product_id, number_text, {compact('number_text')} AS c FROM cat) SELECT product_id, {normal_code('c')} AS code, "
        f"regexp_matches(number_text, '{VALID}') AS is_valid, regexp_matches(number_text, '{VALID_SOURCE}') AS is_valid_source, "
        "regexp_replace(number_text, '[A-Z]$', '') AS stem FROM a"
    )
    q["special_names"] = (
        f"WITH {CAT} SELECT product_id, regexp_matches(raw_name, '\\(.*?\\)') AND regexp_matches(raw_name, 'Full Art|Promo|Road|Champion|Anniversary', 'i') AS is_special FROM cat"
    )
    q["array_rules"] = (
        "WITH x AS (SELECT p_partkey, string_split(p_name, ' ') AS a, [upper(p_type), 'ring', 'red'] AS b FROM part), "
        "y AS (SELECT *, a || b AS ab, list_sort(a) AS sa, list_sort([a[2], upper(a[1])]) AS sb FROM x) "
        f"SELECT p_partkey, array_to_string({distinct_in_order('ab')}, '|') AS ordered, array_to_string(list_sort(list_distinct(ab)), '|') AS sorted, "
        "list_has_any(a, b) AS overlap, list_transform(sa, lambda e: lower(e)) = list_transform(sb, lambda e: lower(e)) AS same, "
        "array_to_string(CASE WHEN list_contains(a, 'bolt') THEN a ELSE a || ['bolt'] END, '|') AS appended FROM y"
    )
    q["first_rows"] = "SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey LIMIT 10"

    q["variant_pivot"] = f"WITH {PRICE_CTES} SELECT product_id, {', '.join(PRICE_NAMES)}, has_n OR has_f AS is_valid FROM v"
    q["price_hash"] = (
        f"WITH {PRICE_CTES} SELECT product_id, md5("
        + json_text(("normal", _price_json("normal", "Normal", "has_n")), ("foil", _price_json("foil", "Foil", "has_f")))
        + ") AS content_hash FROM v WHERE has_n OR has_f"
    )
    q["price_change_pct"] = (
        "WITH m AS (SELECT l_partkey AS product_id, date_trunc('month', l_shipdate) AS month, "
        f"CAST(floor(CAST(sum({cents('l_extendedprice')}) AS DOUBLE) / CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE)) AS BIGINT) AS market FROM lineitem GROUP BY ALL), "
        "p AS (SELECT *, lag(market) OVER (PARTITION BY product_id ORDER BY month) AS previous FROM m) "
        "SELECT product_id, strftime(month, '%Y-%m') AS month, market, previous, "
        "CAST(floor(CAST((market - previous) * 10000 AS DOUBLE) / nullif(previous, 0) + 0.5) AS BIGINT) AS change_bp FROM p"
    )

    nation = json_text(("groupId", j_num("n_nationkey")), ("modifiedOn", j_str("n_name")))
    q["content_hash"] = (
        f"SELECT 'nation' AS origin, CAST(n_nationkey AS BIGINT) AS id, md5({nation}) AS content_hash FROM nation "
        f"UNION ALL SELECT 'orders', o_orderkey, md5({ORDER_JSON}) FROM orders"
    )
    record = json_text(
        ("c_custkey", j_num("c_custkey")), ("c_mktsegment", j_str("c_mktsegment")), ("c_name", j_str("c_name")), ("c_nationkey", j_num("c_nationkey"))
    )
    q["record_hash"] = f"SELECT c_custkey, md5({record}) AS content_hash FROM customer"
    src_common = [
        ("code", j_str("code")),
        ("element", f"'[\"' || CASE WHEN {SRC_CRYSTAL} THEN 'Crystal' ELSE element END || '\"]'"),
        ("rarity", j_str("rarity")),
        ("cost", j_num("nullif(cost, 0)")),
        ("power", j_num("nullif(power, 0)")),
        ("category_1", j_str("category_1")),
        ("category_2", j_str("category_2")),
    ]
    src_end = [
        ("multicard", j_str("multicard")),
        ("ex_burst", j_str("ex_burst")),
        ("set", "CASE WHEN set_name IS NULL THEN '[]' ELSE '[\"' || set_name || '\"]' END"),
    ]
    own = "list_sort(string_split(code, '/'))"
    labels_json = "'[' || '\"' || category_1 || '\"' || coalesce(',\"' || category_2 || '\"', '') || ']'"
    q["source_hash"] = (
        f"WITH {SRC} SELECT row_id, md5({json_text(*src_common, *src_end, ('cardNumbers', j_list(own)))}) AS content_hash, "
        f"md5({json_text(*src_common, ('categories', labels_json), *src_end, ('cardNumbers', j_list('list_sort(string_split(code, $$/$$) || [$$Re-004C$$])')))}) AS match_hash FROM src"
    )
    q["change_classify"] = f"WITH {ORDERS} SELECT h.o_orderkey, {KIND} AS change_kind FROM h LEFT JOIN s ON h.o_orderkey = s.o_orderkey"
    forced = KIND.replace("ELSE 'unchanged'", "ELSE 'forced'")
    q["force_classify"] = f"WITH {ORDERS} SELECT h.o_orderkey, {forced} AS change_kind FROM h LEFT JOIN s ON h.o_orderkey = s.o_orderkey"
    q["write_stamp"] = (
        f"WITH {ORDERS} SELECT h.o_orderkey, CAST(4 AS BIGINT) AS data_version, '2024-05-01 12:30' AS written_at "
        f"FROM h LEFT JOIN s ON h.o_orderkey = s.o_orderkey WHERE {KIND} <> 'unchanged'"
    )
    q["group_restore"] = (
        "SELECT user_id, event_id FROM events WHERE ts <= TIMESTAMP '2024-01-10' AND event_type = 'click' "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
    )
    q["error_append"] = (
        f"WITH {RUNS} SELECT run_id, CASE WHEN items_processed % 2 = 1 THEN CASE WHEN n_errors > 0 THEN 'first' ELSE '' END "
        "WHEN n_errors > 0 THEN 'first|late' ELSE 'late' END AS errors FROM r"
    )
    q["run_validation"] = (
        f"WITH {RUNS} SELECT sync_status, count(*) AS checked, count(*) FILTER (n_errors BETWEEN 1 AND 2) AS valid, "
        "count(*) FILTER (n_errors >= 3) AS failed_sync_end, CAST(0 AS BIGINT) AS failed_sync_status, "
        "CAST(0 AS BIGINT) AS failed_card_count, count(*) FILTER (n_errors = 0) AS failed_sync_errors FROM r GROUP BY 1"
    )
    q["price_validation"] = (
        f"WITH {PRICE_CTES} SELECT count(*) AS checked, count(*) FILTER (product_id % 3 > 0 AND NOT (has_n AND product_id % 5 = 0)) AS valid, "
        "count(*) FILTER (product_id % 3 = 0) AS failed_last_updated, count(*) FILTER (has_n AND product_id % 5 = 0) AS failed_normal_mid, "
        "CAST(0 AS BIGINT) AS failed_foil_mid FROM v"
    )
    good = f"starts_with(low, 'https://img.') AND regexp_matches(low, '_[24]00w\\.jpg$') AND regexp_matches(high, '_[24]00w\\.jpg$')"
    image_cte = (
        f"i AS (SELECT product_id, group_id, image_url, {IMAGES['valid']} AS ok, {IMAGES['full_url']} AS f, {IMAGES['high_url']} AS h, {IMAGES['low_url']} AS l FROM cat), "
        f"u AS (SELECT *, CASE WHEN ok THEN coalesce(l, h, f, '{REST}') ELSE '{REST}' END AS low, CASE WHEN ok THEN coalesce(h, f, l, '{REST}') ELSE '{REST}' END AS high, "
        "NOT ok OR coalesce(f, h, l) IS NULL AS missing FROM i)"
    )
    q["image_validation"] = (
        f"WITH {CAT}, {image_cte} SELECT group_id, count(*) AS checked, count(*) FILTER ({good} AND NOT missing) AS valid, "
        f"count(*) FILTER (NOT ({good})) AS failed_url_pattern, count(*) FILTER (missing) AS failed_no_placeholder FROM u GROUP BY 1"
    )
    q["card_images"] = (
        f"WITH {CAT}, {image_cte} SELECT product_id, missing AS is_placeholder, image_url AS original_url, "
        "CASE WHEN coalesce(image_url, '') = '' THEN 'Image URL missing' WHEN NOT ok THEN 'Invalid image URL' END AS error_message, "
        "CAST(1 AS BIGINT) AS data_version FROM u"
    )
    q["planned_run"] = (
        "SELECT 'groups' AS step, count(*) AS processed, count(*) AS updated FROM nation UNION ALL SELECT 'cards', count(*), count(*) FROM part"
    )
    q["run_record"] = (
        "SELECT CAST(1 AS BIGINT) AS version, (SELECT count(*) FROM part) AS card_count, (SELECT count(*) FROM nation) AS group_count, "
        "'completed' AS sync_status, false AS search_indexed, CAST(0 AS BIGINT) AS n_errors"
    )
    q["single_group_run"] = (
        f"WITH {CAT}, {GROUPS}, one AS (SELECT product_id, group_id, {search_name('raw_name')} AS clean_name FROM cat WHERE group_id = 7) "
        "SELECT product_id, group_id, clean_name, coalesce(g.name, '') AS set FROM one LEFT JOIN g USING (group_id)"
    )
    q["feed_rejects"] = (
        f"WITH {GROUPS} SELECT 'rejected' AS kind, '{{broken ' || c_name AS text, (SELECT count(*) FROM customer) AS n FROM customer "
        "UNION ALL SELECT 'stored', name, (SELECT count(*) FROM nation) FROM g"
    )
    q["stream_rejects"] = (
        "SELECT 'rejected' AS kind, event_id FROM events WHERE event_type = 'error' UNION ALL SELECT 'stored', event_id FROM "
        "(SELECT event_id FROM events WHERE event_type <> 'error' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)"
    )
    q["run_counters"] = (
        f"WITH {ORDERS}, c AS (SELECT h.o_orderstatus, {KIND} AS kind FROM h LEFT JOIN s ON h.o_orderkey = s.o_orderkey) "
        "SELECT o_orderstatus, count(*) AS items_processed, count(*) FILTER (kind <> 'unchanged') AS items_updated, CAST(0 AS BIGINT) AS n_errors FROM c GROUP BY 1"
    )
    fields = ["o_custkey", "o_orderstatus", "total_cents", "o_orderpriority", "content_hash"]
    q["reconcile"] = (
        f"WITH {ORDERS}, feed AS (SELECT * FROM h WHERE o_orderkey % 13 <> 0), "
        f"c AS (SELECT coalesce(h.o_orderkey, s.o_orderkey) AS o_orderkey, CASE WHEN h.o_orderkey IS NULL THEN 'kept' ELSE {KIND} END AS change_kind, "
        "s.data_version AS old_version, " + ", ".join(f"h.{f} AS h_{f}, s.{f} AS s_{f}" for f in fields)
        + " FROM feed h FULL JOIN s ON h.o_orderkey = s.o_orderkey) SELECT o_orderkey, "
        + ", ".join(f"CASE WHEN change_kind IN ('kept', 'unchanged') THEN s_{f} ELSE h_{f} END AS {f}" for f in fields)
        + ", CASE WHEN change_kind IN ('kept', 'unchanged') THEN old_version ELSE CAST(4 AS BIGINT) END AS data_version, change_kind FROM c"
    )
    q["reject_rows"] = (
        f"WITH {CAT} SELECT product_id, concat_ws('|', CASE WHEN card_type IS NULL THEN 'type' END, CASE WHEN number_text IS NULL THEN 'number' END) AS reasons FROM cat"
    )
    q["upsert_merge"] = merged_customers("FULL")
    q["update_existing"] = merged_customers("LEFT")
    q["replace_rows"] = (
        f"WITH {CUSTOMER_UPDATES} SELECT c_custkey, c_name, c_mktsegment AS segment FROM customer WHERE c_custkey NOT IN (SELECT k FROM u) "
        "UNION ALL SELECT k, name, segment FROM u"
    )
    q["fill_missing"] = (
        "WITH n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT c_custkey, "
        "coalesce(CASE WHEN c_custkey % 4 = 0 THEN c_custkey END, n, 0) AS n_orders FROM customer LEFT JOIN n ON c_custkey = o_custkey"
    )

    yearly = (
        "y AS (SELECT o_custkey AS product_id, year(o_orderdate) * 10000000000 + o_orderkey AS data_version, o_orderkey, o_orderstatus FROM orders)"
    )
    q["delta_log"] = (
        f"WITH {yearly} SELECT product_id, data_version, o_orderkey, o_orderstatus FROM y "
        "QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY data_version DESC) = 1"
    )
    q["version_since"] = f"WITH {yearly} SELECT product_id, data_version FROM y WHERE data_version > 19979999999999"
    q["daily_snapshot"] = (
        f"SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_id, event_type, {cents('value')} AS cents FROM ({SNAPSHOT}) WHERE rn = 1"
    )
    q["retention_purge"] = "SELECT event_id, event_type FROM events WHERE ts IS NULL OR ts >= TIMESTAMP '2024-01-15'"
    q["retention_counts"] = (
        "SELECT event_type, count(*) FILTER (ts < TIMESTAMP '2024-01-15') AS n_deleted, count(*) FILTER (ts >= TIMESTAMP '2024-01-15') AS n_kept FROM events GROUP BY 1"
    )
    q["dropped_column"] = f"WITH {CAT} SELECT count(*) AS n_rows, count(element) AS n_affected FROM cat"
    q["state_reset"] = "SELECT event_id, CASE WHEN event_type = 'error' THEN 'ready' ELSE event_type END AS event_type FROM events"
    q["latest_at_or_before"] = (
        "SELECT user_id, event_id, event_type FROM events WHERE ts <= TIMESTAMP '2024-01-10' "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
    )
    q["as_of_join"] = (
        f"SELECT c.event_id, c.user_id, e.event_id AS error_id, {cents('e.value')} AS cents FROM events c LEFT JOIN events e "
        "ON c.user_id = e.user_id AND e.event_type = 'error' AND e.ts <= c.ts WHERE c.event_type = 'click' "
        "QUALIFY row_number() OVER (PARTITION BY c.event_id ORDER BY e.ts DESC NULLS LAST, e.event_id DESC) = 1"
    )
    q["rolling_mean"] = (
        f"SELECT event_id, CAST(sum({cents('value')}) OVER w AS BIGINT) AS rolling_sum, count(value) OVER w AS rolling_n FROM events "
        "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"
    )

    q["first_match_join"] = f"WITH {SIDES} SELECT product_id, row_id FROM found"
    q["tiered_match"] = f"""WITH {SIDES},
      t1 AS (SELECT product_id, pos, row_id FROM (SELECT product_id, unnest(exact) AS code, unnest(range(len(exact))) AS pos FROM allrows) a JOIN src USING (code)),
      t2 AS (SELECT product_id, row_id FROM lk JOIN rk USING (key)),
      u AS (SELECT product_id, 1 AS tier, pos, row_id FROM t1 UNION ALL SELECT product_id, 2, 0, row_id FROM t2)
      SELECT product_id, row_id, CAST(tier AS BIGINT) AS tier FROM u QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY tier, pos, row_id) = 1"""
    agree = " + ".join(
        f"CASE WHEN l.{p} = r.{p} THEN 1 ELSE 0 END" for p in ("power", "cost", "job", "rarity")
    )
    q["scored_match"] = f"""WITH a AS (SELECT p_partkey, p_partkey % 97 AS stem, CAST(p_size AS VARCHAR) AS power, p_type AS cost, p_name AS job, p_brand AS rarity FROM part),
      l AS (SELECT p_partkey, stem, power, nullif(cost, 'SMALL') AS cost, job, rarity FROM a),
      r AS (SELECT * FROM a)
      SELECT l.p_partkey, count(*) AS n_matches, min(r.p_partkey) AS s_partkey FROM l JOIN r ON l.stem = r.stem AND ({agree}) >= 2 GROUP BY 1"""
    q["key_set_difference"] = (
        "WITH l AS (SELECT DISTINCT c_custkey AS k FROM customer), r AS (SELECT DISTINCT o_custkey * 2 AS k FROM orders) "
        "SELECT coalesce(l.k, r.k) AS k, CASE WHEN r.k IS NULL THEN 'left' ELSE 'right' END AS side FROM l FULL JOIN r ON l.k = r.k WHERE l.k IS NULL OR r.k IS NULL"
    )
    q["orphan_check"] = "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey * 2 FROM lineitem)"
    q["child_counts"] = (
        "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, count(c_custkey) AS n_customers FROM nation "
        "LEFT JOIN customer ON n_nationkey = c_nationkey * 2 GROUP BY ALL"
    )
    q["group_totals"] = (
        "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n_customers, "
        "(SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS n_suppliers FROM nation"
    )
    q["backfill_count"] = (
        "WITH n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT c_custkey, "
        "coalesce(CASE WHEN c_custkey % 2 = 0 THEN CAST(99 AS BIGINT) END, n, 0) AS n_orders FROM customer LEFT JOIN n ON c_custkey = o_custkey"
    )
    q["insert_absent"] = (
        "SELECT c_custkey, c_name FROM customer WHERE c_name IN (SELECT c_name FROM customer WHERE c_acctbal > 5000) "
        "AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')"
    )
    q["attach_parent"] = f"WITH {GROUPS} SELECT c_custkey, coalesce(g.name, '') AS set FROM customer LEFT JOIN g ON group_id = c_nationkey + 3"

    q["field_priority_merge"] = """WITH l AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 > 0 THEN c_name END AS name,
        CASE WHEN c_custkey % 5 = 0 THEN '  ' ELSE c_mktsegment END AS segment, ['b', c_mktsegment] AS tags,
        CASE WHEN c_custkey % 3 > 0 THEN CAST(c_nationkey AS BIGINT) END AS nation FROM customer),
      r AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 8 > 0 THEN upper(c_name) END AS name, lower(c_mktsegment) AS segment,
        c_custkey % 6 = 0 AS fresh, CAST(c_nationkey + 100 AS BIGINT) AS nation FROM customer WHERE c_custkey % 2 = 0),
      m AS (SELECT l.k, l.name AS ln, l.segment AS ls, l.tags AS lt, l.nation AS lg,
        CASE WHEN r.k IS NULL THEN l.name ELSE r.name END AS name, CASE WHEN r.k IS NULL THEN l.segment ELSE r.segment END AS segment,
        CASE WHEN r.fresh THEN ['new'] ELSE l.tags END AS tags, CASE WHEN r.k IS NOT NULL AND l.nation IS NULL THEN r.nation ELSE l.nation END AS nation
        FROM l LEFT JOIN r ON l.k = r.k)
      SELECT k AS c_custkey, name, segment, array_to_string(tags, '|') AS tags, nation,
        concat_ws('|', CASE WHEN name IS DISTINCT FROM ln THEN 'name' END, CASE WHEN segment IS DISTINCT FROM ls THEN 'segment' END,
          CASE WHEN tags IS DISTINCT FROM lt THEN 'tags' END, CASE WHEN nation IS DISTINCT FROM lg THEN 'nation' END) AS changed_fields FROM m"""
    q["field_compare"] = f"WITH {CAT}, {SRC}, p AS (SELECT cat.*, src.type AS s_type, src.job AS s_job, src.rarity AS s_rarity FROM cat JOIN src ON product_id = row_id) " + " UNION ALL ".join(
        f"SELECT product_id, '{f}' AS field, {f} AS left_value, {s} AS right_value, {f} IS NOT DISTINCT FROM {s} AS equal FROM p"
        for f, s in (("card_type", "s_type"), ("job", "s_job"), ("rarity", "s_rarity"))
    )
    q["card_cleaning"] = f"""WITH {CLEAN_CTES} SELECT product_id, name, clean_name, primary_card_number, full_card_number, card_type,
        CASE WHEN len(cats) > 0 THEN array_to_string(cats, '·') END AS category, CAST(cost AS BIGINT) AS cost, description,
        array_to_string(elements, '|') AS elements, job, rarity, is_non_card, array_to_string(sets, '|') AS set, low_res_url,
        md5({CARD_JSON}) AS content_hash FROM clean"""
    q["card_enrichment"] = f"WITH {enriched(stored=False)} SELECT * EXCLUDE (new_codes) FROM o"
    merged = ("name", "card_type", "job", "rarity", "full_card_number", "category", "cost", "power", "description", "elements", "set")
    unmatched = """SELECT product_id, name, clean_name, card_type, job, rarity, full_card_number,
        CASE WHEN len(cats) > 0 THEN array_to_string(cats, '·') END AS category, CAST(cost AS BIGINT) AS cost, CAST(power AS BIGINT) AS power,
        description, array_to_string(elements, '|') AS elements, array_to_string(sets, '|') AS set, codes FROM clean"""
    columns = ", ".join(f"CASE WHEN o.product_id IS NULL THEN c.{f} ELSE o.{f} END AS {f}" for f in merged)
    q["catalogue_run"] = (
        f"WITH {enriched(stored=True)}, c AS ({unmatched}), z AS (SELECT c.product_id, c.clean_name, {columns}, "
        "CASE WHEN o.product_id IS NULL THEN c.codes ELSE o.new_codes END AS codes FROM c LEFT JOIN o USING (product_id)) "
        f"SELECT * EXCLUDE (codes), CASE WHEN codes IS NOT NULL THEN CAST(len(list_distinct({name_terms('clean_name')} || {code_terms()})) AS BIGINT) END AS n_terms FROM z"
    )

    crystal = SRC_CRYSTAL.replace("type", "s.type").replace("code", "s.code")
    image = "CASE WHEN NOT c.is_non_card AND s.row_id % 3 > 0 THEN '{0}/' || s.row_id ELSE '{1}' END"
    q["source_repairs"] = (
        f"WITH {CLEAN_CTES}, {SRC} SELECT product_id, CAST(coalesce(c.cost, s.cost) AS BIGINT) AS cost, "
        "CAST(coalesce(c.power, s.power) AS BIGINT) AS power, c.is_non_card AND s.type = '' AS is_non_card, "
        f"CASE WHEN c.is_non_card AND s.type = '' THEN c.card_type WHEN {crystal} THEN 'Crystal' ELSE s.type END AS card_type, "
        f"{image.format('full', REST)} AS full_res_url, {image.format('full', REST)} AS high_res_url, {image.format('thumb', REST)} AS low_res_url "
        "FROM clean c JOIN src s ON c.product_id = s.row_id"
    )
    q["manual_overrides"] = f"WITH {CAT} SELECT product_id, product_id % 10 = 0 AS overridden FROM cat"
    q["facet_values"] = f"WITH {FACETS} SELECT field, value FROM vals"
    q["ordered_facets"] = f"WITH {FACETS} SELECT field, value, position FROM placed"
    q["facet_hash"] = (
        f"WITH {FACETS}, d AS (SELECT field, list(value ORDER BY position) AS v FROM placed GROUP BY field) "
        f"SELECT field, CAST(0 AS BIGINT) AS page, array_to_string(v, '|') AS values, md5({j_list('v')}) AS hash FROM d"
    )
    q["facet_fields"] = (
        f"WITH {FACETS}, d AS (SELECT field, list(value ORDER BY position) AS v FROM placed GROUP BY field) "
        f"SELECT field, CAST(len(v) AS BIGINT) AS n_values, md5('[\"' || md5({j_list('v')}) || '\"]') AS hash FROM d"
    )
    earlier = FACETS.replace("FROM part", "FROM part WHERE p_size < 40")
    q["facet_changes"] = (
        f"WITH now AS (WITH {FACETS} SELECT field, list(value ORDER BY position) AS v FROM placed GROUP BY 1), "
        f"old AS (WITH {earlier} SELECT field, list(value ORDER BY position) AS v FROM placed GROUP BY 1) "
        "SELECT field, now.v IS DISTINCT FROM old.v AS updated FROM now FULL JOIN old USING (field)"
    )
    q["distinct_values"] = "SELECT DISTINCT o_orderpriority AS value FROM orders WHERE o_orderpriority IS NOT NULL"
    q["ordered_sets"] = (
        f"WITH {GROUPS} SELECT name AS set_name, regexp_matches(name, 'Deck|Collection|Promo') AS is_supplemental FROM g "
        "WHERE group_id IN (SELECT c_nationkey FROM customer)"
    )

    q["prefix_terms"] = (
        f"SELECT 'customer' AS origin, c_custkey AS id, array_to_string({name_terms('c_name')}, '|') AS terms FROM customer "
        f"UNION ALL SELECT 'part', p_partkey, array_to_string({name_terms('p_name')}, '|') FROM part"
    )
    q["code_terms"] = (
        f"WITH {CAT}, {coded()} SELECT product_id, CASE WHEN codes IS NULL THEN '' ELSE array_to_string(list_sort({code_terms()}), '|') END AS terms FROM coded"
    )
    q["index_terms"] = f"WITH {SEARCHABLE} SELECT product_id, CAST(len(terms) AS BIGINT) AS n_terms, search_hash FROM indexed"
    q["index_refresh"] = (
        f"WITH {SEARCHABLE} SELECT product_id, CASE WHEN product_id % 5 = 0 THEN 'new' WHEN product_id % 7 = 0 THEN 'changed' "
        "WHEN product_id % 11 = 0 THEN 'unstamped' ELSE 'unchanged' END AS change_kind FROM indexed"
    )
    q["index_in_place"] = (
        f"WITH {SEARCHABLE} SELECT product_id, CASE WHEN product_id % 7 = 0 OR product_id % 5 = 0 THEN 'changed' "
        "WHEN product_id % 11 = 0 THEN 'unstamped' ELSE 'unchanged' END AS change_kind, search_hash FROM indexed"
    )
    q["index_rebuild"] = f"WITH {SEARCHABLE} SELECT term, count(*) AS n_rows FROM (SELECT unnest(terms) AS term FROM indexed) GROUP BY 1"
    q["term_index"] = f"WITH {SEARCHABLE} SELECT term, count(*) AS n_rows FROM (SELECT unnest(terms) AS term FROM indexed) GROUP BY 1"
    q["term_search"] = f"WITH {SEARCHABLE} SELECT product_id FROM indexed WHERE list_contains(terms, 'red') ORDER BY product_id LIMIT 50"
    q["code_search"] = f"WITH {SEARCHABLE} SELECT product_id FROM indexed WHERE list_contains(codes, 'C-004')"

    since = "ts >= TIMESTAMP '2024-01-05'"
    span = "ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-25'"
    q["error_rate"] = (
        f"WITH {LOGS}, c AS (SELECT count(*) FILTER (level = 'ERROR') AS n_errors, count(*) AS n_logs FROM logs WHERE {since}), "
        f"d AS (SELECT *, n_errors / nullif(n_logs, 0) AS rate FROM c) SELECT n_errors, n_logs, {BAND} AS band FROM d"
    )
    q["error_patterns"] = (
        f"WITH {LOGS}, n AS (SELECT message FROM logs WHERE level = 'ERROR' ORDER BY ts DESC, event_id DESC LIMIT 100) SELECT message, count(*) AS n FROM n GROUP BY 1"
    )
    q["error_aggregate"] = (
        f"WITH {LOGS} SELECT message, count(*) AS n, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_occurrence, "
        f"count(DISTINCT context) AS n_contexts FROM logs WHERE {since} AND level = 'ERROR' GROUP BY 1"
    )
    q["error_contexts"] = (
        f"WITH {LOGS} SELECT message, context, count(*) AS n, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_occurrence "
        f"FROM logs WHERE {since} AND level = 'ERROR' GROUP BY 1, 2"
    )
    q["log_summary"] = (
        f"WITH {LOGS} SELECT count(*) FILTER (level = 'ERROR') AS n_errors, count(*) FILTER (level = 'WARNING') AS n_warnings, "
        f"CAST(sum(cents) AS BIGINT) AS total_duration, count(cents) AS n_durations FROM logs WHERE {span}"
    )
    q["top_errors"] = f"WITH {LOGS} SELECT message, count(*) AS n FROM logs WHERE {span} AND level = 'ERROR' GROUP BY 1 ORDER BY n DESC, message LIMIT 3"
    failed = ", ".join(f"count(*) FILTER (NOT {r}) AS failed_{n}" for n, r in ORDER_RULES.items())
    q["validation_report"] = (
        f"SELECT o_orderpriority, count(*) AS checked, count(*) FILTER ({' AND '.join(ORDER_RULES.values())}) AS valid, {failed} FROM orders GROUP BY 1"
    )
    q["validation_errors"] = " UNION ALL ".join(
        f"SELECT o_orderkey, '{n}' AS rule FROM orders WHERE NOT {r}" for n, r in ORDER_RULES.items()
    )
    q["match_counters"] = (
        f"WITH {SIDES} SELECT (SELECT count(*) FROM part) AS total_rows, count(*) AS matches_found, count(*) FILTER (product_id <> row_id) AS rows_updated FROM found"
    )
    q["run_health"] = (
        f"WITH {RUNS} SELECT count(*) AS n_runs, count(*) FILTER (sync_status = 'completed') AS n_completed, "
        "CAST(floor(avg(sync_duration) FILTER (sync_status = 'completed') + 0.5) AS BIGINT) AS mean_duration, "
        "max(version) FILTER (sync_status = 'completed') AS latest_good_version FROM r"
    )
    q["next_version"] = f"WITH {RUNS} SELECT coalesce(max(version), 0) + 1 AS version FROM r"
    q["run_alerts"] = (
        f"WITH {RUNS}, d AS (SELECT *, n_errors / nullif(items_processed, 0) AS rate FROM r) SELECT run_id, sync_duration, sync_duration > 3600 AS duration_alert, {BAND} AS error_band FROM d"
    )
    q["current_run"] = f"WITH {RUNS} SELECT run_id, sync_status, version FROM r ORDER BY a DESC, run_id DESC LIMIT 1"
    q["run_summary"] = "SELECT l_suppkey AS run_id, " + ", ".join(
        f"nullif(count(*) FILTER (l_returnflag = '{s}'), 0) AS {s.lower()}_processed, "
        f"CASE WHEN count(*) FILTER (l_returnflag = '{s}') > 0 THEN count(*) FILTER (l_returnflag = '{s}' AND l_linestatus = 'F') END AS {s.lower()}_updated"
        for s in ("A", "N", "R")
    ) + " FROM lineitem GROUP BY 1"
    q["size_summary"] = "SELECT source, count(*) AS total_files, CAST(sum(n_chars) AS BIGINT) AS total_size FROM documents GROUP BY 1"
    q["within_size"] = "SELECT doc_id, n_chars FROM documents WHERE n_chars BETWEEN 1024 AND 10485760"
    detail = "concat_ws(',', '\"job\":\"' || job || '\"', '\"element\":\"' || element || '\"')"
    q["null_stripping"] = (
        f"WITH {CAT} SELECT product_id, '{{' || concat_ws(',', '\"card_type\":\"' || card_type || '\"', '\"detail\":{{' || nullif({detail}, '') || '}}', "
        "'\"rarity\":\"' || rarity || '\"') || '}' AS record FROM cat"
    )
    q["price_feed"] = (
        f"WITH {PRICE_CTES} SELECT product_id, sub AS sub_type_name, count(*) AS n_rows, CAST(sum({cents('high')}) AS BIGINT) AS high_cents, "
        "count(market) AS n_market, count(*) AS n_places FROM p GROUP BY ALL"
    )
    q["stream_upsert"] = (
        f"SELECT CAST(user_id AS VARCHAR) || '/' || strftime(ts, '%Y-%m-%d') AS snapshot_key, user_id, event_id, event_type FROM ({SNAPSHOT}) WHERE rn = 1"
    )
    q["envelope_feed"] = q["price_feed"]
    q["envelope_checks"] = (
        f"WITH {PRICE_CTES}, e AS (SELECT product_id // 256 AS envelope, count(*) AS n FROM p GROUP BY 1) "
        "SELECT CAST(envelope AS BIGINT) AS envelope, CASE WHEN envelope % 4 IN (0, 3) THEN n ELSE 0 END AS n_records, "
        "CAST(CASE WHEN envelope % 4 > 1 THEN 1 ELSE 0 END AS BIGINT) AS n_unreadable, "
        "CASE envelope % 4 WHEN 0 THEN n WHEN 3 THEN n + 1 ELSE 0 END AS n_elements FROM e"
    )
    q["image_objects"] = (
        "SELECT page_id, CAST(CASE WHEN page_id % 3 < 2 THEN 4 ELSE 0 END + octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n_bytes, "
        "CASE page_id % 3 WHEN 0 THEN 'jpeg' WHEN 1 THEN 'png' END AS kind FROM pages"
    )
    q["emptied_table"] = "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'P'"
    q["stream_quarantine"] = (
        f"WITH {PRICE_CTES} SELECT DISTINCT 'taken' AS outcome, CAST(product_id AS BIGINT) AS id, sub AS sub_type_name FROM p WHERE product_id // 256 % 3 <> 2 "
        "UNION ALL SELECT DISTINCT 'set aside', CAST(product_id // 256 AS BIGINT), NULL FROM p WHERE product_id // 256 % 3 = 2"
    )
    return q
