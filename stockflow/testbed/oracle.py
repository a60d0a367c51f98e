"""For each query, an independent ANSI-SQL statement over the driver's tables.

"""

from __future__ import annotations

from .nested import FIRST_PULL, SECOND_PULL, STORES

PRODUCTS = """products AS (
    SELECT CAST(p_partkey AS BIGINT) AS product_id, 'SKU-' || p_partkey AS sku, p_brand AS artist, p_name AS title,
        CASE p_size % 4 WHEN 0 THEN 'LP' WHEN 1 THEN 'CD' WHEN 2 THEN '7"' ELSE 'Cassette' END AS format,
        p_type AS genre, CASE WHEN p_partkey % 9 < 5 THEN 'New' ELSE 'Used' END AS condition,
        CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(30 + p_partkey % 40 AS DECIMAL(4,0))
            * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS cost,
        CAST(p_retailprice AS DECIMAL(12,2)) AS price, CAST(1960 + p_partkey % 60 AS INTEGER) AS release_year
    FROM part)"""

SALES = """sales AS (
    SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT)) AS sale_id, l_orderkey AS k,
        CAST(o_orderdate AS DATE) AS sale_date, r_name AS location, product_id,
        CAST(l_quantity AS BIGINT) AS quantity, price AS unit_price,
        CAST(CASE l_orderkey % 20 WHEN 0 THEN 5 WHEN 1 THEN 2 WHEN 2 THEN 2 ELSE 0 END AS DECIMAL(12,2)) AS discount,
        CAST(CAST(l_quantity AS BIGINT) * (price - CAST(CASE l_orderkey % 20 WHEN 0 THEN 5 WHEN 1 THEN 2 WHEN 2 THEN 2
            ELSE 0 END AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS net_amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN products ON l_partkey = product_id
        JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey)"""

INVENTORY = """month_ends AS (
    SELECT DISTINCT last_day(CAST(o_orderdate AS DATE)) AS snapshot_date FROM orders
    WHERE CAST(o_orderdate AS DATE) > (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - 365),
grid AS (
    SELECT snapshot_date, r_name, r_regionkey, p_partkey,
        (p_partkey * 7 + r_regionkey * 13 + month(snapshot_date) * 5) % 23 AS wave
    FROM part CROSS JOIN region CROSS JOIN month_ends),
inventory AS (
    SELECT snapshot_date, r_name AS location, CAST(p_partkey AS BIGINT) AS product_id,
        CAST(greatest(0, wave - 8) AS INTEGER) AS quantity_on_hand,
        CAST(CASE WHEN wave <= 8 THEN 0 ELSE (p_partkey * 31 + r_regionkey * 17 + month(snapshot_date) * 3) % 320 END
            AS INTEGER) AS days_in_stock,
        CAST(1 + (p_partkey + r_regionkey) % 3 AS INTEGER) AS reorder_level
    FROM grid),
latest AS (SELECT * FROM inventory WHERE snapshot_date = (SELECT max(snapshot_date) FROM inventory))"""

RECENT = """last_sale AS (SELECT max(sale_date) AS d FROM sales)"""

RAW_PRODUCTS = """raw_products AS (
    SELECT CAST(product_id AS VARCHAR) AS product_id, CASE WHEN product_id % 40 <> 0 THEN sku END AS sku,
        CASE WHEN product_id % 10 = 0 THEN '  ' || artist || ' ' ELSE artist END AS artist,
        CASE WHEN product_id % 14 = 0 THEN title || '  ' ELSE title END AS title,
        CASE WHEN product_id % 15 = 0 THEN ' ' || format ELSE format END AS format,
        CASE product_id % 12 WHEN 1 THEN lower(genre) WHEN 2 THEN ' ' || lower(genre) || '/FUNK'
            WHEN 3 THEN 'hip-' || lower(genre) ELSE genre END AS genre,
        CASE product_id % 7 WHEN 0 THEN upper(condition) WHEN 1 THEN lower(condition) || ' ' ELSE condition END
            AS condition,
        CASE WHEN product_id % 211 <> 0 THEN CAST(cost AS VARCHAR) END AS cost,
        CASE WHEN product_id % 223 = 0 THEN '0.00' WHEN product_id % 227 = 0 THEN '1,234.50'
            WHEN product_id % 12 = 0 THEN '$' || CAST(price AS VARCHAR) ELSE CAST(price AS VARCHAR) END AS price,
        CASE WHEN product_id % 27 <> 0 THEN CAST(release_year AS VARCHAR) || '.0' END AS release_year
    FROM products, (VALUES (1), (2)) AS c(n) WHERE n = 1 OR product_id % 75 = 0)"""

RAW_SALES = """raw_sales AS (
    SELECT sale_id,
        CASE WHEN k % 97 = 0 THEN 'not a date' WHEN k % 8 = 0 THEN strftime(sale_date, '%-m/%-d/%Y')
            ELSE CAST(sale_date AS VARCHAR) END AS sale_date,
        CASE k % 12 WHEN 0 THEN upper(location) WHEN 1 THEN lower(location) ELSE ' ' || location || '  ' END AS location,
        CASE WHEN k % 101 = 0 THEN 'X' || product_id ELSE CAST(product_id AS VARCHAR) END AS product_id,
        CASE WHEN k % 113 = 0 THEN '1.5' WHEN k % 109 = 0 THEN quantity || '.0' ELSE CAST(quantity AS VARCHAR) END
            AS quantity,
        CASE WHEN k % 103 = 0 THEN '1,234.50' WHEN k % 16 = 0 THEN '$' || CAST(unit_price AS VARCHAR)
            ELSE CAST(unit_price AS VARCHAR) END AS unit_price,
        CASE WHEN k % 20 = 0 THEN NULL WHEN k % 107 = 0 THEN 'n/a' ELSE CAST(discount AS VARCHAR) END AS discount
    FROM sales, (VALUES (1), (2)) AS c(n) WHERE n = 1 OR k % 83 = 0)"""

RAW_INVENTORY = """raw_inventory AS (
    SELECT CASE WHEN product_id % 401 = 0 THEN 'unknown'
            WHEN product_id % 8 = 0 THEN strftime(snapshot_date, '%-m/%-d/%Y')
            ELSE CAST(snapshot_date AS VARCHAR) END AS snapshot_date,
        CASE product_id % 12 WHEN 0 THEN upper(location) WHEN 1 THEN lower(location) ELSE ' ' || location END AS location,
        CASE WHEN product_id % 131 = 0 THEN 'X' || product_id ELSE CAST(product_id AS VARCHAR) END AS product_id,
        CAST(quantity_on_hand AS VARCHAR) AS quantity_on_hand,
        CASE WHEN product_id % 137 = 0 THEN days_in_stock || '.0' ELSE CAST(days_in_stock AS VARCHAR) END
            AS days_in_stock,
        CASE WHEN product_id % 31 = month(snapshot_date) THEN NULL ELSE CAST(reorder_level AS VARCHAR) END
            AS reorder_level
    FROM inventory, (VALUES (1), (2)) AS c(n) WHERE n = 1 OR product_id % 125 = 0)"""


def _title(x: str) -> str:
    """Character by character: upper after anything that is no letter, else lower."""
    t = f"trim({x})"
    letter = f"CASE WHEN i = 1 OR NOT regexp_matches({t}[i - 1], '[A-Za-z]') THEN upper({t}[i]) ELSE lower({t}[i]) END"
    return f"array_to_string(list_transform(range(1, length({t}) + 1), lambda i: {letter}), '')"


def _money(x: str) -> str:
    return f"TRY_CAST(trim(ltrim(trim({x}), '$')) AS DECIMAL(12,2))"


def _integer(x: str, kind: str = "INTEGER") -> str:
    d = f"TRY_CAST(trim({x}) AS DECIMAL(38,18))"
    return f"CASE WHEN {d} = floor({d}) THEN CAST({d} AS {kind}) END"


def _date(x: str) -> str:
    return f"CAST(coalesce(try_strptime({x}, '%Y-%m-%d'), try_strptime({x}, '%m/%d/%Y')) AS DATE)"


def _dbl(x: str, name: str | None = None) -> str:
    return f"CAST({x} AS DOUBLE) AS {name or x}"


def _big(x: str, name: str) -> str:
    return f"CAST({x} AS BIGINT) AS {name}"


TYPED_PRODUCTS = f"""typed_products AS (
    SELECT product_id, sku, trim(artist) AS artist, trim(title) AS title, trim(format) AS format,
        {_title('genre')} AS genre, {_title('condition')} AS condition, {_money('cost')} AS cost,
        {_money('price')} AS price, {_integer('release_year')} AS release_year, copies, raw_price
    FROM (SELECT *, price AS raw_price, count(*) AS copies FROM raw_products GROUP BY ALL)),
good_products AS (SELECT * FROM typed_products WHERE price IS NOT NULL AND cost IS NOT NULL AND price > 0)"""

TYPED_SALES = f"""typed_sales AS (
    SELECT *, quantity * (unit_price - discount) AS net_amount,
        CASE WHEN sale_date IS NULL THEN 'unparseable date'
            WHEN product_id NOT IN (SELECT product_id FROM good_products) THEN 'unknown product'
            WHEN quantity IS NULL THEN 'invalid quantity' WHEN unit_price IS NULL THEN 'invalid unit price'
        END AS reject_reason
    FROM (SELECT sale_id, {_date('sale_date')} AS sale_date, {_title('location')} AS location, product_id,
            {_integer('quantity', 'BIGINT')} AS quantity, {_money('unit_price')} AS unit_price,
            coalesce({_money('discount')}, 0) AS discount, copies,
            sale_date AS raw_date, location AS raw_location, discount AS raw_discount
        FROM (SELECT *, count(*) AS copies FROM raw_sales GROUP BY ALL)))"""

TYPED_INVENTORY = f"""parsed_inventory AS (
    SELECT {_date('snapshot_date')} AS snapshot_date, {_title('location')} AS location, product_id,
        {_integer('quantity_on_hand')} AS quantity_on_hand, {_integer('days_in_stock')} AS days_in_stock,
        {_integer('reorder_level')} AS reorder_level, copies
    FROM (SELECT *, count(*) AS copies FROM raw_inventory GROUP BY ALL)),
medians AS (
    SELECT location AS m_location, CAST(floor(median(reorder_level) + 0.5) AS INTEGER) AS m
    FROM parsed_inventory GROUP BY location),
typed_inventory AS (
    SELECT snapshot_date, location, product_id, quantity_on_hand, days_in_stock,
        coalesce(reorder_level, m) AS reorder_level, copies, reorder_level IS NULL AS was_missing,
        CASE WHEN product_id NOT IN (SELECT product_id FROM good_products) THEN 'unknown product'
            WHEN snapshot_date IS NULL THEN 'unparseable date'
            WHEN quantity_on_hand IS NULL THEN 'invalid quantity'
            WHEN days_in_stock IS NULL THEN 'invalid days in stock'
            WHEN coalesce(reorder_level, m) IS NULL THEN 'no reorder level' END AS reject_reason
    FROM parsed_inventory LEFT JOIN medians ON location = m_location)"""

P, S, I = [PRODUCTS], [PRODUCTS, SALES], [INVENTORY]
PSI = [PRODUCTS, SALES, RECENT, INVENTORY]
RP = [PRODUCTS, RAW_PRODUCTS]
RS = [PRODUCTS, SALES, RAW_SALES]
RI = [INVENTORY, RAW_INVENTORY]
CP = [*RP, TYPED_PRODUCTS]
CS = [PRODUCTS, SALES, RAW_PRODUCTS, RAW_SALES, TYPED_PRODUCTS, TYPED_SALES]
CI = [PRODUCTS, INVENTORY, RAW_PRODUCTS, RAW_INVENTORY, TYPED_PRODUCTS, TYPED_INVENTORY]


def _sql(views: list[str], select: str) -> str:
    return f"WITH {', '.join(views)}\n{select}" if views else select


PROFIT = "sum(quantity * (unit_price - discount - cost))"
REV = _dbl("sum(net_amount)", "revenue")
UNITS = _big("sum(quantity)", "units")
SP = "sales JOIN products USING (product_id)"


def _margin(keys: str, units: bool = False) -> str:
    return f"""SELECT {keys}, {UNITS + ',' if units else ''} {REV}, {_dbl(PROFIT, 'gross_profit')},
        round(100.0 * CAST({PROFIT} AS DOUBLE) / CAST(sum(net_amount) AS DOUBLE), 1) AS margin_pct
    FROM {SP} GROUP BY {keys}"""


def _sell_through(by: str, facts: str) -> str:
    return f"""SELECT {by}, {_big('sum(sold)', 'units_sold')}, {_big('sum(held)', 'units_on_hand')},
        round(100.0 * CAST(sum(sold) AS DOUBLE) / nullif(CAST(sum(sold) + sum(held) AS DOUBLE), 0), 1)
            AS sell_through_pct
    FROM ({facts}) GROUP BY {by}"""


BY_GENRE = """SELECT genre, coalesce(units_sold, 0) AS sold, coalesce(on_hand, 0) AS held FROM products
    LEFT JOIN (SELECT product_id, sum(quantity) AS units_sold FROM sales GROUP BY product_id) USING (product_id)
    LEFT JOIN (SELECT product_id, sum(quantity_on_hand) AS on_hand FROM latest GROUP BY product_id) USING (product_id)"""

BY_STORE = """SELECT coalesce(l.location, s.location) AS location, coalesce(units_sold, 0) AS sold,
        coalesce(quantity_on_hand, 0) AS held
    FROM latest l FULL OUTER JOIN
        (SELECT location, product_id, sum(quantity) AS units_sold FROM sales GROUP BY location, product_id) s
        ON l.location = s.location AND l.product_id = s.product_id"""

TRANSFERS = """transfers AS (
    SELECT o.location AS from_location, u.location AS to_location, artist, title, format, genre,
        o.quantity_on_hand AS from_qty, o.days_in_stock AS from_days_sitting,
        CAST(coalesce(units_90d, 0) AS BIGINT) AS to_location_demand_90d,
        CAST(least(o.quantity_on_hand - o.reorder_level, (o.quantity_on_hand + 1) // 2) AS INTEGER)
            AS suggested_transfer_qty,
        coalesce(units_90d, 0) * price AS est_90d_revenue_at_dest, o.product_id
    FROM latest o JOIN latest u ON o.product_id = u.product_id AND o.location <> u.location
        JOIN products p ON p.product_id = o.product_id
        LEFT JOIN (SELECT location, product_id, sum(quantity) AS units_90d FROM sales
            WHERE sale_date >= (SELECT d FROM last_sale) - 90 GROUP BY location, product_id) d
            ON d.location = u.location AND d.product_id = u.product_id
    WHERE o.quantity_on_hand >= 5 AND u.quantity_on_hand = 0),
unique_transfers AS (
    SELECT * FROM transfers QUALIFY row_number() OVER (PARTITION BY to_location, artist, title
        ORDER BY est_90d_revenue_at_dest DESC, from_days_sitting DESC, product_id, from_location) = 1)"""

STOCKOUTS = """stockouts AS (
    SELECT location, artist, title, genre, CAST(units_60d AS BIGINT) AS sold_last_60d_all_stores
    FROM latest JOIN products USING (product_id) JOIN (SELECT product_id, sum(quantity) AS units_60d FROM sales
        WHERE sale_date >= (SELECT d FROM last_sale) - 60 GROUP BY product_id) USING (product_id)
    WHERE quantity_on_hand = 0)"""

TR_COLUMNS = """from_location, to_location, artist, title, format, genre, from_qty, from_days_sitting,
    to_location_demand_90d, suggested_transfer_qty, CAST(est_90d_revenue_at_dest AS DOUBLE) AS est_90d_revenue_at_dest"""

AGING = f"""SELECT label AS age_bucket, {_big('sum(quantity_on_hand)', 'units')},
        round(100.0 * CAST(sum(quantity_on_hand) AS DOUBLE) / (SELECT CAST(sum(quantity_on_hand) AS DOUBLE) FROM latest), 1)
            AS pct_of_units
    FROM latest JOIN (VALUES (0, 30, 'a. 0-30 days'), (31, 60, 'b. 31-60 days'), (61, 90, 'c. 61-90 days'),
        (91, 1000000, 'd. 90+ days')) AS bucket(low, high, label) ON days_in_stock BETWEEN low AND high
    WHERE quantity_on_hand > 0 GROUP BY label"""

TOP = """SELECT artist, title, format, genre, condition, CAST(units AS BIGINT) AS units, {revenue}
    FROM (SELECT product_id, sum(quantity) AS units, sum(net_amount) AS total FROM sales GROUP BY product_id)
    JOIN products USING (product_id) ORDER BY total DESC, product_id LIMIT 15"""

ANALYSES = {
    "monthly_revenue": _sql(S, f"SELECT strftime(sale_date, '%Y-%m') AS month, {REV}, {UNITS} FROM sales GROUP BY month"),
    "revenue_by_location": _sql(
        S,
        f"""SELECT location, {REV}, {UNITS},
        round(CAST(sum(net_amount) AS DOUBLE) / CAST(sum(quantity) AS DOUBLE), 2) AS avg_net_per_unit
        FROM sales GROUP BY location""",
    ),
    "revenue_by_genre": _sql(S, f"SELECT genre, {REV}, {UNITS} FROM {SP} GROUP BY genre"),
    "revenue_by_format": _sql(S, f"SELECT format, {REV}, {UNITS} FROM {SP} GROUP BY format"),
    "genre_by_location": _sql(S, f"SELECT location, genre, {REV}, {UNITS} FROM {SP} GROUP BY location, genre"),
    "top_products": _sql(S, TOP.format(revenue=_dbl("total", "revenue"))),
    "bottom_products": _sql(
        S,
        """SELECT artist, title, format, genre, condition, CAST(coalesce(u, 0) AS BIGINT) AS units,
            CAST(coalesce(total, 0) AS DOUBLE) AS revenue
        FROM products LEFT JOIN (SELECT product_id, sum(quantity) AS u, sum(net_amount) AS total FROM sales
            GROUP BY product_id) USING (product_id)
        ORDER BY coalesce(u, 0), coalesce(total, 0), product_id LIMIT 15""",
    ),
    "dead_stock": _sql(
        PSI,
        """SELECT location, artist, title, genre, condition, quantity_on_hand, days_in_stock,
            CAST(quantity_on_hand * cost AS DOUBLE) AS cost_tied_up
        FROM latest JOIN products USING (product_id)
        WHERE quantity_on_hand > 0 AND NOT EXISTS (SELECT 1 FROM sales WHERE sales.product_id = latest.product_id
            AND sale_date >= (SELECT d FROM last_sale) - 90)
        ORDER BY quantity_on_hand * cost DESC, product_id, location LIMIT 25""",
    ),
    "overstock": _sql(
        [PRODUCTS, INVENTORY],
        """SELECT location, artist, title, genre, quantity_on_hand, days_in_stock
        FROM latest JOIN products USING (product_id) WHERE quantity_on_hand >= 6 AND days_in_stock >= 60""",
    ),
    "stockouts": _sql([*PSI, STOCKOUTS], "SELECT * FROM stockouts"),
    "aging_buckets": _sql(I, AGING),
    "transfer_recommendations": _sql([*PSI, TRANSFERS], f"SELECT {TR_COLUMNS} FROM transfers"),
    "margin_by_condition": _sql(S, _margin("condition")),
    "margin_by_format_condition": _sql(S, _margin("format, condition", units=True)),
    "margin_by_genre": _sql(S, _margin("genre")),
    "sell_through_by_genre": _sql(PSI, _sell_through("genre", BY_GENRE)),
    "sell_through_by_location": _sql(PSI, _sell_through("location", BY_STORE)),
    "slow_categories": _sql(
        PSI, f"SELECT *, sell_through_pct < 50 AS is_slow FROM ({_sell_through('genre', BY_GENRE)})"
    ),
}

KPIS = {
    "kpi_totals": _sql(
        [*PSI, STOCKOUTS, TRANSFERS],
        f"""SELECT {REV}, {UNITS},
            round(100.0 * CAST({PROFIT} AS DOUBLE) / CAST(sum(net_amount) AS DOUBLE), 1) AS blended_margin_pct,
            (SELECT count(*) FROM stockouts) AS n_stockouts, (SELECT count(*) FROM transfers) AS n_transfers
        FROM {SP}""",
    ),
    "transfer_unique": _sql([*PSI, TRANSFERS], f"SELECT {TR_COLUMNS} FROM unique_transfers"),
    "transfer_top10": _sql(
        [*PSI, TRANSFERS],
        """SELECT to_location, artist || ' — ' || title AS label,
            CAST(est_90d_revenue_at_dest AS DOUBLE) AS est_90d_revenue_at_dest
        FROM unique_transfers t
        ORDER BY t.est_90d_revenue_at_dest DESC, from_days_sitting DESC, product_id, from_location, to_location LIMIT 10""",
    ),
    "transfer_total": _sql(
        [*PSI, TRANSFERS],
        f"SELECT count(*) AS n_opportunities, {_dbl('sum(est_90d_revenue_at_dest)', 'est_revenue')} FROM unique_transfers",
    ),
    "aging_labels": _sql(I, f"SELECT substr(age_bucket, 4) AS age_bucket, units, pct_of_units FROM ({AGING})"),
    "top_products_display": _sql(S, TOP.format(revenue="'$' || format('{:,.2f}', CAST(total AS DOUBLE)) AS revenue")),
    "genre_revenue_ascending": _sql(S, f"SELECT genre, {REV}, {UNITS} FROM {SP} GROUP BY genre"),
    "margin_by_format_display": _sql(
        S,
        f"""SELECT CAST(CASE format WHEN 'LP' THEN 1 WHEN 'CD' THEN 2 WHEN '7"' THEN 3 WHEN 'Cassette' THEN 4 ELSE 5 END
            AS BIGINT) AS format_position, format, condition, margin_pct FROM ({_margin('format, condition')})""",
    ),
    "genre_share_by_location": _sql(
        [*S, f"""rolled AS (SELECT location, genre, sum(net_amount) AS r FROM {SP} GROUP BY location, genre),
        totals AS (SELECT *, (SELECT sum(r) FROM rolled x WHERE x.location = y.location) AS store,
            (SELECT coalesce(sum(r), 0) FROM rolled x WHERE x.genre IS NOT DISTINCT FROM y.genre AND x.location <> y.location) AS og,
            (SELECT sum(r) FROM rolled x WHERE x.location <> y.location) AS oa FROM rolled y)"""],
        """SELECT location, genre, CAST(r AS DOUBLE) AS revenue,
            round(100.0 * (CAST(r AS DOUBLE) / CAST(store AS DOUBLE)), 1) AS share_pct,
            round((CAST(r AS DOUBLE) / CAST(store AS DOUBLE)) / nullif(CAST(og AS DOUBLE) / CAST(oa AS DOUBLE), 0), 2)
                AS ratio_to_other_stores
        FROM totals""",
    ),
    "condition_share": _sql(
        [*S, f"rolled AS (SELECT condition, sum(net_amount) AS r, {PROFIT} AS g FROM {SP} GROUP BY condition)"],
        """SELECT condition, CAST(r AS DOUBLE) AS revenue, CAST(g AS DOUBLE) AS gross_profit,
            round(100.0 * CAST(r AS DOUBLE) / (SELECT CAST(sum(r) AS DOUBLE) FROM rolled), 1) AS revenue_share_pct,
            round(100.0 * CAST(g AS DOUBLE) / (SELECT CAST(sum(g) AS DOUBLE) FROM rolled), 1) AS profit_share_pct
        FROM rolled""",
    ),
}


def _counts(table: str, source: str, counters: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS metric, CAST(coalesce({c}, 0) AS BIGINT) AS value FROM {source}"
        for name, c in counters.items()
    )


_IN = {"rows_loaded": "sum(copies)", "duplicates_removed": "sum(copies - 1)"}
_OUT = {
    "rows_quarantined": "count(*) FILTER (reject_reason IS NOT NULL)",
    "rows_clean": "count(*) FILTER (reject_reason IS NULL)",
}

METRICS = " UNION ALL ".join(
    [
        _counts(
            "products",
            "typed_products",
            {
                **_IN,
                "price_dollar_stripped": "sum(copies) FILTER (raw_price LIKE '$%')",
                "release_year_missing": "count(*) FILTER (release_year IS NULL)",
                "sku_missing": "count(*) FILTER (sku IS NULL)",
                "invalid_price_dropped": "count(*) FILTER (price IS NULL OR cost IS NULL OR price <= 0)",
                "rows_quarantined": "count(*) FILTER (price IS NULL OR cost IS NULL OR price <= 0)",
                "rows_clean": "count(*) FILTER (price > 0 AND cost IS NOT NULL)",
            },
        ),
        _counts(
            "sales",
            "typed_sales",
            {
                **_IN,
                "us_dates_normalized": "count(*) FILTER (raw_date LIKE '%/%')",
                "unparseable_dates_dropped": "count(*) FILTER (sale_date IS NULL)",
                "location_casing_fixed": "count(*) FILTER (sale_date IS NOT NULL AND raw_location <> location)",
                "discounts_filled": "count(*) FILTER (sale_date IS NOT NULL AND raw_discount IS NULL)",
                "unknown_products_dropped": "count(*) FILTER (reject_reason = 'unknown product')",
                **_OUT,
            },
        ),
        _counts(
            "inventory",
            "typed_inventory",
            {
                **_IN,
                "reorder_levels_imputed": "count(*) FILTER (was_missing)",
                "unknown_products_dropped": "count(*) FILTER (reject_reason = 'unknown product')",
                **_OUT,
            },
        ),
    ]
)

PRODUCT_COLUMNS = f"product_id, sku, artist, title, format, genre, condition, {_dbl('cost')}, {_dbl('price')}, release_year"
SALE_COLUMNS = f"""sale_id, sale_date, location, product_id, quantity, {_dbl('unit_price')}, {_dbl('discount')},
    {_dbl('net_amount')}"""
STOCK_COLUMNS = "snapshot_date, location, product_id, quantity_on_hand, days_in_stock, reorder_level"

NULLS = {
    "products": ["product_id", "sku", "artist", "title", "format", "genre", "condition", "cost", "price", "release_year"],
    "sales": ["sale_id", "sale_date", "location", "product_id", "quantity", "unit_price", "discount", "net_amount"],
    "inventory": ["snapshot_date", "location", "product_id", "quantity_on_hand", "days_in_stock", "reorder_level"],
}


def _null_counts(table: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_rows FROM {source}"
        for c in NULLS[table]
    )


ORPHANS = """SELECT '{t}' AS table_name, count(*) AS orphan_rows, count(DISTINCT r.product_id) AS orphan_products
    FROM raw_{t} r WHERE r.product_id NOT IN (SELECT product_id FROM raw_products)"""

CLEANING = {
    "scan_raw_products": _sql(RP, "SELECT * FROM raw_products"),
    "scan_raw_sales": _sql(RS, "SELECT * FROM raw_sales"),
    "scan_raw_inventory": _sql(RI, "SELECT * FROM raw_inventory"),
    "scan_clean_sales": _sql(S, f"SELECT {SALE_COLUMNS} FROM sales"),
    "load_row_counts": _sql(
        [PRODUCTS, SALES, INVENTORY],
        """SELECT 'products' AS table_name, count(*) AS n_rows FROM products UNION ALL SELECT 'sales', count(*) FROM sales
        UNION ALL SELECT 'inventory', count(*) FROM inventory""",
    ),
    "dedupe_exact": _sql(RS, "SELECT DISTINCT * FROM raw_sales"),
    "trim_text": _sql(
        RP, "SELECT product_id, trim(artist) AS artist, trim(title) AS title, trim(format) AS format FROM raw_products"
    ),
    "normalize_case": _sql(
        RP, f"SELECT product_id, {_title('genre')} AS genre, {_title('condition')} AS condition FROM raw_products"
    ),
    "normalize_location": _sql(RS, f"SELECT sale_id, {_title('location')} AS location FROM raw_sales"),
    "clean_money": _sql(
        RS, f"SELECT sale_id, {_dbl(_money('unit_price'), 'unit_price')}, {_dbl(_money('discount'), 'discount')} FROM raw_sales"
    ),
    "parse_mixed_dates": _sql(RS, f"SELECT sale_id, {_date('sale_date')} AS sale_date FROM raw_sales"),
    "cast_integers": _sql(RS, f"SELECT sale_id, {_integer('quantity', 'BIGINT')} AS quantity FROM raw_sales"),
    "cast_years": _sql(RP, f"SELECT product_id, {_integer('release_year')} AS release_year FROM raw_products"),
    "valid_price": _sql(CP, f"SELECT product_id, {_dbl('cost')}, {_dbl('price')} FROM good_products"),
    "valid_date": _sql(
        CS, "SELECT sale_id, sale_date FROM typed_sales WHERE sale_date IS NOT NULL"
    ),
    "fill_discount": _sql(
        RS, f"SELECT sale_id, {_dbl(f'coalesce({_money("discount")}, 0)', 'discount')} FROM raw_sales"
    ),
    "orphans_semi": _sql(
        [*RS, RAW_PRODUCTS],
        "SELECT sale_id, product_id FROM raw_sales WHERE product_id IN (SELECT product_id FROM raw_products)",
    ),
    "orphans_anti": _sql(
        [*RS, RAW_PRODUCTS],
        "SELECT sale_id, product_id FROM raw_sales WHERE product_id NOT IN (SELECT product_id FROM raw_products)",
    ),
    "net_amount": _sql(CS, f"SELECT sale_id, copies, {_dbl('net_amount')} FROM typed_sales"),
    "impute_median": _sql(CI, f"SELECT {STOCK_COLUMNS} FROM typed_inventory"),
    "quality_metrics": _sql([*CS, INVENTORY, RAW_INVENTORY, TYPED_INVENTORY], METRICS),
    "clean_products": _sql(CP, f"SELECT {PRODUCT_COLUMNS} FROM good_products"),
    "clean_sales": _sql(CS, f"SELECT {SALE_COLUMNS} FROM typed_sales WHERE reject_reason IS NULL"),
    "clean_inventory": _sql(CI, f"SELECT {STOCK_COLUMNS} FROM typed_inventory WHERE reject_reason IS NULL"),
    "quarantine_products": _sql(
        CP,
        f"""SELECT {PRODUCT_COLUMNS}, copies, 'invalid price or cost' AS reject_reason FROM typed_products
        WHERE price IS NULL OR cost IS NULL OR price <= 0""",
    ),
    "quarantine_sales": _sql(
        CS, f"SELECT {SALE_COLUMNS}, copies, reject_reason FROM typed_sales WHERE reject_reason IS NOT NULL"
    ),
    "quarantine_inventory": _sql(
        CI, f"SELECT {STOCK_COLUMNS}, copies, reject_reason FROM typed_inventory WHERE reject_reason IS NOT NULL"
    ),
    "dq_duplicate_keys": _sql(
        [*CS, INVENTORY, RAW_INVENTORY, TYPED_INVENTORY],
        """SELECT 'products' AS table_name, product_id AS key, CAST(sum(copies) AS BIGINT) AS n_rows FROM typed_products
            GROUP BY product_id HAVING sum(copies) > 1
        UNION ALL SELECT 'sales', sale_id, CAST(sum(copies) AS BIGINT) FROM typed_sales
            GROUP BY sale_id HAVING sum(copies) > 1
        UNION ALL SELECT 'inventory', concat_ws('|', snapshot_date, location, product_id), CAST(sum(copies) AS BIGINT)
            FROM typed_inventory GROUP BY snapshot_date, location, product_id HAVING sum(copies) > 1""",
    ),
    "dq_incremental_keys": _sql(
        [*CS, INVENTORY, RAW_INVENTORY, TYPED_INVENTORY],
        """SELECT 'sales' AS table_name, sale_id AS key, CAST(sum(copies) AS BIGINT) AS n_rows FROM typed_sales
            GROUP BY sale_id HAVING sum(copies) > 1""",
    ),
    "dq_null_counts": _sql(
        [*CS, INVENTORY, RAW_INVENTORY, TYPED_INVENTORY],
        " UNION ALL ".join(
            [
                _null_counts("products", "typed_products"),
                _null_counts("sales", "typed_sales"),
                _null_counts("inventory", "parsed_inventory"),
            ]
        ),
    ),
    "dq_orphans": _sql(
        [*RS, INVENTORY, RAW_INVENTORY, RAW_PRODUCTS],
        f"{ORPHANS.format(t='sales')} UNION ALL {ORPHANS.format(t='inventory')}",
    ),
}

# Lines of the order documents, straight from the sales: some are split in two, some weighed.
LINES = """pieces AS (
    SELECT s.*, n, CASE WHEN k % 3 = 0 AND quantity > 1 THEN sale_id || '/' || n ELSE sale_id END AS line_id,
        CASE WHEN k % 3 = 0 AND quantity > 1 THEN CASE n WHEN 1 THEN 1 ELSE quantity - 1 END ELSE quantity END AS q
    FROM sales s, (VALUES (1), (2)) AS c(n) WHERE n = 1 OR (k % 3 = 0 AND quantity > 1)),
lines AS (
    SELECT line_id AS sale_id, sale_date, location,
        CASE WHEN k % 211 <> 0 THEN CAST(product_id AS VARCHAR) END AS product_id,
        q + CASE WHEN k % 113 = 0 THEN 0.5 ELSE 0 END AS quantity, unit_price, discount, k
    FROM pieces)"""
PULLED = f"""pulled AS (
    SELECT l.*, pull FROM lines l, (VALUES (DATE '{FIRST_PULL}'), (DATE '{SECOND_PULL}')) AS p(pull)
    WHERE pull = DATE '{FIRST_PULL}' OR k % 31 = 0),
judged AS (
    SELECT *, CASE WHEN product_id IS NULL THEN 'no product' WHEN k % 113 = 0 THEN 'no whole quantity' END AS reject_reason
    FROM pulled)"""
L = [*S, LINES]
LP = [*L, PULLED]
LINE_COLUMNS = f"sale_id, sale_date, location, product_id, {_dbl('quantity')}, {_dbl('unit_price')}, {_dbl('discount')}"

CATALOG = """catalog AS (
    SELECT CAST(product_id AS VARCHAR) AS product_id, CASE WHEN product_id % 40 <> 0 THEN sku END AS sku,
        CASE WHEN product_id % 6 <> 0 THEN '0' || product_id END AS upc,
        CASE product_id % 5 WHEN 3 THEN artist || ' — ' || title WHEN 4 THEN '' ELSE artist END AS artist,
        CASE product_id % 5 WHEN 3 THEN format ELSE title END AS title, '' AS format,
        CASE WHEN product_id % 9 = 0 OR product_id % 11 = 0 THEN '' ELSE coalesce(genre, '') END AS genre, '' AS condition,
        CASE WHEN product_id % 17 <> 0 THEN CAST(cost AS DOUBLE) END AS cost,
        CAST(price + CAST(r_regionkey AS DECIMAL(4,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DOUBLE) AS price,
        CAST(NULL AS INTEGER) AS release_year, r_name AS location
    FROM products CROSS JOIN region WHERE (product_id + r_regionkey) % 3 <> 0)"""

PAID = """paid AS (
    SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, r_name AS location,
        CAST(o_totalprice AS DECIMAL(12,2)) AS total FROM orders JOIN region ON o_custkey % 5 = r_regionkey)"""

STOCKS = f"""stocks AS (
    SELECT pull AS snapshot_date, location, CASE WHEN product_id % 211 <> 0 THEN CAST(product_id AS VARCHAR) END AS product_id,
        CAST(CASE WHEN product_id % 6 IN (0, 1) AND product_id % 10 = 0 THEN 0
            ELSE quantity_on_hand + CASE WHEN pull = DATE '{SECOND_PULL}' AND product_id % 2 = 0 THEN 1 ELSE 0 END
            END AS DOUBLE) AS quantity_on_hand,
        CAST(NULL AS INTEGER) AS days_in_stock, CAST(NULL AS INTEGER) AS reorder_level
    FROM latest, (VALUES (DATE '{FIRST_PULL}'), (DATE '{SECOND_PULL}')) AS p(pull))"""

_RANK = "CASE location " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(STORES)) + " END"

FEED = {
    "json_scan": _sql(
        S,
        f"""SELECT kind || '-' || sale_id AS id,
            CAST(date_diff('day', DATE '1970-01-01', sale_date) AS BIGINT) * 86400000 + (k % 86400) * 1000 AS createdTime,
            location, pull AS pull_date,
            CASE WHEN kind = 'empty' AND k % 100 = 0 THEN NULL WHEN kind = 'empty' THEN 0
                WHEN k % 3 = 0 AND quantity > 1 THEN 2 ELSE 1 END AS n_items
        FROM sales, (VALUES ('full'), ('empty')) AS a(kind),
            (VALUES (DATE '{FIRST_PULL}'), (DATE '{SECOND_PULL}')) AS p(pull)
        WHERE (kind = 'full' OR k % 50 = 0) AND (pull = DATE '{FIRST_PULL}' OR k % 31 = 0)""",
    ),
    "json_order_lines": _sql(LP, f"SELECT {LINE_COLUMNS} FROM pulled"),
    "json_line_discount": _sql(LP, "SELECT sale_id, CAST(discount * 100 AS BIGINT) AS discount_cents FROM pulled"),
    "json_weighed_lines": _sql(LP, f"SELECT {LINE_COLUMNS} FROM pulled WHERE k % 113 = 0"),
    "quarantine_documents": _sql(LP, f"SELECT {LINE_COLUMNS}, reject_reason FROM judged WHERE reject_reason IS NOT NULL"),
    "feed_metrics": _sql(
        [*LP, CATALOG, PAID, INVENTORY, STOCKS],
        """SELECT 'orders' AS entity, 'rows_in' AS metric, count(*) AS n FROM judged
        UNION ALL SELECT 'orders', 'rows_kept', count(*) FROM judged WHERE reject_reason IS NULL
        UNION ALL SELECT 'orders', reject_reason, count(*) FROM judged WHERE reject_reason IS NOT NULL GROUP BY ALL
        UNION ALL SELECT 'item_stocks', 'rows_in', count(*) FROM stocks
        UNION ALL SELECT 'item_stocks', 'rows_kept', count(*) FROM stocks WHERE product_id IS NOT NULL
        UNION ALL SELECT 'item_stocks', 'no product', count(*) FROM stocks WHERE product_id IS NULL GROUP BY ALL
        UNION ALL SELECT 'items', unnest(['rows_in', 'rows_kept']), count(*) FROM catalog
        UNION ALL SELECT 'payments', unnest(['rows_in', 'rows_kept']), count(*) FROM paid
        UNION ALL SELECT 'refunds', unnest(['rows_in', 'rows_kept']), count(*) FROM paid WHERE k % 7 = 0""",
    ),
    "json_sales": _sql(
        LP,
        f"""SELECT sale_id, sale_date, location, product_id, CAST(quantity AS BIGINT) AS quantity, {_dbl('unit_price')},
            {_dbl('discount')}, {_dbl('quantity * (unit_price - discount)', 'net_amount')}
        FROM judged WHERE reject_reason IS NULL""",
    ),
    "split_artist_title": _sql([PRODUCTS, CATALOG], "SELECT product_id, location, artist, title FROM catalog"),
    "json_products": _sql([PRODUCTS, CATALOG], "SELECT * FROM catalog"),
    "first_per_product": _sql(
        [PRODUCTS, CATALOG],
        f"""SELECT * EXCLUDE (location) FROM catalog
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY {_RANK}) = 1""",
    ),
    "json_payments": _sql(
        [PAID],
        """SELECT 'PAY-' || k AS payment_id, d AS payment_date, location,
            CASE WHEN k % 23 <> 0 THEN CAST(k AS VARCHAR) END AS order_id,
            CAST(CASE WHEN k % 29 = 0 THEN 0 ELSE total END AS DOUBLE) AS amount,
            CAST(CASE WHEN k % 3 = 0 THEN 0 ELSE CAST(k % 500 AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(3,2)) END AS DOUBLE)
                AS tip_amount,
            CAST(CASE WHEN k % 5 = 0 THEN 0 ELSE CAST(CAST(total * 100 AS BIGINT) % 1000 AS DECIMAL(12,0))
                * CAST(0.01 AS DECIMAL(3,2)) END AS DOUBLE) AS tax_amount,
            CASE WHEN k % 19 = 0 THEN '' WHEN k % 13 = 0 THEN 'FAIL' ELSE 'SUCCESS' END AS result
        FROM paid""",
    ),
    "json_refunds": _sql(
        [PAID],
        """SELECT 'REF-' || k AS refund_id, d + 3 AS refund_date, location,
            CASE WHEN k % 5 <> 0 THEN 'PAY-' || k END AS payment_id,
            CAST(CASE WHEN k % 21 = 0 THEN 0 ELSE total END AS DOUBLE) AS amount
        FROM paid WHERE k % 7 = 0""",
    ),
    "json_inventory": _sql([INVENTORY, STOCKS], "SELECT * FROM stocks"),
    "union_stores": _sql(
        [*LP, CATALOG, PAID, INVENTORY, STOCKS],
        """SELECT 'catalog' AS entity, location, count(*) AS n_rows FROM catalog GROUP BY location
        UNION ALL SELECT 'orders', location, count(*) FROM pulled GROUP BY location
        UNION ALL SELECT 'payments', location, count(*) FROM paid GROUP BY location
        UNION ALL SELECT 'refunds', location, count(*) FROM paid WHERE k % 7 = 0 GROUP BY location
        UNION ALL SELECT 'item_stocks', location, count(*) FROM stocks GROUP BY location""",
    ),
    "month_windows": _sql(
        [
            *S,
            PAID,
            "bounds AS (SELECT min(sale_date) - 3 AS since, max(sale_date) AS today FROM sales)",
            """made AS (
                SELECT 'orders' AS entity, sale_date - CAST(k % 4 AS INTEGER) AS d,
                    (1 + CASE WHEN k % 50 = 0 THEN 1 ELSE 0 END) * (1 + CASE WHEN k % 31 = 0 THEN 1 ELSE 0 END) AS n FROM sales
                UNION ALL SELECT 'payments', d - CAST(k % 4 AS INTEGER), 1 FROM paid)""",
        ],
        """SELECT entity, CAST(date_trunc('month', d) AS DATE) AS month_start,
            CAST(epoch_ms(CAST(greatest(any_value(since), CAST(date_trunc('month', d) AS DATE)) AS TIMESTAMP))
                AS BIGINT) AS start_ms,
            CAST(epoch_ms(CAST(least(CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE), any_value(today) + 1)
                AS TIMESTAMP)) AS BIGINT) AS end_ms,
            CAST(sum(n) AS BIGINT) AS n_documents
        FROM made, bounds WHERE d >= since AND d <= today GROUP BY entity, date_trunc('month', d)""",
    ),
    "snapshot_append": _sql(
        [INVENTORY, STOCKS],
        f"""SELECT snapshot_date, count(*) AS n_rows, {_dbl('sum(quantity_on_hand)', 'units')}
        FROM stocks GROUP BY snapshot_date""",
    ),
}

STREAMS = {
    "stream_sales_ingest": _sql(
        L, f"SELECT DISTINCT {LINE_COLUMNS} FROM lines"
    ),
    "stream_monthly_revenue": _sql(
        L,
        f"""SELECT strftime(sale_date, '%Y-%m') AS month, {_dbl('sum(quantity * (unit_price - discount))', 'revenue')},
            {_dbl('sum(quantity)', 'units')}
        FROM (SELECT DISTINCT * EXCLUDE (k) FROM lines) GROUP BY month""",
    ),
}



def _positions(name: str, label: str, order: str, limit: str = "") -> str:
    return f"""SELECT * FROM (SELECT '{name}' AS result, row_number() OVER (ORDER BY {order}) AS position, {label} AS label
        FROM ({ {**ANALYSES, **KPIS}[name] }) AS r) {limit}"""


_ORDERS = {
    "genre_revenue_ascending": ("genre", "revenue, genre"),
    "revenue_by_genre": ("genre", "revenue DESC, genre"),
    "monthly_revenue": ("month", "month"),
    "margin_by_genre": ("genre", "gross_profit DESC, genre"),
    "sell_through_by_genre": ("genre", "sell_through_pct DESC NULLS LAST, genre"),
}
RECONCILED = _sql(
    PSI,
    """SELECT coalesce(l.location, s.location) AS location, coalesce(l.product_id, s.product_id) AS product_id,
        CASE WHEN s.product_id IS NULL THEN 'stock' WHEN l.product_id IS NULL THEN 'sales' ELSE 'both' END AS side,
        CAST(units_sold AS BIGINT) AS units_sold, CAST(units_on_hand AS BIGINT) AS units_on_hand
    FROM (SELECT location, product_id, sum(quantity_on_hand) AS units_on_hand FROM latest GROUP BY ALL) l FULL OUTER JOIN
        (SELECT location, product_id, sum(quantity) AS units_sold FROM sales GROUP BY ALL) s
        ON l.location IS NOT DISTINCT FROM s.location AND l.product_id IS NOT DISTINCT FROM s.product_id""",
)
LAID_OUT = {
    "stock_sales_reconciliation": RECONCILED,
    "sale_lookup": _sql(
        PSI,
        f"""SELECT sale_id, sale_date, location, product_id, quantity, {_dbl('net_amount', 'net_amount')} FROM sales
        WHERE sale_id IN (SELECT max(sale_id) FROM sales GROUP BY location)""",
    ),
    "bucketed_sell_through_by_genre": ANALYSES["sell_through_by_genre"],
    "bucketed_overstock": ANALYSES["overstock"],
}
SUITE = {
    "suite_export": ANALYSES["margin_by_format_condition"],
    "suite_preview": " UNION ALL ".join(_positions(n, *_ORDERS[n], "WHERE position <= 3") for n in ("monthly_revenue", "revenue_by_genre")),
    "reporting_order": " UNION ALL ".join(_positions(n, *o) for n, o in _ORDERS.items()),
}

ORACLES = {**ANALYSES, **KPIS, **CLEANING, **FEED, **STREAMS, **SUITE, **LAID_OUT}
