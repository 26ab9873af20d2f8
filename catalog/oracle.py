"""SQL side: every layer as a common table expression, written against the rules and not against the Spark code."""

from __future__ import annotations

import re

from catalog.bindings import AS_OF, RAW_COMPANY_SQL, RAW_COMPETITOR_SQL
from shelfprice.functions.keys import NULL_PLACEHOLDER
from shelfprice.sources.seed import PRODUCT_MAPPING

AS_OF_SQL = f"DATE '{AS_OF}'"


def title(x: str) -> str:
    words = f"regexp_extract_all(lower(trim({x})), '[a-z0-9]+|[^a-z0-9]+')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1:1]) || w[2:]), '')"


def clean(x: str) -> str:
    return f"CASE WHEN trim({x}) = '' THEN NULL ELSE {title(x)} END"


def matching(x: str, pattern: str) -> str:
    return f"CASE WHEN regexp_matches(trim({x}), '{pattern}') THEN {title(x)} END"


def allowed(x: str, *values: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"CASE WHEN upper(trim({x})) IN ({listed}) THEN {title(x)} END"


def whole(x: str) -> str:
    shape = "^-?[0-9]+(\\.[0-9]+)?$"
    return f"CASE WHEN regexp_matches(trim({x}), '{shape}') THEN try_cast(trunc(abs(try_cast(trim({x}) AS DOUBLE))) AS INTEGER) END"


def number(x: str) -> str:
    shape = "^-?[0-9]+\\.?[0-9]*$"
    return f"CASE WHEN regexp_matches(trim({x}), '{shape}') THEN abs(try_cast(trim({x}) AS DOUBLE)) END"


def day(x: str) -> str:
    shape = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
    return f"CASE WHEN regexp_matches(trim({x}), '{shape}') AND try_cast(trim({x}) AS DATE) IS NOT NULL THEN least(try_cast(trim({x}) AS DATE), {AS_OF_SQL}) END"


def stamp(x: str) -> str:
    shape = "^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\\.[0-9]+)?$"
    parsed = f"CAST(try_cast(replace(trim({x}), 'T', ' ') AS TIMESTAMP) AS DATE)"
    return f"CASE WHEN regexp_matches(trim({x}), '{shape}') AND {parsed} IS NOT NULL THEN least({parsed}, {AS_OF_SQL}) END"


def present(x: str, replacement: str = "Non-Product Expense") -> str:
    return (
        f"CASE WHEN {x} IS NULL OR trim(CAST({x} AS VARCHAR)) IN ('NOT_APPLICABLE', 'N/A', 'NONE', '', 'Not_Applicable') "
        f"THEN '{replacement}' ELSE CAST({x} AS VARCHAR) END"
    )


def region(city: str, fallback: str) -> str:
    return (
        f"CASE WHEN upper(trim({city})) IN ('CAIRO', 'GIZA') THEN 'Greater Cairo' "
        f"WHEN upper(trim({city})) = 'ALEXANDRIA' THEN 'Alex Coast' "
        f"WHEN upper(trim({city})) IN ('TANTA', 'MANSOURA') THEN 'Delta' ELSE {clean(fallback)} END"
    )


def key(*parts: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce(CAST({p} AS VARCHAR), '{NULL_PLACEHOLDER}')" for p in parts) + ")"


def money(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38, 9)), 2) AS DOUBLE)"


def ymd(x: str) -> str:
    return f"CAST(strftime({x}, '%Y%m%d') AS INTEGER)"


def ym(x: str) -> str:
    return f"CAST(strftime({x}, '%Y%m') AS INTEGER)"


def week(x: str) -> str:
    return f"CAST(date_trunc('week', {x}) AS DATE)"


_MAPPING = ", ".join(str(row) for row in PRODUCT_MAPPING)
_PRODUCT = "product_id, product_name, category, sub_category"
_NEWEST = "product_id DESC, product_name DESC, category DESC, sub_category DESC"
_COMPANY_REST = (
    '"Record_Type", "Date", "Store_City", "Store_Region", "Product_ID", "Product_Name", "Category", '
    '"Sub_Category", "Quantity", "Unit_Cost", "Unit_Retail", "Expense_Type", "Expense_Amount"'
)
_DESC = " DESC NULLS LAST"


def newest_first(columns: str) -> str:
    return ", ".join(c.strip() + _DESC for c in columns.split(","))


def versions(rows: str) -> str:
    """Version columns over rows of (product_key, attributes, updated_at, valid_to)."""
    return (
        f"SELECT product_key, {_PRODUCT}, updated_at, md5(product_key || '|' || CAST(updated_at AS VARCHAR)) AS dbt_scd_id, "
        f"updated_at AS dbt_updated_at, updated_at AS dbt_valid_from, valid_to AS dbt_valid_to FROM {rows}"
    )


def from_the_start(start: str) -> str:
    """Start of a version, where a product's first one reaches back to the beginning of time."""
    return f"CASE WHEN row_number() OVER (PARTITION BY product_key ORDER BY {start}) = 1 THEN DATE '0001-01-01' ELSE {start} END"


def as_of(fact: str, at: str) -> str:
    """Join to the product version that started last; versions of a product leave no gaps."""
    return f"ASOF LEFT JOIN product_versions p ON {fact}.product_key = p.product_key AND {at} >= p.starts"


def mart(members: str, keys: str, attributes: str, sales: str) -> str:
    """Dense weekly grid; a week without a price takes the last one known."""
    on = " AND ".join(f"g.{k} = s.{k}" for k in keys.split(", "))
    series = ", ".join(f"g.{k}" for k in keys.split(", "))
    return f"""
    spine AS (SELECT DISTINCT {week('full_date')} AS sales_week FROM dim_date
        WHERE full_date >= (SELECT min(sales_week) FROM {sales}) AND full_date <= (SELECT max(sales_week) FROM {sales})),
    market AS (
        SELECT p.product_key, w.sales_week, last_value(c.a IGNORE NULLS) OVER past AS a,
               last_value(c.lo IGNORE NULLS) OVER past AS lo, last_value(c.hi IGNORE NULLS) OVER past AS hi
        FROM active_products p CROSS JOIN spine w
        LEFT JOIN weekly_competitor c ON c.product_key = p.product_key AND c.sales_week = w.sales_week
        WINDOW past AS (PARTITION BY p.product_key ORDER BY w.sales_week)),
    grid AS (
        SELECT g.*, w.sales_week, s.quantity, s.transactions,
               last_value(CASE WHEN s.avg_unit_retail IS NOT NULL THEN {{'retail': s.avg_unit_retail, 'cost': s.avg_unit_cost}} END IGNORE NULLS) OVER past AS price
        FROM {members} g CROSS JOIN spine w LEFT JOIN {sales} s ON {on} AND s.sales_week = w.sales_week
        WINDOW past AS (PARTITION BY {series} ORDER BY w.sales_week)),
    mart AS (
        SELECT c.product_id, c.sales_week, c.product_name, c.category, c.sub_category, {attributes}
               {money('coalesce(price.retail, 0)')} AS avg_unit_retail, {money('coalesce(price.cost, 0)')} AS avg_unit_cost,
               {money('coalesce(a, price.retail, 0)')} AS avg_competitor_price, {money('coalesce(lo, price.retail, 0)')} AS min_competitor_price,
               {money('coalesce(hi, price.retail, 0)')} AS max_competitor_price,
               CAST(coalesce(quantity, 0) AS BIGINT) AS quantity_sold, CAST(coalesce(transactions, 0) AS BIGINT) AS total_transactions
        FROM grid c JOIN market m USING (product_key, sales_week))"""


def weekly(keys: str) -> str:
    return (
        f"SELECT {keys}, {week('full_date')} AS sales_week, avg(unit_retail) AS avg_unit_retail, avg(unit_cost) AS avg_unit_cost, "
        f"sum(quantity) AS quantity, count(DISTINCT transaction_id) AS transactions FROM fact_store_sales "
        f"WHERE product_key <> '-1' AND store_key <> '-1' AND date_key <> -1 GROUP BY ALL"
    )


_LATEST = "PARTITION BY product_id, store_key ORDER BY sales_week"
_MART_ATTRIBUTES = "c.store_key, c.store_id, c.store_name, c.store_region, c.store_city,"

# name -> body; the two marts are lists of tables that end in one named mart
CTES: dict[str, str] = {
    "raw_company": RAW_COMPANY_SQL,
    "raw_competitor": RAW_COMPETITOR_SQL,
    "company_latest": f"""SELECT * FROM raw_company QUALIFY row_number() OVER (
        PARTITION BY "Store_Name", "Transaction_ID", "Store_ID"
        ORDER BY try_cast(trim("Date") AS TIMESTAMP) DESC NULLS LAST, {newest_first(_COMPANY_REST)}) = 1""",
    "competitor_latest": f"""SELECT * FROM raw_competitor QUALIFY row_number() OVER (
        PARTITION BY "Scraped_At", "Competitor_Name", "Product_ID"
        ORDER BY {newest_first('"Product_Name", "Competitor_Price"')}) = 1""",
    "mapping": f"SELECT * FROM (VALUES {_MAPPING}) AS m(product_id, product_name, category, sub_category)",
    "silver_company": f"""SELECT {allowed('"Record_Type"', 'SALES', 'STORE_EXPENSE')} AS record_type,
        {matching('"Transaction_ID"', '^Tx-[0-9]+$')} AS transaction_id, {day('"Date"')} AS transaction_date,
        {whole('"Store_ID"')} AS store_id, {matching('"Store_Name"', '^Branch_[0-9]+$')} AS store_name,
        {clean('"Store_City"')} AS store_city, {region('"Store_City"', '"Store_Region"')} AS store_region,
        {present('(' + whole('"Product_ID"') + ')')} AS product_id, {present('(' + clean('"Product_Name"') + ')')} AS product_name,
        {present('(' + clean('"Category"') + ')')} AS category, {present('(' + clean('"Sub_Category"') + ')')} AS sub_category,
        {whole('"Quantity"')} AS quantity, {number('"Unit_Cost"')} AS unit_cost, {number('"Unit_Retail"')} AS unit_retail,
        {present('(' + clean('"Expense_Type"') + ')', 'Direct Sale')} AS expense_type, {number('"Expense_Amount"')} AS expense_amount
        FROM company_latest WHERE COLUMNS(*) IS NOT NULL""",
    "silver_sales": f"""SELECT p.* REPLACE (coalesce(m.product_name, p.product_name) AS product_name,
            coalesce(m.category, p.category) AS category, coalesce(m.sub_category, p.sub_category) AS sub_category),
        {key('p.product_id')} AS product_key, {key('p.store_id')} AS store_key, {ymd('p.transaction_date')} AS date_key
        FROM silver_company p LEFT JOIN mapping m ON p.product_id = CAST(m.product_id AS VARCHAR)
        WHERE p.record_type = 'Sales' AND p.quantity > 0""",
    "silver_expenses": f"""SELECT {key('transaction_id')} AS expense_key, {ym('transaction_date')} AS month_key,
        {key('store_id')} AS store_key, {key('expense_type')} AS expense_type_key, transaction_id, transaction_date, store_id,
        store_name, store_city, store_region, expense_type, expense_amount FROM silver_company WHERE record_type = 'Store_Expense'""",
    "own_prices": "SELECT product_id, avg(unit_retail) AS our_unit_retail FROM silver_company GROUP BY product_id",
    "scrapes": f"""SELECT {stamp('"Scraped_At"')} AS scraped_at, {clean('"Competitor_Name"')} AS competitor_name,
        {whole('"Product_ID"')} AS product_id, {matching('"Product_Name"', '^Prod_[0-9]+$')} AS product_name,
        try_cast("Competitor_Price" AS DOUBLE) AS price FROM competitor_latest WHERE COLUMNS(*) IS NOT NULL""",
    "silver_competitor": f"""SELECT {key('competitor_name')} AS competitor_key, {key('s.product_id')} AS product_key,
        {ymd('scraped_at')} AS date_key, scraped_at, competitor_name, s.product_id, product_name,
        CASE WHEN our_unit_retail IS NULL THEN round(price, 2)
             WHEN price > our_unit_retail * 5 OR price < our_unit_retail * CAST(0.1 AS DOUBLE) THEN round(our_unit_retail, 2)
             ELSE round(price, 2) END AS competitor_price
        FROM scrapes s LEFT JOIN own_prices o ON CAST(s.product_id AS VARCHAR) = o.product_id""",
    "product_days": f"""SELECT product_key, transaction_date AS updated_at, {_PRODUCT} FROM silver_sales
        WHERE transaction_date IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY product_key, transaction_date ORDER BY {_NEWEST}) = 1""",
    "product_changes": f"""SELECT *, lead(updated_at) OVER (PARTITION BY product_key ORDER BY updated_at) AS valid_to FROM (
        SELECT * FROM product_days
        QUALIFY (product_name || '|' || category || '|' || sub_category) IS DISTINCT FROM
            lag(product_name || '|' || category || '|' || sub_category) OVER (PARTITION BY product_key ORDER BY updated_at))""",
    "dim_products": f"""SELECT '-1' AS product_key, '-1' AS product_id, 'Unknown / Missing Product' AS product_name,
        'Undefined' AS category, 'Undefined' AS sub_category, DATE '1970-01-01' AS updated_at,
        'placeholder_unknown_product_key_-1' AS dbt_scd_id, DATE '1970-01-01' AS dbt_updated_at,
        DATE '1970-01-01' AS dbt_valid_from, CAST(NULL AS DATE) AS dbt_valid_to
        UNION ALL {versions('product_changes')}""",
    "product_versions": f"SELECT *, {from_the_start('dbt_valid_from')} AS starts FROM dim_products",
    "dim_stores": """SELECT store_key, store_id, store_name, store_city, store_region, min(transaction_date) AS create_at
        FROM silver_sales GROUP BY ALL""",
    "dim_competitors": "SELECT competitor_key, competitor_name, min(scraped_at) AS create_at FROM silver_competitor GROUP BY ALL",
    "dim_expense_type": "SELECT expense_type_key, expense_type, min(transaction_date) AS create_at FROM silver_expenses GROUP BY ALL",
    "dim_date": f"""SELECT {ymd('full_date')} AS date_key, full_date, day(full_date) AS day, month(full_date) AS month,
        quarter(full_date) AS quarter, year(full_date) AS year, dayofweek(full_date) IN (5, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(date_trunc('year', min(transaction_date)),
            date_trunc('year', max(transaction_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS full_date FROM silver_sales)""",
    "dim_month": f"""SELECT {ym('m')} AS month_key, m AS month_start_date, last_day(m) AS month_end_date, monthname(m) AS month_name,
        quarter(m) AS quarter, year(m) AS year
        FROM (SELECT CAST(unnest(generate_series(date_trunc('year', min(d)), date_trunc('year', max(d)) + INTERVAL 11 MONTH, INTERVAL 1 MONTH)) AS DATE) AS m
              FROM (SELECT transaction_date AS d FROM silver_expenses UNION ALL SELECT scraped_at FROM silver_competitor))""",
    "fact_store_sales": f"""SELECT {key('s.transaction_id')} AS sales_key, s.transaction_id, coalesce(p.product_key, '-1') AS product_key,
        coalesce(st.store_key, '-1') AS store_key, coalesce(d.date_key, -1) AS date_key, d.full_date, s.quantity, s.unit_cost, s.unit_retail,
        round(s.quantity * s.unit_retail, 2) AS gross_revenue, round(s.quantity * (s.unit_retail - s.unit_cost), 2) AS gross_margin_amount
        FROM silver_sales s {as_of('s', 's.transaction_date')}
        LEFT JOIN dim_stores st ON s.store_key = st.store_key LEFT JOIN dim_date d ON s.date_key = d.date_key""",
    "monthly_expenses": """SELECT store_key, expense_type_key, month_key, sum(coalesce(expense_amount, 0)) AS expense_amount
        FROM silver_expenses GROUP BY ALL""",
    "fact_store_expenses": f"""SELECT {key('e.store_key', 'e.expense_type_key', 'e.month_key')} AS expense_key,
        coalesce(m.month_key, -1) AS month_date_key, coalesce(s.store_key, '-1') AS store_key,
        coalesce(t.expense_type_key, '-1') AS expense_type_key, m.month_start_date, e.expense_amount
        FROM monthly_expenses e LEFT JOIN dim_stores s ON e.store_key = s.store_key
        LEFT JOIN dim_expense_type t ON e.expense_type_key = t.expense_type_key LEFT JOIN dim_month m ON e.month_key = m.month_key""",
    "fact_competitor_prices": f"""SELECT {key('s.scraped_at', 'p.product_id', 'c.competitor_name', 's.competitor_price')} AS competitor_price_key,
        coalesce(s.competitor_key, '-1') AS competitor_key, coalesce(p.product_key, '-1') AS product_key,
        coalesce(d.date_key, -1) AS date_key, s.scraped_at, s.competitor_price
        FROM silver_competitor s {as_of('s', 's.scraped_at')}
        LEFT JOIN dim_competitors c ON s.competitor_key = c.competitor_key LEFT JOIN dim_date d ON s.date_key = d.date_key""",
    "active_products": f"SELECT product_key, {_PRODUCT} FROM dim_products WHERE dbt_valid_to IS NULL AND product_key <> '-1'",
    "product_stores": """SELECT p.*, s.store_key, s.store_id, s.store_name, s.store_region, s.store_city
        FROM active_products p CROSS JOIN dim_stores s WHERE s.store_key <> '-1'""",
    "weekly_sales": weekly("product_key, store_key"),
    "weekly_product_sales": weekly("product_key"),
    "weekly_competitor": f"""SELECT product_key, {week('full_date')} AS sales_week, avg(competitor_price) AS a, min(competitor_price) AS lo,
        max(competitor_price) AS hi FROM fact_competitor_prices JOIN dim_date USING (date_key) WHERE product_key <> '-1' GROUP BY ALL""",
    "pricing_mart": mart("product_stores", "product_key, store_key", _MART_ATTRIBUTES, "weekly_sales"),
    "product_week_mart": mart("active_products", "product_key", "", "weekly_product_sales"),
    "features": f"""SELECT *, ln(nullif(avg_unit_retail, 0)) AS log_unit_retail,
        avg_unit_retail / nullif(avg_competitor_price, 0) AS competitor_price_ratio,
        avg_unit_retail - avg_competitor_price AS price_difference,
        (avg_unit_retail - avg_competitor_price) / nullif(avg_competitor_price, 0) AS competitor_price_gap_pct,
        (avg_unit_retail - avg_unit_cost) / nullif(avg_unit_retail, 0) AS current_profit_margin_pct,
        CAST(avg_unit_retail > avg_competitor_price AS DOUBLE) AS is_higher_than_competitor,
        CAST(avg_unit_retail > min_competitor_price AS DOUBLE) AS is_undercut,
        lag(quantity_sold, 1) OVER ({_LATEST}) AS quantity_lag_1_week, lag(quantity_sold, 4) OVER ({_LATEST}) AS quantity_lag_4_weeks,
        avg_unit_retail / nullif(lag(avg_unit_retail) OVER ({_LATEST}), 0) - 1 AS price_change_pct_weekly,
        avg(quantity_sold) OVER ({_LATEST} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS quantity_rolling_avg_4_weeks,
        avg(avg_unit_retail) OVER ({_LATEST} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS price_rolling_avg_4_weeks,
        month(sales_week) AS month, quarter(sales_week) AS quarter, weekofyear(sales_week) AS week_of_year FROM mart""",
    "training": "SELECT *, ln(1 + quantity_sold) AS log_quantity FROM features WHERE quantity_lag_4_weeks IS NOT NULL",
    "latest": "SELECT * FROM features QUALIFY row_number() OVER (PARTITION BY product_id, store_key ORDER BY sales_week DESC) = 1",
}

_SELF_NAMED = {"pricing_mart", "product_week_mart"}
_WORD = re.compile(r"[a-z_]+")


def needed(body: str) -> list[str]:
    """Layers a statement reads, in the order they are defined."""
    found: set[str] = set()
    todo = [body]
    while todo:
        for word in _WORD.findall(todo.pop()):
            if word in CTES and word not in found:
                found.add(word)
                todo.append(CTES[word])
    return [n for n in CTES if n in found]


def statement(body: str, mart_of: str = "pricing_mart") -> str:
    """``body`` with the layers it reads in front. ``mart`` stands for the chosen mart."""
    probe = body + (f" {mart_of}" if re.search(r"\b(mart|features|training|latest)\b", body) else "")
    names = [n for n in needed(probe) if n not in _SELF_NAMED or n == mart_of]
    layers = [CTES[n] if n in _SELF_NAMED else f"{n} AS MATERIALIZED ({CTES[n]})" for n in names]
    if not layers:
        return body
    if body.lstrip().upper().startswith("WITH "):
        body = ",\n" + body.lstrip()[5:]
    return "WITH " + ",\n".join(layers) + "\n" + body

