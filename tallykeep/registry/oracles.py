"""The same results as :mod:`tallykeep.registry.queries`, as SQL over the raw tables.

Written from the definitions, with plain joins and distinct counts over the lines, so
that agreement is evidence: nothing here follows the shape of the Spark plans.
"""

from __future__ import annotations

from tallykeep.functions.countries import listed
from tallykeep.registry.queries import CENTURY, COMBINED, COUNTRY_STEP, EMPTY, LONG, MID_MONTH, NATION_CODES, YEAR

ALL = "all_invoices"
SET = "chosen"

_SOURCES = """
all_invoices AS (
  SELECT o_orderkey AS InvoiceId, o_custkey AS CustomerId, CAST(o_orderdate AS DATE) AS dt, n_name AS country
  FROM orders
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
),
sales AS (
  SELECT l_orderkey AS InvoiceId, l_partkey AS TrackId, p_type AS genre, p_brand AS artist,
         CAST(l_quantity AS BIGINT) AS qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
  FROM lineitem
  LEFT JOIN part ON p_partkey = l_partkey
)"""


def _in(column: str, values) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def _chosen(country=(), genre=(), artist=(), dates=None) -> str:
    """CTE of the filtered working set."""
    line = ["s.InvoiceId = a.InvoiceId", "s.genre IS NOT NULL", "s.artist IS NOT NULL"]
    line += [_in("s.genre", genre)] if genre else []
    line += [_in("s.artist", artist)] if artist else []
    own = [_in("a.country", country)] if country else []
    own += [_months("a.dt", dates)] if dates else []
    where = " AND ".join(own + [f"EXISTS (SELECT 1 FROM sales s WHERE {' AND '.join(line)})"])
    return f"{SET} AS (SELECT a.* FROM all_invoices a WHERE {where})"


def _days(column: str, dates) -> str:
    return f"{column} BETWEEN DATE '{dates[0]}' AND DATE '{dates[1]}'"


def _months(column: str, dates) -> str:
    if dates is None:
        return "TRUE"
    return (
        f"{column} BETWEEN CAST(date_trunc('month', DATE '{dates[0]}') AS DATE) "
        f"AND last_day(DATE '{dates[1]}')"
    )


def _with(body: str, *ctes: str, **chosen) -> str:
    parts = [_SOURCES.strip(), _chosen(**chosen), *ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


GENRES = {"genre": ["ECONOMY"]}
ARTISTS = {"artist": ["Brand#1"]}
COUNTRIES = {"country": ["NATION_1", "NATION_7"]}
COMBINATION = {"country": COMBINED.country, "genre": COMBINED.genre, "artist": COMBINED.artist}


def _events(**chosen) -> str:
    return _with(f"SELECT CustomerId, dt, InvoiceId FROM {SET}", **chosen)


# Core KPIs


def _diversity(tbl: str, dates, **chosen) -> str:
    return _with(
        f"""SELECT COUNT(DISTINCT s.genre) AS num_genre, COUNT(DISTINCT s.artist) AS num_artist,
                   COUNT(DISTINCT e.country) AS num_billingcountry
            FROM {tbl} e JOIN sales s ON s.InvoiceId = e.InvoiceId
            WHERE s.genre IS NOT NULL AND s.artist IS NOT NULL AND {_months('e.dt', dates)}""",
        **chosen,
    )


def _revenue_cte(tbl: str, dates) -> str:
    return f"""revenue AS (
      SELECT CAST(SUM(s.amount) AS DOUBLE) AS total_revenue
      FROM {tbl} e JOIN sales s ON s.InvoiceId = e.InvoiceId WHERE {_months('e.dt', dates)})"""


def _customers_cte(tbl: str, dates) -> str:
    within = "TRUE" if dates is None else _days("{0}", dates)
    return f"""customers AS (
      SELECT COUNT(DISTINCT e.CustomerId) AS total_customers,
             CASE WHEN COUNT(DISTINCT e.CustomerId) = 0 THEN 0.0
                  ELSE CAST(COUNT(DISTINCT CASE WHEN {within.format('f.first_dt')} THEN e.CustomerId END) AS DOUBLE)
                       / COUNT(DISTINCT e.CustomerId) END AS pct_new_customers
      FROM {tbl} e
      JOIN (SELECT CustomerId, MIN(dt) AS first_dt FROM {tbl} GROUP BY CustomerId) f
        ON f.CustomerId = e.CustomerId
      WHERE {within.format('e.dt')})"""


def _purchases_cte(tbl: str, dates) -> str:
    return f"""purchases AS (
      SELECT COUNT(*) AS total_orders,
             CAST(SUM(revenue) AS DOUBLE) / NULLIF(COUNT(*), 0) AS avg_rev_per_order,
             CAST(SUM(tracks) AS BIGINT) AS total_tracks,
             CAST(SUM(tracks) AS DOUBLE) / NULLIF(COUNT(*), 0) AS avg_tracks_per_order
      FROM (SELECT e.InvoiceId, SUM(s.qty) AS tracks, SUM(s.amount) AS revenue
            FROM {tbl} e JOIN sales s ON s.InvoiceId = e.InvoiceId
            WHERE {_months('e.dt', dates)} GROUP BY e.InvoiceId))"""


def _revenue(tbl: str, dates, **chosen) -> str:
    return _with("SELECT * FROM revenue WHERE total_revenue IS NOT NULL", _revenue_cte(tbl, dates), **chosen)


def _customers(tbl: str, dates, **chosen) -> str:
    return _with("SELECT * FROM customers", _customers_cte(tbl, dates), **chosen)


def _purchases(tbl: str, dates, **chosen) -> str:
    return _with("SELECT * FROM purchases", _purchases_cte(tbl, dates), **chosen)


# Groups, catalog, top-N


def _groups_cte(tbl: str, column: str, dates) -> str:
    known = "TRUE" if column == "e.country" else f"{column} IS NOT NULL"
    return f"""base AS (
      SELECT e.CustomerId, e.InvoiceId, e.dt, s.qty, s.amount, {column} AS group_val
      FROM {tbl} e JOIN sales s ON s.InvoiceId = e.InvoiceId
      WHERE {known} AND {_months('e.dt', dates)}),
    group_table AS (
      SELECT b.group_val, COUNT(DISTINCT b.CustomerId) AS num_customers,
             COUNT(DISTINCT b.InvoiceId) AS num_purchases, CAST(SUM(b.qty) AS BIGINT) AS tracks_sold,
             CAST(SUM(b.amount) AS DOUBLE) AS revenue,
             COUNT(DISTINCT CASE WHEN b.dt = f.first_dt THEN b.CustomerId END) AS first_time_customers
      FROM base b
      LEFT JOIN (SELECT CustomerId, MIN(dt) AS first_dt FROM base GROUP BY CustomerId) f
        ON f.CustomerId = b.CustomerId
      GROUP BY b.group_val)"""


def _groups(tbl: str, column: str, dates, **chosen) -> str:
    return _with("SELECT * FROM group_table", _groups_cte(tbl, column, dates), **chosen)


def _catalog(name: str) -> str:
    column = {"genre": "p_type", "artist": "p_brand"}[name]
    return f"SELECT {column} AS {name}, COUNT(DISTINCT p_partkey) AS num_tracks FROM part GROUP BY {column}"


def _coverage_cte(tbl: str, name: str, dates) -> str:
    return f"""coverage AS (
      SELECT s.{name} AS group_val, COUNT(DISTINCT s.TrackId) AS unique_tracks_sold,
             MAX(c.num_tracks) AS catalog_size,
             CAST(COUNT(DISTINCT s.TrackId) AS DOUBLE) / MAX(c.num_tracks) AS pct_catalog_sold
      FROM {tbl} e JOIN sales s ON s.InvoiceId = e.InvoiceId
      LEFT JOIN ({_catalog(name)}) c ON c.{name} = s.{name}
      WHERE s.{name} IS NOT NULL AND {_months('e.dt', dates)}
      GROUP BY s.{name})"""


def _coverage(tbl: str, name: str, dates, **chosen) -> str:
    return _with("SELECT * FROM coverage", _coverage_cte(tbl, name, dates), **chosen)


_ENRICHED = """enriched AS (
  SELECT g.*, c.unique_tracks_sold, c.catalog_size, c.pct_catalog_sold
  FROM group_table g LEFT JOIN coverage c USING (group_val))"""


def _enriched(tbl: str, name: str, dates, **chosen) -> str:
    return _with(
        "SELECT * FROM enriched",
        _groups_cte(tbl, f"s.{name}", dates),
        _coverage_cte(tbl, name, dates),
        _ENRICHED,
        **chosen,
    )


METRICS = ("revenue", "num_customers", "first_time_customers", "num_purchases", "tracks_sold")


def _ranked_cte(table: str, n: int = 5) -> str:
    union = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS value, * FROM {table} WHERE {m} IS NOT NULL"
        for m in METRICS
    )
    return f"""ranked AS (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY metric ORDER BY value DESC, group_val) AS rank FROM ({union})
      QUALIFY rank <= {n})"""


def _top(tbl: str, column: str, dates, **chosen) -> str:
    return _with(
        "SELECT metric, rank, group_val, value FROM ranked",
        _groups_cte(tbl, column, dates),
        _ranked_cte("group_table"),
        **chosen,
    )


def _text(x: str, kind: str) -> str:
    """Display text of a number, rounded half-even to two decimals."""
    x = f"CAST({x} AS DOUBLE)"
    two = f"format('{{:,.2f}}', round_even(abs({x}) / 0.01, 0) * 0.01)"
    sign = f"CASE WHEN {x} < 0 THEN '-' ELSE '' END"
    if kind == "dollar":
        body = f"{sign} || '$' || {two}"
    elif kind == "percent":
        body = f"replace(format('{{:,.2f}}', round_even({x} / 0.0001, 0) * 0.0001 * 100), ',', ' ') || '%'"
    elif kind == "float":
        body = f"{sign} || {two}"
    else:
        body = f"CASE WHEN {x} % 1 = 0 THEN format('{{:,}}', CAST({x} AS BIGINT)) ELSE {sign} || {two} END"
    return f"CASE WHEN {x} IS NULL THEN 'NA' ELSE {body} END"


def _ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def _with_ratios(share_of: str) -> str:
    return f"""{_ratio('revenue', 'num_customers')} AS avg_revenue_per_cust,
      {_ratio('revenue', 'num_purchases')} AS avg_revenue_per_purchase,
      {_ratio('tracks_sold', 'num_purchases')} AS avg_tracks_per_purchase,
      {_ratio('revenue', share_of)} AS revenue_share"""


_COUNTS = ("num_customers", "num_purchases", "tracks_sold", "first_time_customers")
_RATIO_KINDS = {
    "revenue": "dollar",
    "avg_revenue_per_cust": "dollar",
    "avg_revenue_per_purchase": "dollar",
    "avg_tracks_per_purchase": "float",
    "revenue_share": "percent",
    **{name: "number" for name in _COUNTS},
}
_COVERAGE_KINDS = {"unique_tracks_sold": "number", "catalog_size": "number", "pct_catalog_sold": "percent"}


def _formatted(kinds: dict[str, str]) -> str:
    return ", ".join(f"{_text(name, kind)} AS {name}_fmt" for name, kind in kinds.items())


def _top_display(name: str, dates, **chosen) -> str:
    return _with(
        f"""SELECT *, {_formatted({**_RATIO_KINDS, **_COVERAGE_KINDS})}
            FROM (SELECT *, {_with_ratios('(SELECT total_revenue FROM revenue)')} FROM ranked)""",
        _groups_cte(SET, f"s.{name}", dates),
        _coverage_cte(SET, name, dates),
        _ENRICHED,
        _revenue_cte(SET, dates),
        _ranked_cte("enriched"),
        **chosen,
    )


_CODES = "codes(name, iso2, iso3, label) AS (VALUES " + ", ".join(
    f"('{alias}', '{iso2}', '{iso3}', '{name}')" for alias, _, iso2, iso3, name in NATION_CODES
) + ")"
_FLAG = "translate(c.iso2, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '🇦🇧🇨🇩🇪🇫🇬🇭🇮🇯🇰🇱🇲🇳🇴🇵🇶🇷🇸🇹🇺🇻🇼🇽🇾🇿')"
_LABELLED = f"CASE WHEN c.iso2 IS NULL THEN '' ELSE {_FLAG} || ' ' || c.label END"


def _top_display_country() -> str:
    return _with(
        f"""SELECT t.*, {_formatted(_RATIO_KINDS)}, {_LABELLED} AS group_label
            FROM (SELECT *, {_with_ratios('CAST(SUM(CAST(revenue AS DECIMAL(28,2))) OVER () AS DOUBLE)')}
                  FROM (SELECT * FROM group_table ORDER BY revenue DESC, group_val LIMIT 5)) t
            LEFT JOIN codes c ON c.name = t.group_val""",
        _groups_cte(SET, "e.country", YEAR),
        _CODES,
    )


# Trend, geography, yearly groups


def _monthly(dates, **chosen) -> str:
    return _with(
        f"""SELECT strftime(e.dt, '%Y-%m') AS month, COUNT(DISTINCT e.InvoiceId) AS num_purchases,
                   COUNT(DISTINCT e.CustomerId) AS num_customers, CAST(SUM(s.qty) AS BIGINT) AS tracks_sold,
                   CAST(SUM(s.amount) AS DOUBLE) AS revenue,
                   COUNT(DISTINCT CASE WHEN strftime(e.dt, '%Y-%m') = strftime(f.first_dt, '%Y-%m')
                                       THEN e.CustomerId END) AS first_time_customers
            FROM {SET} e
            JOIN sales s ON s.InvoiceId = e.InvoiceId
            JOIN (SELECT CustomerId, MIN(dt) AS first_dt FROM {SET} GROUP BY CustomerId) f
              ON f.CustomerId = e.CustomerId
            WHERE {_days('e.dt', dates)} GROUP BY 1""",
        **chosen,
    )


def _overview(dates, months: int) -> str:
    return _with(
        f"""SELECT {_text('total_revenue', 'dollar')} AS total_rev,
                   {_text(f'total_revenue / {months}', 'dollar')} AS avg_rev,
                   {_text('total_orders', 'number')} AS total_purchases,
                   {_text('total_tracks', 'number')} AS total_tracks,
                   {_text('avg_rev_per_order', 'dollar')} AS avg_per_purchase,
                   {_text('total_customers', 'number')} AS total_customers,
                   {_text('pct_new_customers', 'percent')} AS first_time_pct
            FROM revenue, customers, purchases""",
        _revenue_cte(SET, dates),
        _customers_cte(SET, dates),
        _purchases_cte(SET, dates),
    )


def _geo_ctes(dates, months: dict[str, int]) -> tuple[str, ...]:
    month_values = ", ".join(f"('{year}', {n})" for year, n in months.items())
    measures = """b.country, COUNT(DISTINCT b.CustomerId) AS num_customers,
        COUNT(DISTINCT b.InvoiceId) AS num_purchases, CAST(SUM(b.qty) AS BIGINT) AS tracks_sold,
        CAST(SUM(b.amount) AS DOUBLE) AS revenue,
        COUNT(DISTINCT CASE WHEN b.dt = f.first_dt THEN b.CustomerId END) AS first_time_customers"""
    joined = """geo_base b JOIN (SELECT CustomerId, MIN(dt) AS first_dt FROM geo_base GROUP BY CustomerId) f
        ON f.CustomerId = b.CustomerId"""
    return (
        f"""geo_base AS (
          SELECT e.CustomerId, e.InvoiceId, e.dt, e.country, s.qty, s.amount
          FROM {SET} e JOIN sales s ON s.InvoiceId = e.InvoiceId WHERE {_days('e.dt', dates)})""",
        f"months(year, num_months) AS (VALUES {month_values})",
        f"""geo_yearly AS (
          SELECT t.year, m.num_months, t.* EXCLUDE (year)
          FROM (SELECT strftime(b.dt, '%Y') AS year, {measures} FROM {joined} GROUP BY 1, 2) t
          LEFT JOIN months m ON m.year = t.year)""",
        f"""geo_all AS (
          SELECT 'All' AS year, CAST(NULL AS INTEGER) AS num_months, {measures} FROM {joined} GROUP BY b.country)""",
    )


LONG_MONTHS = {"1996": 10, "1997": 12, "1998": 9}
MID_MONTHS = {"1997": 11}


def _geo(which: str, dates, months, **chosen) -> str:
    return _with(f"SELECT * FROM {which}", *_geo_ctes(dates, months), **chosen)


def _geo_frames() -> str:
    return _with(
        f"""SELECT t.*, c.iso3 AS iso_alpha, {_ratio('t.revenue', 't.num_customers')} AS revenue_per_customer
            FROM (SELECT * FROM geo_yearly UNION ALL SELECT * FROM geo_all) t
            JOIN codes c ON c.name = t.country""",
        *_geo_ctes(LONG, LONG_MONTHS),
        _CODES,
    )


def _countries() -> str:
    return _with(
        f"""SELECT t.group_val, t.revenue, c.iso3 AS iso3, COALESCE({_FLAG}, '') AS flag, {_LABELLED} AS labelled
            FROM group_table t LEFT JOIN codes c ON c.name = t.group_val""",
        _groups_cte(SET, "e.country", YEAR),
        _CODES,
    )


def _country_names() -> str:
    entries = [
        (key, iso2, iso3, name.replace("'", "''")) for key, (iso2, iso3, name) in enumerate(listed()[::COUNTRY_STEP])
    ]
    values = ", ".join(f"({key}, '{iso2}', '{iso3}', '{name}')" for key, iso2, iso3, name in entries)
    return f"""SELECT n_name, c.label AS country, c.iso3 AS iso3, {_FLAG} AS flag, {_FLAG} || ' ' || c.label AS labelled
      FROM nation LEFT JOIN (VALUES {values}) AS c(place, iso2, iso3, label) ON c.place = n_nationkey"""


def _yearly_cte(name: str, dates) -> str:
    return f"""year_base AS (
      SELECT e.CustomerId, e.InvoiceId, e.dt, e.country, s.TrackId, s.qty, s.amount, s.{name} AS {name}
      FROM {SET} e JOIN sales s ON s.InvoiceId = e.InvoiceId
      WHERE s.{name} IS NOT NULL AND {_days('e.dt', dates)}),
    yearly AS (
      SELECT strftime(b.dt, '%Y') AS year, b.{name}, COUNT(DISTINCT b.CustomerId) AS num_customers,
             COUNT(DISTINCT b.InvoiceId) AS num_purchases, COUNT(DISTINCT b.country) AS num_countries,
             CAST(SUM(b.qty) AS BIGINT) AS tracks_sold, CAST(SUM(b.amount) AS DOUBLE) AS revenue,
             COUNT(DISTINCT CASE WHEN year(b.dt) = year(f.first_dt) THEN b.CustomerId END) AS first_time_customers,
             COUNT(DISTINCT b.TrackId) AS unique_tracks_sold,
             COUNT(DISTINCT CASE WHEN year(b.dt) = year(t.first_dt) THEN b.TrackId END) AS first_tracks_sold,
             MAX(c.num_tracks) AS catalog_size
      FROM year_base b
      LEFT JOIN (SELECT CustomerId, MIN(dt) AS first_dt FROM year_base GROUP BY CustomerId) f
        ON f.CustomerId = b.CustomerId
      LEFT JOIN (SELECT TrackId, MIN(dt) AS first_dt FROM year_base GROUP BY TrackId) t ON t.TrackId = b.TrackId
      LEFT JOIN ({_catalog(name)}) c ON c.{name} = b.{name}
      GROUP BY 1, 2)"""


def _yearly(name: str, dates, **chosen) -> str:
    return _with("SELECT * FROM yearly", _yearly_cte(name, dates), **chosen)


def _bars(name: str, metric: str, max_n: int) -> str:
    exact, shown = ("DECIMAL(28,2)", "DOUBLE") if metric == "revenue" else ("BIGINT", "BIGINT")
    return _with(
        f"""SELECT y.*, CAST(t.total_metric AS {shown}) AS total_metric,
                   {_ratio('y.revenue', 'y.catalog_size')} AS revenue_per_catalog_track,
                   {_ratio('y.unique_tracks_sold', 'y.catalog_size')} AS pct_catalog_sold
            FROM yearly y
            JOIN (SELECT {name}, SUM(CAST({metric} AS {exact})) AS total_metric, MIN(year) AS first_year
                  FROM yearly GROUP BY {name}
                  ORDER BY total_metric DESC, first_year, {name} LIMIT {max_n}) t USING ({name})""",
        _yearly_cte(name, LONG),
    )


# Retention

_MONTH_NUMBER = "(year({0}) * 12 + month({0}))"


def _limit(tbl: str, max_offset: int | None) -> str:
    """Scalar SQL: the largest offset, by default the whole months the table spans."""
    if max_offset is not None:
        return str(max_offset)
    low, high = _MONTH_NUMBER.format("MIN(dt)"), _MONTH_NUMBER.format("MAX(dt)")
    late = "CASE WHEN day(MAX(dt)) < day(MIN(dt)) THEN 1 ELSE 0 END"
    return f"(SELECT {high} - {low} - {late} FROM {tbl})"


def _activity_ctes(tbl: str, dates, max_offset=None) -> tuple[str, str]:
    within = "TRUE" if dates is None else _days("e.dt", dates)
    offset = f"{_MONTH_NUMBER.format('e.dt')} - {_MONTH_NUMBER.format('c.cohort_month')}"
    return (
        """cohort_of AS (
          SELECT CustomerId, CAST(date_trunc('month', MIN(dt)) AS DATE) AS cohort_month
          FROM all_invoices WHERE CustomerId IS NOT NULL GROUP BY CustomerId)""",
        f"""activity AS (
          SELECT e.CustomerId, c.cohort_month, {offset} AS month_offset
          FROM {tbl} e JOIN cohort_of c ON c.CustomerId = e.CustomerId
          WHERE {within} AND {offset} BETWEEN 0 AND {_limit(tbl, max_offset)})""",
    )


def _matrix_ctes(tbl: str, dates, max_offset=None) -> tuple[str, ...]:
    return (
        *_activity_ctes(tbl, dates, max_offset),
        """matrix AS (
          SELECT a.cohort_month, CAST(a.month_offset AS INTEGER) AS month_offset,
                 COUNT(DISTINCT a.CustomerId) AS num_active_customers, MAX(z.cohort_size) AS cohort_size,
                 CAST(COUNT(DISTINCT a.CustomerId) AS DOUBLE) / MAX(z.cohort_size) AS retention_pct
          FROM activity a
          JOIN (SELECT cohort_month, COUNT(*) AS cohort_size FROM cohort_of GROUP BY 1) z
            ON z.cohort_month = a.cohort_month
          WHERE a.month_offset > 0 GROUP BY 1, 2)""",
    )


def _matrix(tbl: str, dates, max_offset=None, **chosen) -> str:
    return _with("SELECT * FROM matrix", *_matrix_ctes(tbl, dates, max_offset), **chosen)


def _grid(tbl: str, dates) -> str:
    return _with(
        """SELECT g.cohort_month, g.month_offset, m.num_active_customers, m.cohort_size, m.retention_pct
           FROM (SELECT CAST(unnest(generate_series(MIN(cohort_month), MAX(cohort_month), INTERVAL 1 MONTH)) AS DATE)
                          AS cohort_month FROM matrix) months
           CROSS JOIN (SELECT CAST(unnest(range(MIN(month_offset), MAX(month_offset) + 1)) AS INTEGER)
                          AS month_offset FROM matrix) offsets
           CROSS JOIN LATERAL (SELECT months.cohort_month, offsets.month_offset) g
           LEFT JOIN matrix m ON m.cohort_month = g.cohort_month AND m.month_offset = g.month_offset""",
        *_matrix_ctes(tbl, dates),
    )


def _decay(tbl: str, dates, max_offset=None, **chosen) -> str:
    return _with(
        """SELECT CAST(month_offset AS INTEGER) AS month_offset, COUNT(DISTINCT CustomerId) AS num_retained,
                  MAX(n) AS num_customers, CAST(COUNT(DISTINCT CustomerId) AS DOUBLE) / MAX(n) AS retention_rate
           FROM activity, (SELECT COUNT(DISTINCT CustomerId) AS n FROM activity)
           WHERE month_offset > 0 GROUP BY month_offset""",
        *_activity_ctes(tbl, dates, max_offset),
        **chosen,
    )


def _ends(tbl: str, dates) -> tuple[str, str]:
    if dates is None:
        return f"(SELECT MIN(dt) FROM {tbl})", f"(SELECT MAX(dt) FROM {tbl})"
    return f"DATE '{dates[0]}'", f"DATE '{dates[1]}'"


def _bounds_ctes(tbl: str, dates) -> tuple[str, ...]:
    """Every value read off a customer's dates in order (0-based undefined ones are NULL)."""
    start, end = _ends(tbl, dates)
    return (
        f"""dated AS (
          SELECT CustomerId, list(dt ORDER BY dt NULLS LAST) AS every, {start} AS low, {end} AS high
          FROM {tbl} WHERE CustomerId IS NOT NULL GROUP BY CustomerId)""",
        """parted AS (
          SELECT CustomerId, every, list_filter(every, lambda d: d < low) AS earlier,
                 list_filter(every, lambda d: d >= low AND d <= high) AS within,
                 list_filter(every, lambda d: d > high) AS later
          FROM dated)""",
        """bounds AS (
          SELECT CustomerId, every[1] AS first_date, every[2] AS second_date, list_max(every) AS last_date,
                 len(every) AS total_purchases, within[1] AS first_in_window, within[2] AS second_in_window,
                 within[-1] AS last_in_window, len(within) AS num_in_window, earlier[-1] AS last_before_window,
                 later[1] AS first_after_window
          FROM parted WHERE len(within) > 0)""",
    )


def _month_gap(a: str, b: str) -> str:
    return f"{_MONTH_NUMBER.format(b)} - {_MONTH_NUMBER.format(a)}"


def _derived_ctes(tbl: str, dates) -> tuple[str, ...]:
    start, end = _ends(tbl, dates)
    old, back = "last_before_window IS NOT NULL", "first_after_window IS NOT NULL"
    life = "total_purchases > 1"
    inside_average = (
        "CASE WHEN num_in_window > 1 THEN CAST(last_in_window - first_in_window AS DOUBLE) / (num_in_window - 1) END"
    )
    return (
        *_bounds_ctes(tbl, dates),
        f"""derived AS (
          SELECT *, NOT ({old}) AS cust_new, {life} AS repeat_any, ({old}) AS repeat_ret,
            (NOT ({old}) AND num_in_window > 1) OR (NOT ({old}) AND NOT ({back})) AS repeat_conv,
            num_in_window > 1 AS repeat_window,
            CASE WHEN {life} THEN CAST({_month_gap('first_date', 'last_date')} AS INTEGER) END AS lifespan_mo_total,
            CAST(CASE WHEN {old} AND {back} THEN {_month_gap(start, end)}
                 WHEN {back} THEN {_month_gap('first_in_window', end)}
                 WHEN {old} THEN {_month_gap(start, 'last_in_window')}
                 WHEN num_in_window <= 1 THEN NULL
                 ELSE {_month_gap('first_in_window', 'last_in_window')} END AS INTEGER) AS lifespan_mo_window,
            CASE WHEN {life} THEN CAST(second_date - first_date AS INTEGER) END AS gap_life,
            CAST(second_in_window - first_in_window AS INTEGER) AS gap_window,
            CAST(first_in_window - last_before_window AS INTEGER) AS gap_winback,
            CAST(first_after_window - last_in_window AS INTEGER) AS gap_retention,
            CASE WHEN {life} THEN CAST(last_date - first_date AS DOUBLE) / (total_purchases - 1) END AS avg_gap_life,
            {inside_average} AS avg_gap_window,
            CASE WHEN NOT ({old}) AND NOT ({back}) THEN {inside_average}
                 WHEN {old} AND {back} THEN
                   CAST(first_after_window - last_before_window AS DOUBLE) / (num_in_window + 1)
                 WHEN {back} THEN CAST(first_after_window - first_in_window AS DOUBLE) / num_in_window
                 ELSE CAST(last_in_window - last_before_window AS DOUBLE) / num_in_window END AS avg_gap_bound
          FROM bounds)""",
    )


_GAPS = ("avg_gap_life", "avg_gap_window", "avg_gap_bound")


def _behaviour(tbl: str, dates) -> str:
    rounded = ", ".join(f"round({name}, 6) AS {name}" for name in _GAPS)
    return _with(f"SELECT * REPLACE ({rounded}) FROM derived", *_derived_ctes(tbl, dates))


_SUMMARY = """summary AS (
  SELECT * FROM (
    SELECT COUNT(*) AS num_cust, COUNT(*) FILTER (WHERE cust_new) AS num_new,
      CAST(COUNT(*) FILTER (WHERE cust_new) AS DOUBLE) / NULLIF(COUNT(*), 0) AS pct_new,
      COUNT(*) FILTER (WHERE repeat_any) AS ret_n_any,
      CAST(COUNT(*) FILTER (WHERE repeat_any) AS DOUBLE) / NULLIF(COUNT(*), 0) AS ret_rate_any,
      COUNT(*) FILTER (WHERE repeat_ret) AS ret_n_return,
      CAST(COUNT(*) FILTER (WHERE repeat_ret) AS DOUBLE)
        / NULLIF(COUNT(*) - COUNT(*) FILTER (WHERE cust_new), 0) AS ret_rate_return,
      COUNT(*) FILTER (WHERE repeat_conv) AS ret_n_conv,
      CAST(COUNT(*) FILTER (WHERE repeat_conv) AS DOUBLE)
        / NULLIF(COUNT(*) FILTER (WHERE cust_new), 0) AS ret_rate_conv,
      COUNT(*) FILTER (WHERE repeat_window) AS ret_n_window,
      CAST(COUNT(*) FILTER (WHERE repeat_window) AS DOUBLE) / NULLIF(COUNT(*), 0) AS ret_rate_window,
      AVG(lifespan_mo_total) AS avg_life_mo_tot, AVG(lifespan_mo_window) AS avg_life_mo_win,
      CAST(median(gap_life) AS DOUBLE) AS med_gap_life, CAST(median(gap_window) AS DOUBLE) AS med_gap_window,
      CAST(median(gap_winback) AS DOUBLE) AS med_gap_winback, CAST(median(gap_retention) AS DOUBLE) AS med_gap_ret,
      AVG(avg_gap_life) AS avg_gap_life, AVG(avg_gap_window) AS avg_gap_window, AVG(avg_gap_bound) AS avg_gap_bound
    FROM derived)
  WHERE num_cust > 0)"""

_SUMMARY_KINDS = {
    "num_cust": "number",
    "num_new": "number",
    "pct_new": "percent",
    "ret_n_any": "number",
    "ret_rate_any": "percent",
    "ret_n_return": "number",
    "ret_rate_return": "percent",
    "ret_n_conv": "number",
    "ret_rate_conv": "percent",
    "ret_n_window": "number",
    "ret_rate_window": "percent",
    **{
        name: "float"
        for name in (
            "avg_life_mo_tot avg_life_mo_win med_gap_life med_gap_window med_gap_winback med_gap_ret "
            "avg_gap_life avg_gap_window avg_gap_bound"
        ).split()
    },
}


def _summary(tbl: str, dates) -> str:
    rounded = ", ".join(f"round({name}, 6) AS {name}" for name in ("avg_life_mo_tot", "avg_life_mo_win", *_GAPS))
    return _with(f"SELECT * REPLACE ({rounded}) FROM summary", *_derived_ctes(tbl, dates), _SUMMARY)


def _best_cte(offsets) -> str:
    def pick(column: str, k: int) -> str:
        return f"(SELECT {column} FROM matrix WHERE month_offset = {k} ORDER BY retention_pct DESC, cohort_month LIMIT 1)"

    columns = []
    for k in offsets:
        percent = pick(_text("retention_pct", "percent"), k)
        columns.append(f"strftime({pick('cohort_month', k)}, '%b %Y') AS top_cohort_month_{k}")
        columns.append(f"{percent} AS top_cohort_retention_{k}")
    return f"best AS (SELECT {', '.join(columns)})"


def _card(tbl: str, dates, **chosen) -> str:
    texts = ", ".join(f"{_text(name, kind)} AS {name}" for name, kind in _SUMMARY_KINDS.items())
    return _with(
        f"SELECT {texts}, best.* FROM summary, best",
        *_derived_ctes(tbl, dates),
        _SUMMARY,
        *_matrix_ctes(tbl, dates),
        _best_cte((3, 6, 9)),
        **chosen,
    )


def _best(tbl: str, dates) -> str:
    return _with("SELECT * FROM best", *_matrix_ctes(tbl, dates), _best_cte((3, 6, 9)))


# Reports


def _shared(dates, **chosen) -> str:
    return _with(
        f"""SELECT r.*, c.*, p.*, d.*
            FROM revenue r, customers c, purchases p,
                 (SELECT COUNT(DISTINCT s.genre) AS num_genre, COUNT(DISTINCT s.artist) AS num_artist,
                         COUNT(DISTINCT e.country) AS num_billingcountry
                  FROM {SET} e JOIN sales s ON s.InvoiceId = e.InvoiceId WHERE {_months('e.dt', dates)}) d""",
        _revenue_cte(SET, dates),
        _customers_cte(SET, dates),
        _purchases_cte(SET, dates),
        **chosen,
    )


def _shared_top_country(dates, **chosen) -> str:
    """The test nations have no code, so every label is empty."""
    return _with(
        f"""SELECT *, {_formatted(_RATIO_KINDS)}, '' AS group_label
            FROM (SELECT *, {_with_ratios('(SELECT total_revenue FROM revenue)')} FROM ranked)""",
        _groups_cte(SET, "e.country", dates),
        _revenue_cte(SET, dates),
        _ranked_cte("group_table"),
        **chosen,
    )


def _num_vals(dates, **chosen) -> str:
    counted = ", ".join(
        f"({kind!r}, (SELECT {_text(f'COUNT(DISTINCT {column})', 'number')} FROM sold))"
        for kind, column in (("Genre", "genre"), ("Artist", "artist"), ("BillingCountry", "country"))
    )
    return _with(
        f'SELECT * FROM (VALUES {counted}) AS t("group", num_vals)',
        f"""sold AS (
          SELECT s.genre, s.artist, e.country FROM {SET} e JOIN sales s ON s.InvoiceId = e.InvoiceId
          WHERE s.genre IS NOT NULL AND s.artist IS NOT NULL AND {_months('e.dt', dates)})""",
        **chosen,
    )


def _filter_meta() -> str:
    return _with(
        """SELECT 'min_date' AS kind, CAST(MIN(dt) AS VARCHAR) AS value FROM all_invoices
           UNION ALL SELECT 'max_date', CAST(MAX(dt) AS VARCHAR) FROM all_invoices
           UNION ALL SELECT DISTINCT 'genre', p_type FROM part
           UNION ALL SELECT DISTINCT 'artist', p_brand FROM part
           UNION ALL SELECT DISTINCT 'country', country FROM all_invoices WHERE country IS NOT NULL"""
    )


def _dataset() -> str:
    rows = [
        ("Date Range", "strftime(MIN(dt), '%b %Y') || ' – ' || strftime(MAX(dt), '%b %Y')", "all_invoices"),
        ("Number of Purchases", _text("total_orders", "number"), "purchases"),
        ("Number of Customers", _text("total_customers", "number"), "customers"),
        ("Tracks Sold", _text("total_tracks", "number"), "purchases"),
        ("Revenue (USD$)", _text("total_revenue", "dollar"), "revenue"),
        ("Number of Genres", _text("COUNT(DISTINCT p_type)", "number"), "part"),
        ("Number of Artists", _text("COUNT(DISTINCT p_brand)", "number"), "part"),
        ("Number of Countries", _text("COUNT(DISTINCT country)", "number"), "all_invoices"),
    ]
    body = " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS metric, {value} AS value FROM {source}"
        for i, (name, value, source) in enumerate(rows, start=1)
    )
    return _with(body, _revenue_cte(ALL, None), _customers_cte(ALL, None), _purchases_cte(ALL, None))


def _insight_values(tbl: str, dates) -> list[tuple[str, str, str]]:
    def leader(column: str, place: int) -> str:
        return f"""(SELECT name || ' (' || {_text('revenue', 'dollar')} || ')' FROM (
            SELECT {column} AS name, SUM(s.amount) AS revenue FROM {tbl} e
            JOIN sales s ON s.InvoiceId = e.InvoiceId WHERE {column} IS NOT NULL AND {_months('e.dt', dates)}
            GROUP BY {column} ORDER BY revenue DESC, name LIMIT 1 OFFSET {place - 1}))"""

    def single(column: str, table: str, kind: str) -> str:
        return f"(SELECT {_text(column, kind)} FROM {table}_{tbl})"

    def cohort(k: int) -> str:
        return f"""(SELECT COALESCE(top_cohort_month_{k}, 'NA') || ' (' || COALESCE(top_cohort_retention_{k}, 'NA')
            || ')' FROM best_{tbl})"""

    per_customer = f"""(SELECT {_text('total_revenue / total_customers', 'dollar')}
        FROM revenue_{tbl}, customers_{tbl})"""
    return [
        ("Revenue", "Total Revenue", single("total_revenue", "revenue", "dollar")),
        ("Revenue", "Top Market 1", leader("e.country", 1)),
        ("Revenue", "Top Market 2", leader("e.country", 2)),
        ("Revenue", "Top Market 3", leader("e.country", 3)),
        ("Revenue", "Top Genre", leader("s.genre", 1)),
        ("Revenue", "Top Artist", leader("s.artist", 1)),
        ("Purchases", "Total Orders", single("total_orders", "purchases", "number")),
        ("Purchases", "Avg Revenue per Order", single("avg_rev_per_order", "purchases", "dollar")),
        ("Purchases", "Total Tracks Sold", single("total_tracks", "purchases", "number")),
        ("Purchases", "Avg Tracks per Order", single("avg_tracks_per_order", "purchases", "float")),
        ("Customers", "Total Customers", single("total_customers", "customers", "number")),
        ("Customers", "% New Customers", single("pct_new_customers", "customers", "percent")),
        ("Customers", "Avg Revenue per Customer", per_customer),
        ("Customers", "Top 3-Month Retention", cohort(3)),
        ("Customers", "Top 6-Month Retention", cohort(6)),
    ]


def _renamed(cte: str, name: str, tbl: str) -> str:
    return cte.replace(f"{name} AS (", f"{name}_{tbl} AS (", 1)


def _insights(dates, **chosen) -> str:
    ctes = []
    for tbl, span in ((ALL, None), (SET, dates)):
        ctes.append(_renamed(_revenue_cte(tbl, span), "revenue", tbl))
        ctes.append(_renamed(_customers_cte(tbl, span), "customers", tbl))
        ctes.append(_renamed(_purchases_cte(tbl, span), "purchases", tbl))
        cohort, activity, matrix = _matrix_ctes(tbl, span)
        if tbl == ALL:
            ctes.append(cohort)
        ctes.append(_renamed(activity, "activity", tbl))
        ctes.append(_renamed(matrix, "matrix", tbl).replace("FROM activity a", f"FROM activity_{tbl} a"))
        ctes.append(_renamed(_best_cte((3, 6)), "best", tbl).replace("FROM matrix", f"FROM matrix_{tbl}"))
    overall, filtered = _insight_values(ALL, None), _insight_values(SET, dates)
    rows = [
        f"SELECT '{category}' AS category, {i} AS position, '{kpi}' AS kpi, {a} AS overall, {b} AS filtered"
        for i, ((category, kpi, a), (_, _, b)) in enumerate(zip(overall, filtered), start=1)
    ]
    return _with(" UNION ALL ".join(rows), *ctes, **chosen)


# Queries that must give the rows of another one, by another way.
_SAME = {
    f"dated_{name}": name
    for name in (
        "ts_monthly", "purchase_kpis", "customer_kpis", "ts_overview", "group_kpis_genre", "group_kpis_artist",
        "group_kpis_country", "geo_yearly", "group_yearly_genre", "events_genre", "events_artist", "events_month_rounded",
    )
} | {
    "history_customer_bounds": "customer_bounds",
    "history_customer_behaviour": "customer_behaviour",
    "history_customer_behaviour_all_time": "customer_behaviour_all_time",
    "history_appended_behaviour": "customer_behaviour_all_time",
    "history_retention_summary": "retention_summary",
    "history_cohort_matrix": "cohort_matrix",
    "history_appended_cohort_matrix": "cohort_matrix_invoice_table",
    "history_retention_decay": "retention_decay",
    "history_retention_decay_limited": "retention_decay_limited",
    "members_group_yearly_genre": "group_yearly_genre",
    "members_group_yearly_artist": "group_yearly_artist",
    "members_appended_group_yearly_genre": "group_yearly_genre",
}

_ORDERS = {
    "events_all": "dt, InvoiceId",
    "ts_monthly": "month",
    "geo_yearly": "year, country",
    "group_kpis_artist": "group_val",
    "group_kpis_country": "group_val",
    "group_yearly_genre": "year, genre",
    "group_yearly_artist": "year, artist",
    "cohort_matrix": "cohort_month, month_offset",
    "retention_decay": "month_offset",
    "topn_artist": "metric, rank",
    "group_bar_artist": "total_metric DESC, year, artist",
}


def _numbered(sql: str, order: str) -> str:
    keys = ", ".join(f"{key} NULLS LAST" for key in order.split(", "))
    return f"SELECT *, row_number() OVER (ORDER BY {keys}) AS position FROM ({sql})"


_CENTS = "CAST(ROUND({0} * 100) AS BIGINT)"


def _median_lines() -> str:
    return _with(f"""SELECT genre, COUNT(*) AS n, median({_CENTS.format('amount')}) / 100.0 AS median
      FROM sales WHERE genre IS NOT NULL AND artist IS NOT NULL GROUP BY genre""")


def _median_purchases(by: str | None) -> str:
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "HAVING COUNT(*) > 0")
    return _with(f"""SELECT {key}COUNT(*) AS n, median({_CENTS.format('amount')}) / 100.0 AS median
      FROM (SELECT e.InvoiceId, e.country, SUM(s.amount) AS amount FROM {SET} e JOIN sales s ON s.InvoiceId = e.InvoiceId
            WHERE {_months('e.dt', LONG)} GROUP BY e.InvoiceId, e.country) {group}""")


def _median_gaps() -> str:
    names = ("gap_life", "gap_window", "gap_winback", "gap_retention")
    each = [f"SELECT '{name}' AS gap, COUNT({name}) AS n, CAST(median({name}) AS DOUBLE) AS median FROM derived HAVING COUNT({name}) > 0" for name in names]
    return _with(" UNION ALL ".join(each), *_derived_ctes(SET, YEAR))


def oracle_sql() -> dict[str, str]:
    direct = _direct()
    direct["history_cohort_matrix_part_months"] = _matrix(SET, MID_MONTH)
    direct["history_cohort_matrix_century"] = _matrix(SET, CENTURY)
    direct["members_group_yearly_artist_one_year"] = _yearly("artist", YEAR)
    direct["median_line_revenue_genre"] = _median_lines()
    direct["median_purchase_country"] = _median_purchases("country")
    direct["median_purchase"] = _median_purchases(None)
    direct["median_gaps"] = _median_gaps()
    positions = {f"ordered_{name}": _numbered(direct[name], order) for name, order in _ORDERS.items()}
    return direct | positions | {name: direct[other] for name, other in _SAME.items()}


def _direct() -> dict[str, str]:
    return {
        "events_all": _events(),
        "events_country": _events(**COUNTRIES),
        "events_genre": _events(**GENRES),
        "events_artist": _events(**ARTISTS),
        "events_combined": _events(**COMBINATION),
        "events_month_rounded": _events(dates=MID_MONTH),
        "subset_metadata": _diversity(SET, YEAR),
        "subset_metadata_filtered": _diversity(SET, None, **COMBINATION),
        "subset_metadata_empty": _diversity(ALL, EMPTY),
        "revenue_kpis": _revenue(ALL, YEAR),
        "revenue_kpis_genre": _revenue(SET, MID_MONTH, **GENRES),
        "revenue_kpis_empty": _revenue(ALL, EMPTY),
        "customer_kpis": _customers(SET, YEAR),
        "customer_kpis_invoice_table": _customers(ALL, MID_MONTH),
        "customer_kpis_empty": _customers(ALL, EMPTY),
        "purchase_kpis": _purchases(SET, YEAR),
        "purchase_kpis_genre": _purchases(SET, YEAR, **GENRES),
        "purchase_kpis_empty": _purchases(ALL, EMPTY),
        "group_kpis_genre": _groups(SET, "s.genre", YEAR),
        "group_kpis_genre_filtered": _groups(SET, "s.genre", MID_MONTH, **GENRES),
        "group_kpis_artist": _groups(ALL, "s.artist", YEAR),
        "group_kpis_country": _groups(SET, "e.country", YEAR),
        "catalog_genre": _catalog("genre"),
        "catalog_artist": _catalog("artist"),
        "catalog_sales_genre": _coverage(SET, "genre", MID_MONTH, **COUNTRIES),
        "catalog_sales_artist": _coverage(ALL, "artist", YEAR),
        "group_kpis_genre_enriched": _enriched(SET, "genre", YEAR),
        "group_kpis_artist_enriched": _enriched(SET, "artist", YEAR, **COUNTRIES),
        "topn_genre": _top(SET, "s.genre", YEAR),
        "topn_artist": _top(SET, "s.artist", YEAR),
        "topn_country": _top(SET, "e.country", YEAR),
        "topn_revenue_artist": _groups(SET, "s.artist", YEAR) + " ORDER BY revenue DESC, group_val LIMIT 5",
        "topn_display_genre": _top_display("genre", YEAR),
        "topn_display_country": _top_display_country(),
        "ts_monthly": _monthly(YEAR),
        "ts_monthly_genre": _monthly(MID_MONTH, **GENRES),
        "ts_overview": _overview(YEAR, 12),
        "geo_yearly": _geo("geo_yearly", LONG, LONG_MONTHS),
        "geo_aggregate": _geo("geo_all", LONG, LONG_MONTHS),
        "geo_one_year": _geo("geo_yearly", MID_MONTH, MID_MONTHS, **ARTISTS),
        "geo_frames": _geo_frames(),
        "country_enriched": _countries(),
        "country_names": _country_names(),
        "group_yearly_genre": _yearly("genre", LONG),
        "group_yearly_artist": _yearly("artist", LONG),
        "group_yearly_genre_filtered": _yearly("genre", MID_MONTH, **ARTISTS),
        "group_bar_artist": _bars("artist", "revenue", 15),
        "group_bar_genre_customers": _bars("genre", "first_time_customers", 3),
        "cohort_matrix": _matrix(SET, YEAR),
        "cohort_matrix_invoice_table": _matrix(ALL, LONG),
        "cohort_matrix_genre": _matrix(SET, LONG, 12, **GENRES),
        "cohort_grid": _grid(SET, MID_MONTH),
        "retention_decay": _decay(SET, YEAR),
        "retention_decay_filtered": _decay(SET, LONG, **COMBINATION),
        "retention_decay_limited": _decay(ALL, LONG, 6),
        "customer_bounds": _with("SELECT * FROM bounds", *_bounds_ctes(SET, YEAR)),
        "customer_behaviour": _behaviour(SET, YEAR),
        "customer_behaviour_all_time": _behaviour(ALL, None),
        "retention_summary": _summary(SET, YEAR),
        "retention_kpis": _card(SET, YEAR),
        "retention_kpis_empty": _card(SET, EMPTY),
        "top_cohorts": _best(ALL, LONG),
        "shared_kpis": _shared(YEAR, **GENRES),
        "shared_kpis_topn_genre": _top_display("genre", YEAR, **GENRES),
        "shared_kpis_topn_artist": _top_display("artist", YEAR, **GENRES),
        "shared_kpis_topn_country": _shared_top_country(YEAR, **GENRES),
        "shared_kpis_num_vals": _num_vals(YEAR, **GENRES),
        "shared_kpis_retention": _card(SET, YEAR, **GENRES),
        "filter_meta": _filter_meta(),
        "dataset_overview": _dataset(),
        "insights_comparison": _insights(YEAR, **GENRES),
        "insights_comparison_combined": _insights(MID_MONTH, **COMBINATION),
    }
