"""SQL text of the expected results, for DuckDB.

``VIEWS`` are the retail tables over the generated tables; ``features`` spells out the whole
feature set with self joins instead of the window frames the Spark code uses.
"""

from __future__ import annotations

VIEWS = {
    "v_sales": """SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS BIGINT) AS store_nbr,
        CAST(l_partkey AS BIGINT) AS item_nbr, l_discount > 0.05 AS onpromotion,
        CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS unit_sales,
        l_orderkey, l_linenumber, l_linestatus FROM lineitem""",
    "v_pos": "SELECT *, greatest(unit_sales, 0) AS unit_sales_pos FROM v_sales",
    "v_items": """SELECT CAST(p_partkey AS BIGINT) AS item_nbr, p_type AS family,
        CAST(substr(p_brand, 7) AS INT) AS class,
        CASE WHEN p_size <= 10 THEN 1 ELSE 0 END AS perishable FROM part""",
    "v_stores": """SELECT CAST(s_suppkey AS BIGINT) AS store_nbr, n_name AS city, r_name AS state,
        chr(CAST(65 + s_suppkey % 5 AS INT)) AS type, CAST(s_suppkey % 17 AS INT) AS cluster
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "d_sales": """SELECT s.date, CAST(s_nationkey AS BIGINT) AS store_nbr, CAST(p_size AS BIGINT) AS item_nbr, s.onpromotion,
        s.unit_sales, s.l_orderkey, s.l_linenumber, s.l_linestatus
        FROM v_sales s JOIN supplier ON s_suppkey = s.store_nbr JOIN part ON p_partkey = s.item_nbr""",
    "d_pos": "SELECT *, greatest(unit_sales, 0) AS unit_sales_pos FROM d_sales",
    "d_items": """SELECT CAST(p_size AS BIGINT) AS item_nbr, min(p_type) AS family,
        min(CAST(substr(p_brand, 7) AS INT)) AS class,
        max(CASE WHEN p_size <= 10 THEN 1 ELSE 0 END) AS perishable FROM part GROUP BY p_size""",
    "d_stores": """SELECT CAST(n_nationkey AS BIGINT) AS store_nbr, n_name AS city, r_name AS state,
        chr(65 + n_nationkey % 5) AS type, n_nationkey % 17 AS cluster
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "d_transactions": """SELECT date, store_nbr,
        CAST(count(DISTINCT l_orderkey) AS DOUBLE) AS transactions
        FROM d_sales GROUP BY date, store_nbr, l_linestatus""",
    "d_oil": """SELECT d AS date, CASE WHEN extract(day FROM d) % 7 = 0 THEN NULL ELSE v END AS dcoilwtico
        FROM (SELECT CAST(o_orderdate AS DATE) AS d, min(o_totalprice) / 1000 AS v FROM orders
              GROUP BY CAST(o_orderdate AS DATE)) q WHERE isodow(d) - 1 < 5""",
    "d_hbase": """SELECT d, CAST(extract(year FROM d) AS INT) AS y, CAST(extract(month FROM d) AS INT) AS m,
        CAST(extract(day FROM d) AS INT) AS dd
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) q""",
    "d_hraw": """SELECT d, m,
        CASE dd WHEN 1 THEN 'National' WHEN 10 THEN 'Regional' ELSE 'Local' END AS locale,
        CASE dd WHEN 1 THEN 'ALL' WHEN 10 THEN r_name
             ELSE concat('NATION_', CAST(2 * m AS VARCHAR)) END AS locale_name,
        concat('H', CAST(y AS VARCHAR), '-', CAST(m AS VARCHAR)) AS description
        FROM d_hbase JOIN region ON r_regionkey = m % 5 WHERE dd IN (1, 10, 20)""",
    "d_holidays": """SELECT d AS date, 'Holiday' AS type, locale, locale_name, description,
        m % 4 = 0 AS transferred FROM d_hraw
        UNION ALL SELECT CAST(d + 3 AS DATE), 'Transfer', locale, locale_name, description, false
        FROM d_hraw WHERE m % 4 = 0""",
    "d_last": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY store_nbr, item_nbr, date
        ORDER BY l_orderkey DESC, l_linenumber DESC, unit_sales DESC) AS rn FROM d_sales) q
        WHERE rn = 1""",
    "d_trans_day": """SELECT store_nbr, date, sum(transactions) AS transactions
        FROM d_transactions GROUP BY store_nbr, date""",
    "d_oil_filled": """SELECT a.date, (SELECT max_by(b.dcoilwtico, b.date) FROM d_oil b
        WHERE b.date <= a.date AND b.dcoilwtico IS NOT NULL) AS dcoilwtico FROM d_oil a""",
    "d_oil_numbered": "SELECT *, row_number() OVER (ORDER BY date) AS rn FROM d_oil_filled",
    "d_oil_roll": """SELECT a.date, avg(b.dcoilwtico) AS oil_roll14 FROM d_oil_numbered a
        LEFT JOIN d_oil_numbered b ON b.rn BETWEEN a.rn - 14 AND a.rn - 1 GROUP BY a.date""",
    "d_oil_fallback": """SELECT avg(oil_roll14) AS oil_fallback FROM (
        SELECT oil_roll14 FROM d_oil_roll ORDER BY date DESC LIMIT 30) q""",
    "d_keyed": """SELECT *, concat(description, ' | ', locale, ' | ', locale_name) AS event_key
        FROM d_holidays""",
    "d_observed": """SELECT h.*, CASE WHEN h.type = 'Holiday' AND h.transferred
            THEN coalesce(t.moved_to, h.date) ELSE h.date END AS observed_date,
        CASE WHEN h.type = 'Holiday' THEN 1 ELSE 0 END AS f_holiday
        FROM d_keyed h LEFT JOIN (SELECT event_key, min(date) AS moved_to FROM d_keyed
            WHERE type = 'Transfer' GROUP BY event_key) t ON t.event_key = h.event_key""",
    "d_national": """SELECT observed_date AS date, max(f_holiday) AS nat_h FROM d_observed
        WHERE locale = 'National' GROUP BY observed_date""",
    "d_regional": """SELECT observed_date AS date, store_nbr, max(f_holiday) AS h FROM d_observed
        JOIN d_stores ON state = locale_name WHERE locale = 'Regional' GROUP BY observed_date, store_nbr""",
    "d_local": """SELECT observed_date AS date, store_nbr, max(f_holiday) AS h FROM d_observed
        JOIN d_stores ON city = locale_name WHERE locale = 'Local' GROUP BY observed_date, store_nbr""",
    "d_override": """SELECT date, store_nbr, max(h) AS h FROM
        (SELECT * FROM d_regional UNION ALL SELECT * FROM d_local) q GROUP BY date, store_nbr""",
}


def with_views(body, extra=""):
    """``body`` behind the views (and further named queries)."""
    views = ",\n".join(f"{name} AS ({text})" for name, text in VIEWS.items())
    return f"WITH {views}{extra}\n{body}"


def trans_roll(gap):
    return f"""SELECT a.store_nbr, a.date, avg(b.transactions) AS transactions_roll14
        FROM (SELECT *, row_number() OVER (PARTITION BY store_nbr ORDER BY date) AS rn FROM d_trans_day) a
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY store_nbr ORDER BY date) AS rn FROM d_trans_day) b
          ON b.store_nbr = a.store_nbr AND b.rn BETWEEN a.rn - {14 + gap} AND a.rn - {1 + gap}
        GROUP BY a.store_nbr, a.date"""


def item_features(items):
    return f"""SELECT i.item_nbr, i.perishable,
        f.n * 1.0 / t.n AS family_freq_items, c.n * 1.0 / t.n AS class_freq_items,
        p.n * 1.0 / f.n AS class_freq_in_family
        FROM {items} i
        JOIN (SELECT family, count(*) AS n FROM {items} GROUP BY family) f ON f.family = i.family
        JOIN (SELECT class, count(*) AS n FROM {items} GROUP BY class) c ON c.class = i.class
        JOIN (SELECT family, class, count(*) AS n FROM {items} GROUP BY family, class) p
          ON p.family = i.family AND p.class = i.class
        CROSS JOIN (SELECT count(*) AS n FROM {items}) t"""


def store_features(history, stores):
    located = f"(SELECT s.* FROM {history} h JOIN {stores} s ON s.store_nbr = h.store_nbr)"

    def share(key):
        return (
            f"coalesce((SELECT count(*) FROM {located} l WHERE l.{key} = s.{key}) * 1.0"
            f" / nullif((SELECT count(*) FROM {located} l), 0), 0)"
        )

    within = (
        f"coalesce((SELECT count(*) FROM {located} l WHERE l.state = s.state AND l.city = s.city) * 1.0"
        f" / nullif((SELECT count(*) FROM {located} l WHERE l.state = s.state), 0), 0)"
    )
    return f"""SELECT s.store_nbr, s.cluster, {share('type')} AS type_freq, {share('state')} AS state_freq,
        {share('city')} AS city_freq, {within} AS city_freq_in_state FROM {stores} s"""


def lag_roll(history, requests, gap):
    """Per distinct request key, from (store_nbr, item_nbr, date, y)."""
    return f"""SELECT k.store_nbr, k.item_nbr, k.date,
        max(CASE WHEN h.date = k.date - {28 + gap} THEN h.y END) AS sales_lag28,
        avg(CASE WHEN h.date >= k.date - {14 + gap} THEN h.y END) AS sales_roll14,
        CAST(count(CASE WHEN h.date >= k.date - {14 + gap} THEN h.y END) AS INT) AS sales_roll14_cnt
        FROM (SELECT DISTINCT store_nbr, item_nbr, date FROM {requests}) k
        LEFT JOIN {history} h ON h.store_nbr = k.store_nbr AND h.item_nbr = k.item_nbr
          AND (h.date BETWEEN k.date - {14 + gap} AND k.date - {1 + gap} OR h.date = k.date - {28 + gap})
        GROUP BY k.store_nbr, k.item_nbr, k.date"""


def hist(source, days):
    """Deduplicated history with its log target."""
    return f"""SELECT store_nbr, item_nbr, date, ln(1 + greatest(unit_sales, 0)) AS y FROM
        (SELECT *, row_number() OVER (PARTITION BY store_nbr, item_nbr, date
           ORDER BY l_orderkey DESC, l_linenumber DESC, unit_sales DESC) AS rn FROM {source}) q
        WHERE rn = 1 AND date >= (SELECT max(date) - {days} FROM {source})"""


def features(history, requests, gap, days):
    """Named queries up to ``enriched``: all features of ``requests`` fitted on ``history``
    (both names of views)."""
    return f""",
    s_hist AS ({hist(history, days)}),
    s_roll AS ({lag_roll('s_hist', requests, gap)}),
    s_trans AS ({trans_roll(gap)}),
    s_trans_last AS (SELECT store_nbr, max_by(transactions_roll14, date) AS last_roll FROM s_trans
        WHERE transactions_roll14 IS NOT NULL GROUP BY store_nbr),
    s_store AS (SELECT store_nbr, count(*) * 1.0 / (SELECT count(*) FROM {history}) AS store_freq
        FROM {history} GROUP BY store_nbr),
    s_item AS (SELECT item_nbr, count(*) * 1.0 / (SELECT count(*) FROM {history}) AS item_freq
        FROM {history} GROUP BY item_nbr),
    s_items_fe AS ({item_features('d_items')}),
    s_store_fe AS ({store_features(history, 'd_stores')}),
    enriched AS (SELECT r.*, CAST(extract(year FROM r.date) AS INT) AS year,
        CAST(extract(month FROM r.date) AS INT) AS month, CAST(extract(day FROM r.date) AS INT) AS day,
        CAST(isodow(r.date) - 1 AS INT) AS dow,
        CASE WHEN isodow(r.date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
        CASE WHEN r.onpromotion THEN 1 ELSE 0 END AS onpromo,
        coalesce(sf.store_freq, 0) AS store_freq, coalesce(itf.item_freq, 0) AS item_freq,
        coalesce(fe.perishable, 0) AS perishable,
        coalesce(fe.family_freq_items, 0) AS family_freq_items,
        coalesce(fe.class_freq_items, 0) AS class_freq_items,
        coalesce(fe.class_freq_in_family, 0) AS class_freq_in_family,
        coalesce(se.cluster, -1) AS cluster, coalesce(se.type_freq, 0) AS type_freq,
        coalesce(se.state_freq, 0) AS state_freq, coalesce(se.city_freq, 0) AS city_freq,
        coalesce(se.city_freq_in_state, 0) AS city_freq_in_state,
        coalesce(tr.transactions_roll14, tl.last_roll, 0) AS transactions_roll14,
        coalesce(o.oil_roll14, (SELECT oil_fallback FROM d_oil_fallback)) AS oil_roll14,
        greatest(coalesce(n.nat_h, 0), coalesce(ov.h, 0)) AS is_holiday_effective,
        sr.sales_lag28, CASE WHEN sr.sales_lag28 IS NULL THEN 0 ELSE 1 END AS sales_lag28_avail,
        sr.sales_roll14, sr.sales_roll14_cnt, sr.sales_roll14_cnt / 14.0 AS sales_roll14_frac
      FROM {requests} r
      LEFT JOIN s_store sf ON sf.store_nbr = r.store_nbr
      LEFT JOIN s_item itf ON itf.item_nbr = r.item_nbr
      LEFT JOIN s_items_fe fe ON fe.item_nbr = r.item_nbr
      LEFT JOIN s_store_fe se ON se.store_nbr = r.store_nbr
      LEFT JOIN s_trans tr ON tr.store_nbr = r.store_nbr AND tr.date = r.date
      LEFT JOIN s_trans_last tl ON tl.store_nbr = r.store_nbr
      LEFT JOIN d_oil_roll o ON o.date = r.date
      LEFT JOIN d_national n ON n.date = r.date
      LEFT JOIN d_override ov ON ov.store_nbr = r.store_nbr AND ov.date = r.date
      LEFT JOIN s_roll sr ON sr.store_nbr = r.store_nbr AND sr.item_nbr = r.item_nbr AND sr.date = r.date)"""
