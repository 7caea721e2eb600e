"""SQL twins of the registered queries, for an independent engine.

They read the same given tables and say the same thing in another way: records are
joined to all names first and summed as decimals, ranks and extremes are taken over
plain windows. Sums are exact on both sides, so results can be compared by value.
"""

from __future__ import annotations

# The star: one row per record with its names.
_STAR = """
WITH place AS (
    SELECT s_suppkey, s_name AS country, n_name AS region, r_name AS continent
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), emission AS (
    SELECT l_suppkey, p_type AS gas, CAST(year(l_shipdate) AS INTEGER) AS year,
           CAST(month(l_shipdate) AS INTEGER) AS month,
           year(l_shipdate) * 100 + month(l_shipdate) AS month_id,
           l_orderkey * 8 + l_linenumber AS id,
           l_extendedprice AS quantity, CAST(l_extendedprice AS DECIMAL(18, 2)) AS q
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
), rec AS (
    SELECT * FROM emission JOIN place ON l_suppkey = s_suppkey
)
"""

# The raw files: fire records and the country list.
_CORNERS = """concat_ws(',',
               l_partkey || ' ' || l_suppkey,
               '-' || l_partkey || '.5 ' || l_suppkey,
               '-' || l_partkey || '.5 -' || l_suppkey || '.25',
               l_partkey || ' -' || l_suppkey || '.25')"""
_ALPHA_3 = "CASE {0} WHEN 0 THEN 'XKX' WHEN 1 THEN 'SRB' ELSE 'S' || {0} END"

_RAW = f"""
WITH fires AS (
    SELECT {_ALPHA_3.format('l_suppkey')} AS iso3_country,
           l_returnflag AS original_inventory_sector,
           CASE WHEN l_linenumber = 7 AND l_quantity = 50 THEN 'junk'
                ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS start_time,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS end_time,
           l_linestatus AS temporal_granularity,
           CASE WHEN p_size = 50 THEN 'UNLISTED' ELSE p_type END AS gas,
           CAST(l_extendedprice AS DECIMAL(12, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2))) AS exact,
           CAST(exact AS DOUBLE) AS emissions_quantity,
           l_tax AS emissions_factor,
           CASE l_linenumber
                WHEN 1 THEN 'POLYGON ((' || {_CORNERS} || ',' || l_partkey || ' ' || l_suppkey || '))'
                WHEN 2 THEN 'POLYGON((' || {_CORNERS} || '))'
                ELSE 'POLYGON((' || {_CORNERS} || ',' || l_partkey || ' ' || l_suppkey || '))'
           END AS st_astext
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
), listed AS (
    SELECT s_name AS name,
           CASE WHEN s_suppkey = 3 THEN 'NA' ELSE 'S' || (s_suppkey % 10) END AS alpha_2,
           {_ALPHA_3.format('s_suppkey')} AS alpha_3,
           printf('%03d', s_suppkey) AS country_code,
           CASE WHEN s_acctbal >= 0 THEN r_name END AS region,
           CASE WHEN s_acctbal >= 0 THEN n_name END AS sub_region,
           CASE WHEN s_acctbal >= 0 THEN printf('%03d', r_regionkey) END AS region_code,
           CASE WHEN s_acctbal >= 0 THEN printf('%03d', n_nationkey) END AS sub_region_code
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
                  LEFT JOIN region ON n_regionkey = r_regionkey
)
"""

_POINT = r"[-0-9.]+ [-0-9.]+"
_RING = r"regexp_extract(st_astext, 'POLYGON\(\((" + ",".join([_POINT] * 5) + r")\)\)', 1)"
_TIME = "try_strptime(start_time, '%Y-%m-%d %H:%M:%S')"
_YEAR = f"CAST(year({_TIME}) AS INTEGER)"
_MONTH = f"CAST(month({_TIME}) AS INTEGER)"
_COORDINATES = ", ".join(f"string_split({_RING}, ',')[{i}] AS coordinates_{i}" for i in range(1, 6))

# The dimensions of the jobs.
_JOBS = _RAW + f""", cleaned AS (
    SELECT replace(iso3_country, 'XKX', 'SRB') AS alpha_3, original_inventory_sector AS cause,
           temporal_granularity, gas, round(exact, 3) AS q, CAST(q AS DOUBLE) AS emissions_quantity,
           emissions_factor, {_YEAR} AS year, {_MONTH} AS month, {_COORDINATES}
    FROM fires
), located AS (
    SELECT country_code, sub_region_code, q FROM cleaned LEFT JOIN listed USING (alpha_3)
), country_total AS (
    SELECT country_code, CAST(sum(q) AS DOUBLE) AS total_gas_emission FROM located GROUP BY 1
), region_total AS (
    SELECT sub_region_code, CAST(sum(q) AS DOUBLE) AS total_gas_emission FROM located
    WHERE sub_region_code IS NOT NULL GROUP BY 1
), year_dim AS (
    SELECT CAST(coalesce(year, 0) AS BIGINT) AS id, year AS value,
           CAST(sum(q) AS DOUBLE) AS total_gas_emission
    FROM cleaned GROUP BY year
), month_dim AS (
    SELECT CAST(coalesce(year, 0) * 100 + coalesce(month, 0) AS BIGINT) AS id,
           monthname(make_date(2000, month, 1)) AS name, month AS num_value, y.id AS year_id
    FROM (SELECT DISTINCT year, month FROM cleaned) LEFT JOIN year_dim y ON year = value
), gas_dim AS (
    SELECT CAST('0x' || substr(md5(p_type), 1, 15) AS BIGINT) AS id, lower(p_type) AS name, p_type AS chemical_label
    FROM (SELECT DISTINCT p_type FROM part)
), lookup AS (
    SELECT year_id, num_value, m.id AS month_id, value
    FROM month_dim m LEFT JOIN year_dim y ON m.year_id = y.id
), country_dim AS (
    SELECT country_code AS code, name, alpha_2, alpha_3, sub_region_code AS region_code, total_gas_emission
    FROM listed LEFT JOIN country_total USING (country_code)
), region_dim AS (
    SELECT sub_region_code AS code, sub_region AS name, region_code AS continent_code, total_gas_emission
    FROM (SELECT DISTINCT sub_region_code, sub_region, region_code FROM listed
          WHERE coalesce(sub_region_code, sub_region, region_code) IS NOT NULL)
         LEFT JOIN region_total USING (sub_region_code)
), continent_dim AS (
    SELECT DISTINCT region_code AS code, region AS name FROM listed
    WHERE coalesce(region_code, region) IS NOT NULL
), fact AS (
    SELECT coalesce(f.year, 0) * 1099511627776 + row_number() OVER (PARTITION BY f.year ORDER BY md5(concat_ws('|',
               coalesce(CAST(f.month AS VARCHAR), '-'), coalesce(f.alpha_3, '-'), coalesce(f.gas, '-'),
               coalesce(CAST(CAST(q * 1000 AS BIGINT) AS VARCHAR), '-')))) AS id,
           emissions_quantity AS quantity, q, c.code AS country_code, l.month_id, g.id AS gas_id,
           CASE WHEN l.month_id IS NOT NULL THEN f.year END AS year
    FROM cleaned f LEFT JOIN country_dim c ON f.alpha_3 = c.alpha_3
                   LEFT JOIN gas_dim g ON f.gas = g.chemical_label
                   LEFT JOIN lookup l ON f.month = l.num_value AND f.year = l.value
)
"""


def _star(select: str) -> str:
    return _STAR + select


def _raw(select: str) -> str:
    return _RAW + select


def _jobs(select: str) -> str:
    return _JOBS + select


def _sums(*names: str) -> str:
    """Subquery ``t`` with ``total`` by columns of the named records."""
    columns = ", ".join(names)
    return f"(SELECT {columns}, sum(q) AS total FROM rec GROUP BY {columns}) t"


def _ranked(partition: str, *names: str, k: int) -> str:
    """Subquery ``r`` with the top ``k`` of the totals by RANK."""
    rank = f"CAST(rank() OVER (PARTITION BY {partition} ORDER BY total DESC) AS INTEGER) AS emission_rank"
    return f"(SELECT *, {rank} FROM {_sums(*names)} QUALIFY emission_rank <= {k}) r"


_CLEANED_COLUMNS = (
    "alpha_3, cause, temporal_granularity, gas, emissions_quantity, emissions_factor, year, month, "
    "coordinates_1, coordinates_2, coordinates_3, coordinates_4, coordinates_5"
)
_NOT_NULL = " UNION ALL ".join(
    f"SELECT '{table}.{key}' AS rule, count(*) - count({key}) AS nulls FROM {rows}"
    for table, key, rows in (
        ("continent", "code", "(SELECT region_code AS code FROM listed)"),
        ("region", "code", "(SELECT sub_region_code AS code FROM listed)"),
        ("country", "code", "(SELECT country_code AS code FROM listed)"),
        ("year", "id", "(SELECT year AS id FROM cleaned)"),
        ("month", "id", "(SELECT month AS id FROM cleaned)"),
        ("gas", "id", "gas_dim"),
        ("gas_emission", "id", "(SELECT 1 AS id FROM cleaned)"),
    )
)
_TYPES = {
    "continent": "code string, name string",
    "region": "code string, name string, total_gas_emission double, continent_code string",
    "country": "code string, name string, alpha_3 string, total_gas_emission double, "
    "region_code string, alpha_2 string",
    "year": "id bigint, value int, total_gas_emission double",
    "month": "id bigint, name string, num_value int, year_id bigint",
    "gas": "id bigint, name string, chemical_label string",
    "gas_emission": "id bigint, quantity double, country_code string, month_id bigint, "
    "gas_id bigint, year int",
}
_ROWS = {
    "continent": "(SELECT 1 FROM region)",
    "region": "(SELECT 1 FROM nation)",
    "country": "(SELECT 1 FROM supplier)",
    "year": "(SELECT DISTINCT year FROM emission)",
    "month": "(SELECT DISTINCT month_id FROM emission)",
    "gas": "(SELECT DISTINCT p_type FROM part)",
    "gas_emission": "emission",
}
_DDL = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{types}' AS column_types, count(*) AS records FROM {_ROWS[name]}"
    for name, types in _TYPES.items()
)
_ORPHANS = " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, CAST({column} AS VARCHAR) AS key_value, count(*) AS records "
    f"FROM {table} WHERE {column} IS NULL OR {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL) "
    f"GROUP BY {column}"
    for rule, table, column, parent, key in (
        ("region.continent_code", "region_dim", "continent_code", "continent_dim", "code"),
        ("country.region_code", "country_dim", "region_code", "region_dim", "code"),
        ("month.year_id", "month_dim", "year_id", "year_dim", "id"),
        ("gas_emission.country_code", "fact", "country_code", "country_dim", "code"),
        ("gas_emission.month_id", "fact", "month_id", "month_dim", "id"),
        ("gas_emission.gas_id", "fact", "gas_id", "gas_dim", "id"),
    )
)
_REFRESHED = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS records, {total} AS total FROM {table}"
    for name, table, total in (
        ("continent", "continent_dim", "CAST(NULL AS DOUBLE)"),
        ("region", "region_dim", "CAST(sum(CAST(total_gas_emission AS DECIMAL(18, 3))) AS DOUBLE)"),
        ("country", "country_dim", "CAST(sum(CAST(total_gas_emission AS DECIMAL(18, 3))) AS DOUBLE)"),
        ("year", "year_dim", "CAST(sum(CAST(total_gas_emission AS DECIMAL(18, 3))) AS DOUBLE)"),
        ("month", "month_dim", "CAST(NULL AS DOUBLE)"),
        ("gas", "gas_dim", "CAST(NULL AS DOUBLE)"),
        ("gas_emission", "fact", "CAST(sum(q) AS DOUBLE)"),
    )
)
_TOP_GASES = f"(SELECT * FROM {_ranked('year, country', 'country', 'year', 'gas', k=2)})"
_MEANS = """
    SELECT country AS country_name, gas AS gas_name,
           CAST(sum(q) AS DOUBLE) / count(q) AS avg_country_gas_emission,
           any_value(overall) AS global_avg_gas_emission
    FROM rec JOIN (SELECT gas, CAST(sum(q) AS DOUBLE) / count(q) AS overall
                   FROM emission GROUP BY gas) USING (gas)
    GROUP BY country, gas
"""
_PAIRS = """SELECT gas, country, CAST(sum(q) AS DOUBLE) AS total_emission FROM rec GROUP BY gas, country
            ORDER BY sum(q) DESC, gas, country"""
# The order within a month that `centred_mean` chooses.
_RECORD_ORDER = "month, q NULLS FIRST"

_ORACLES = {
    "src_csv_file": _raw("SELECT * FROM listed"),
    # A CSV reader takes '' for NULL, as for any empty field.
    "src_csv_dir": _jobs(
        f"SELECT * REPLACE (nullif(coordinates_1, '') AS coordinates_1) FROM (SELECT {_CLEANED_COLUMNS} FROM cleaned)"
    ),
    "src_table": """
        SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS name, n_name AS region
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "sink_csv_overwrite": _jobs("SELECT * FROM year_dim"),
    "sink_table_overwrite": _star("""
        SELECT id, quantity, CAST(l_suppkey AS VARCHAR) AS country_code, month_id, gas, year FROM emission"""),
    "ddl_star_schema": _star(_DDL),
    "audit_primary_key": _star("""
        SELECT 'gas_emission.id' AS rule, CAST(id AS VARCHAR) AS key_value, count(*) AS records
        FROM emission GROUP BY id HAVING count(*) > 1"""),
    "audit_foreign_key": _jobs(_ORPHANS),
    "audit_not_null": _jobs(_NOT_NULL),
    "audit_csv_fields": _raw("""
        SELECT 'emissions_factor' AS column_name, count(*) FILTER (emissions_factor > 0.05 AND gas IS DISTINCT FROM 'UNLISTED') AS malformed FROM fires
        UNION ALL SELECT 'emissions_quantity', count(*) FILTER (temporal_granularity = 'F' AND gas IS DISTINCT FROM 'UNLISTED') FROM fires
        UNION ALL SELECT '(whole line)', count(*) FILTER (gas = 'UNLISTED') FROM fires"""),
    "audit_quantities": _jobs("""
        SELECT count(*) FILTER (cause = 'R') AS not_finite, count(*) FILTER (cause = 'A' AND q IS NOT NULL) AS finer
        FROM cleaned"""),
    "proj_select": _raw("SELECT iso3_country, gas, emissions_quantity FROM fires"),
    "proj_rename": _raw(
        "SELECT iso3_country AS alpha_3, original_inventory_sector AS cause, gas FROM fires"
    ),
    "proj_with_column": _raw(f"""
        SELECT start_time, CAST(round(exact, 3) AS DOUBLE) AS emissions_quantity, {_YEAR} AS year FROM fires"""),
    "proj_loop_columns": _raw(f"SELECT {_RING} AS ring, {_COORDINATES} FROM fires"),
    "proj_drop": _raw("SELECT * EXCLUDE (start_time, end_time, exact) FROM fires"),
    "filter_eq": _star("SELECT country, year, quantity FROM rec WHERE continent = 'ASIA' AND year = 2000"),
    "filter_rank_le": _star(
        f"SELECT gas, year, emission_rank FROM {_ranked('year', 'gas', 'year', k=2)}"
    ),
    "filter_having": _star(f"""
        SELECT region, gas, CAST(total AS DOUBLE) AS total FROM {_sums('region', 'gas')}
        JOIN (SELECT gas, CAST(sum(total) AS DOUBLE) / count(*) AS middle
              FROM {_sums('region', 'gas')} GROUP BY gas) USING (gas)
        WHERE CAST(total AS DOUBLE) > 1.1 * middle"""),
    "filter_dropna_all": _raw("""
        SELECT sub_region_code AS code, sub_region AS name FROM listed
        WHERE sub_region_code IS NOT NULL OR sub_region IS NOT NULL"""),
    "filter_dropna_subset": _raw("SELECT name, region_code FROM listed WHERE region_code IS NOT NULL"),
    "case_when": _star(f"""
        SELECT a.gas, a.year, CASE WHEN b.total IS NULL THEN 'Last' WHEN b.total > a.total THEN 'Increased'
                                   ELSE 'Decreased' END AS direction
        FROM (SELECT * FROM {_sums('gas', 'year')}) a
        LEFT JOIN (SELECT * FROM {_sums('gas', 'year')}) b ON a.gas = b.gas AND a.year + 1 = b.year"""),
    "join_left_equi": _jobs("""
        SELECT name, listed.alpha_3, CAST(sum(q) AS DOUBLE) AS total
        FROM listed LEFT JOIN cleaned USING (alpha_3) GROUP BY ALL"""),
    "join_left_using": _jobs("SELECT year_id, num_value, month_id, value FROM lookup"),
    "join_left_composite": _jobs("""
        SELECT month_id, year, month, gas, count(*) AS records
        FROM cleaned LEFT JOIN lookup ON month = num_value AND year = value GROUP BY ALL"""),
    "join_inner_star": _star("""
        SELECT continent, region, country, gas, year, month, CAST(sum(q) AS DOUBLE) AS total
        FROM rec GROUP BY ALL"""),
    "join_comma_mixed": _star(f"""
        SELECT t.country AS country_name, t.year, CAST(sum(e.q) AS DOUBLE) AS emission
        FROM {_TOP_GASES} t JOIN rec e ON t.country = e.country GROUP BY ALL"""),
    "join_self_offset": _star(f"""
        SELECT a.continent, a.year, CAST(a.total AS DOUBLE) AS total, CAST(b.total AS DOUBLE) AS next_total
        FROM (SELECT * FROM {_sums('continent', 'year')}) a
        JOIN (SELECT * FROM {_sums('continent', 'year')}) b ON a.continent = b.continent AND a.year = b.year - 1"""),
    "join_back_to_max": _star(f"""
        SELECT gas, year, CAST(total AS DOUBLE) AS max_total FROM {_sums('gas', 'year')}
        WHERE (gas, total) IN (SELECT (gas, max(total)) FROM {_sums('gas', 'year')} GROUP BY gas)"""),
    "join_agg_to_detail": _star(_MEANS),
    "agg_sum_group": _star(f"SELECT country, gas, CAST(total AS DOUBLE) AS total FROM {_sums('country', 'gas')}"),
    "agg_sum_rounded": _jobs("SELECT cause, CAST(sum(q) AS DOUBLE) AS total_gas_emission FROM cleaned GROUP BY 1"),
    "agg_avg_group": _star("""
        SELECT gas, year, CAST(sum(q) AS DOUBLE) / count(q) AS mean_quantity FROM emission GROUP BY ALL"""),
    "agg_max_group": _star(f"""
        SELECT continent, CAST(max(total) AS DOUBLE) AS max_total FROM {_sums('continent', 'year')} GROUP BY 1"""),
    "agg_range": _star(f"""
        SELECT gas, CAST(max(total) - min(total) AS DOUBLE) AS spread FROM {_sums('gas', 'year')} GROUP BY 1"""),
    "agg_distinct_rows": _jobs("SELECT DISTINCT month, year FROM cleaned"),
    "agg_group_as_distinct": _star("SELECT country, year, gas, quantity FROM rec GROUP BY ALL"),
    "win_rank_over_sum": _star(f"SELECT gas, year, emission_rank FROM {_ranked('year', 'gas', 'year', k=1000)}"),
    "win_lag_over_sum": _star(f"""
        SELECT continent, year,
               CAST(total - lag(total) OVER (PARTITION BY continent ORDER BY year) AS DOUBLE) AS quantity_increase
        FROM {_sums('continent', 'year')}"""),
    "win_row_number": _star(f"""
        SELECT gas, region,
               CAST(row_number() OVER (PARTITION BY gas ORDER BY total DESC, region) AS INTEGER) AS position
        FROM {_sums('gas', 'region')}"""),
    "win_moving_avg": _star("""
        SELECT gas, month_id, CAST(sum(total) OVER w AS DOUBLE) / count(total) OVER w AS moving_avg
        FROM (SELECT gas, month_id, sum(q) AS total FROM emission GROUP BY ALL)
        WINDOW w AS (PARTITION BY gas ORDER BY month_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"""),
    "sort_global": _star(f"""
        SELECT country, year, CAST(total AS DOUBLE) AS total FROM {_sums('country', 'year')}
        ORDER BY year, t.total DESC, country"""),
    "top_1": _star(f"""
        SELECT country, CAST(total AS DOUBLE) AS total FROM {_sums('country')}
        ORDER BY t.total DESC, country LIMIT 1"""),
    "top_k_per_group": _star(f"""
        SELECT region, year, CAST(total AS DOUBLE) AS total, emission_rank
        FROM {_ranked('year', 'region', 'year', k=3)}"""),
    "fn_round": _raw("SELECT emissions_quantity, CAST(round(exact, 3) AS DOUBLE) AS rounded FROM fires"),
    "fn_to_timestamp": _raw(f"SELECT start_time, {_TIME} AS parsed FROM fires"),
    "fn_year_month": _raw(f"SELECT {_YEAR} AS year, {_MONTH} AS month FROM fires"),
    "fn_month_name": _jobs("SELECT month, monthname(make_date(2000, month, 1)) AS name FROM cleaned"),
    "fn_regexp_extract": _raw(f"SELECT st_astext, {_RING} AS ring FROM fires"),
    "fn_regexp_replace": _raw(
        "SELECT iso3_country, regexp_replace(iso3_country, 'XKX', 'SRB', 'g') AS alpha_3 FROM fires"
    ),
    "fn_split": _raw(f"""
        SELECT st_astext, CAST(len(string_split({_RING}, ',')) AS INTEGER) AS points FROM fires"""),
    "fn_array_item": _raw(f"""
        SELECT string_split({_RING}, ',')[1] AS first, string_split({_RING}, ',')[5] AS last FROM fires"""),
    "fn_cast": _jobs("SELECT CAST(month AS VARCHAR) AS month_text, month FROM cleaned"),
    "fn_surrogate_key": _jobs("SELECT * FROM gas_dim"),
    "fn_arith_compare": _raw("""
        SELECT emissions_quantity, emissions_factor, exact > 50000 AS large,
               exact <= 50000 AND emissions_factor < 0.05 AS small,
               CAST(round(emissions_factor * 100) AS INTEGER) - 1 AS less_one
        FROM fires"""),
    "job_clean_fires": _jobs(f"SELECT {_CLEANED_COLUMNS} FROM cleaned"),
    "job_country_totals": _jobs("SELECT * FROM country_total"),
    "job_region_totals": _jobs("SELECT * FROM region_total"),
    "job_dim_country": _jobs("SELECT * FROM country_dim"),
    "job_dim_region": _jobs("SELECT * FROM region_dim"),
    "job_dim_continent": _jobs("SELECT * FROM continent_dim"),
    "job_dim_year": _jobs("SELECT * FROM year_dim"),
    "job_dim_month": _jobs("SELECT * FROM month_dim"),
    "job_dim_gas": _jobs("SELECT * FROM gas_dim ORDER BY chemical_label"),
    "job_time_lookup": _jobs("SELECT year_id, num_value, month_id, value FROM lookup"),
    "job_fact_emission": _jobs("SELECT * EXCLUDE (q) FROM fact"),
    "job_full_refresh": _jobs(_REFRESHED),
    "sink_csv_ordered": _star("SELECT count(DISTINCT country) AS countries, 0 AS breaches FROM rec"),
    "job_incremental_refresh": _jobs(_REFRESHED),
    "src_csv_quarantine": _raw("""
        SELECT CASE WHEN gas = 'UNLISTED' THEN '(field too many)' WHEN temporal_granularity = 'F' THEN '(no number)'
                    ELSE gas END AS gas, count(*) AS lines
        FROM fires GROUP BY 1"""),
    "wh_star_during": _jobs("""
        SELECT c.name AS country, max(quantity) AS largest, min(quantity) AS smallest, count(*) AS records
        FROM fact f JOIN month_dim m ON f.month_id = m.id JOIN year_dim y ON m.year_id = y.id
             JOIN country_dim c ON f.country_code = c.code
        WHERE m.num_value = 6 AND y.total_gas_emission > (SELECT avg(total_gas_emission) FROM year_dim)
        GROUP BY f.country_code, c.name"""),
    "q01_top_month": _star("""
        SELECT CAST(sum(q) AS DOUBLE) AS max_total_emission, month_id,
               monthname(make_date(2000, month, 1)) AS month_name
        FROM emission WHERE year = 1998 GROUP BY month_id, month
        QUALIFY row_number() OVER (ORDER BY sum(q) DESC, month_id) = 1"""),
    "q02_literal": _star(f"""
        SELECT t.country AS country_name, t.year, CAST(round(sum(e.q), 2) AS DOUBLE) AS cumulative_emission
        FROM {_TOP_GASES} t JOIN rec e ON t.country = e.country GROUP BY ALL"""),
    "q02_top2_cumulative": _star(f"""
        SELECT country AS country_name, year,
               CAST(round(sum(sum(total)) OVER (PARTITION BY country ORDER BY year), 2) AS DOUBLE)
                   AS cumulative_emission
        FROM {_TOP_GASES} t GROUP BY country, year"""),
    "q03_max_yoy_increase": _star(f"""
        SELECT continent AS continent_name, year, CAST(round(step, 2) AS DOUBLE) AS max_increase
        FROM (SELECT continent, year, total - lag(total) OVER (PARTITION BY continent ORDER BY year) AS step
              FROM {_sums('continent', 'year')})
        WHERE step IS NOT NULL QUALIFY step = max(step) OVER (PARTITION BY continent)"""),
    "q04_rank_change": _star(f"""
        , ranks AS (SELECT country, year, rank() OVER (PARTITION BY country ORDER BY total DESC) AS place
                    FROM {_sums('continent', 'country', 'year')} WHERE continent = 'EUROPE')
        SELECT a.country AS country_name, a.year,
               CASE sign(b.place - a.place) WHEN 0 THEN 'Stable' WHEN 1 THEN 'Increased'
                                            ELSE 'Decreased' END AS rank_change
        FROM ranks a JOIN ranks b ON a.country = b.country AND b.year = a.year + 1"""),
    "q04_yoy_direction": _star(f"""
        , yearly AS (SELECT country, year, total FROM {_sums('continent', 'country', 'year')}
                     WHERE continent = 'EUROPE')
        SELECT b.country AS country_name, b.year,
               CASE WHEN CAST(abs(b.total - a.total) AS DOUBLE) <= CAST(a.total AS DOUBLE) * 0.05 THEN 'Stable'
                    WHEN b.total > a.total THEN 'Increased' ELSE 'Decreased' END AS direction
        FROM yearly a JOIN yearly b ON a.country = b.country AND b.year = a.year + 1"""),
    "q05_rank_asia": _star("""
        SELECT year, country AS country_name, CAST(round(sum(q), 2) AS DOUBLE) AS total_gas_emission,
               CAST(rank() OVER (ORDER BY sum(q) DESC) AS INTEGER) AS emission_rank
        FROM rec WHERE continent = 'ASIA' AND year = 2000 GROUP BY year, country"""),
    "q06_top3_by_gas_year": _star(f"""
        SELECT gas AS gas_name, country AS country_name, year, CAST(round(total, 2) AS DOUBLE) AS total_emission
        FROM {_ranked('gas, year', 'gas', 'country', 'year', k=3)}"""),
    "q07_above_global_avg": _star(f"""
        SELECT * FROM ({_MEANS}) WHERE avg_country_gas_emission > 1.1 * global_avg_gas_emission"""),
    "q08_largest_record": _star("""
        SELECT country AS country_name, year, gas, quantity FROM rec
        QUALIFY row_number() OVER (PARTITION BY year ORDER BY quantity DESC, country, gas) = 1
        ORDER BY year"""),
    "q09_moving_avg_records": _star(f"""
        SELECT country, year, month, gas, CAST(sum(q) OVER w AS DOUBLE) / count(q) OVER w AS moving_avg
        FROM rec WHERE region = 'NATION_1' AND year = 2000
        WINDOW w AS (PARTITION BY country, gas ORDER BY {_RECORD_ORDER}
                     ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"""),
    "q09_moving_avg_months": _star("""
        SELECT country, year, month, gas, CAST(sum(total) OVER w AS DOUBLE) / count(total) OVER w AS moving_avg
        FROM (SELECT country, year, month, gas, sum(q) AS total FROM rec
              WHERE region = 'NATION_1' AND year = 2000 GROUP BY ALL)
        WINDOW w AS (PARTITION BY country, gas ORDER BY month ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"""),
    "q10_continent_range": _star(f"""
        SELECT continent, CAST(max(total) - min(total) AS DOUBLE) AS emission_increase
        FROM {_sums('continent', 'year')} GROUP BY continent ORDER BY 2 DESC, 1"""),
    "q11_country_year_sum": _star(
        f"SELECT country, year, CAST(total AS DOUBLE) AS sum FROM {_sums('country', 'year')}"
    ),
    "chart_total": _star("SELECT CAST(sum(q) AS DOUBLE) AS total_emission FROM emission"),
    "chart_share": _star("""
        SELECT gas, CAST(sum(q) AS DOUBLE) AS total_emission,
               CAST(sum(q) AS DOUBLE) / CAST(sum(sum(q)) OVER () AS DOUBLE) AS share
        FROM emission GROUP BY gas ORDER BY sum(q) DESC"""),
    "chart_stacked": _star("""
        SELECT region, gas, CAST(total AS DOUBLE) AS total_emission,
               CAST(sum(total) OVER (PARTITION BY region) AS DOUBLE) AS axis_total
        FROM (SELECT region, gas, sum(q) AS total FROM rec GROUP BY ALL)"""),
    "chart_top_pairs": _star(f"""
        SELECT *, CAST(ceil(row_number() OVER (ORDER BY total_emission DESC, gas, country) / 10) AS INTEGER) AS page
        FROM ({_PAIRS})"""),
    "chart_bar_pairs": _star(_PAIRS),
}

# The same bodies over the stored warehouse: which names a record must have to count.
_NEEDED = {
    "q01_top_month": "month_id",
    "q02_literal": "country, gas, year",
    "q02_top2_cumulative": "country, gas, year",
    "q03_max_yoy_increase": "continent, year",
    "q04_rank_change": "continent, country, year",
    "q04_yoy_direction": "continent, country, year",
    "q05_rank_asia": "continent, country, year",
    "q06_top3_by_gas_year": "gas, country, year",
    "q07_above_global_avg": "gas",
    "q08_largest_record": "country, gas, year",
    "q09_moving_avg_records": "region, country, gas, month",
    "q09_moving_avg_months": "region, country, gas, month",
    "q10_continent_range": "continent, year",
    "q11_country_year_sum": "country, year",
    "chart_total": "",
    "chart_share": "",
    "chart_stacked": "",
    "chart_top_pairs": "",
    "chart_bar_pairs": "",
}


def _warehouse(name: str) -> str:
    """The star is made from the job's fact, which has NULL keys and countries without region."""
    places = {"country", "region", "continent"}
    needed = [x for x in _NEEDED[name].split(", ") if x]
    placed = "country IS NOT NULL AND " if places & set(needed) or name == "q07_above_global_avg" else ""
    named = placed + (" AND ".join(f"{x} IS NOT NULL" for x in needed) or "true")
    dated = " AND ".join(f"{x} IS NOT NULL" for x in needed if x not in places) or "true"
    return (
        _JOBS
        + f""", dated AS (
    SELECT f.country_code, g.name AS gas, f.year, m.num_value AS month, f.month_id, f.quantity, f.q
    FROM fact f LEFT JOIN gas_dim g ON f.gas_id = g.id LEFT JOIN month_dim m ON f.month_id = m.id
), placed AS (
    SELECT d.*, c.name AS country, r.name AS region, k.name AS continent
    FROM dated d LEFT JOIN country_dim c ON d.country_code = c.code
                 LEFT JOIN region_dim r ON c.region_code = r.code
                 LEFT JOIN continent_dim k ON r.continent_code = k.code
), emission AS (SELECT * FROM dated WHERE {dated}), rec AS (SELECT * FROM placed WHERE {named})
"""
        # Report 2 as written adds up all records of a country.
        + _ORACLES[name].removeprefix(_STAR).replace("JOIN rec e", "JOIN placed e")
    )


_ORACLES |= {f"wh_{name}": _warehouse(name) for name in _NEEDED}


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
