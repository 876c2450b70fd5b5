"""Expected results as DuckDB SQL over the same tables, one statement per query key."""

from __future__ import annotations

from tributary.registry.adapters import COMMITTEES, CONTRIBUTIONS, FEED, SHIPMENTS, for_sql

# Named relations and the relations each one reads.
RELATIONS: dict[str, tuple[list[str], str]] = {
    "raw": ([], for_sql(CONTRIBUTIONS)),
    "com_raw": ([], for_sql(COMMITTEES)),
    "feed_raw": ([], for_sql(FEED)),
    "ship": ([], for_sql(SHIPMENTS)),
    "stg": (["raw"], """
        SELECT sub_id, committee_id, contributor_name, contributor_city, contributor_state,
               contributor_zip, contributor_employer, contributor_occupation,
               CAST(contribution_receipt_amount AS DECIMAL(18,2)) AS amount,
               contribution_receipt_date, receipt_type, entity_type, is_individual,
               two_year_transaction_period, _loaded_at AS loaded_at
        FROM raw
        WHERE sub_id IS NOT NULL AND contribution_receipt_date <= current_date
          AND contribution_receipt_amount IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY sub_id ORDER BY _loaded_at DESC) = 1"""),
    "com": (["com_raw"], """
        SELECT committee_id, name AS committee_name, coalesce(party, '') AS party,
               coalesce(party_full, '') AS party_full, coalesce(state, '') AS state,
               coalesce(designation, '') AS designation,
               coalesce(designation_full, '') AS designation_full,
               coalesce(committee_type, '') AS committee_type,
               coalesce(committee_type_full, '') AS committee_type_full,
               treasurer_name, first_file_date, _loaded_at AS loaded_at
        FROM com_raw WHERE committee_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY committee_id ORDER BY _loaded_at DESC) = 1"""),
    "summary": (["stg", "com"], """
        SELECT g.committee_id, coalesce(committee_name, 'Unknown Committee') AS committee_name,
               party, party_full, committee_type_full, designation_full,
               state AS committee_state, total_contributions, total_raised, avg_contribution,
               min_contribution, max_contribution, donor_states, unique_donors,
               first_contribution_date, last_contribution_date
        FROM (SELECT committee_id, count(*) AS total_contributions, sum(amount) AS total_raised,
                     CAST(sum(amount) AS DOUBLE) / count(*) AS avg_contribution,
                     min(amount) AS min_contribution, max(amount) AS max_contribution,
                     count(DISTINCT contributor_state) AS donor_states,
                     count(DISTINCT contributor_name) AS unique_donors,
                     min(contribution_receipt_date) AS first_contribution_date,
                     max(contribution_receipt_date) AS last_contribution_date
              FROM stg GROUP BY committee_id) g
        LEFT JOIN com ON com.committee_id = g.committee_id"""),
    "labelled": (["summary"], """
        SELECT *, CASE WHEN trim(coalesce(party_full, '')) <> '' THEN trim(party_full)
                  ELSE CASE upper(trim(coalesce(party, '')))
                    WHEN 'DFL' THEN 'Democratic-Farmer-Labor' WHEN 'IND' THEN 'Independent'
                    WHEN 'LIB' THEN 'Libertarian Party' WHEN 'NAT' THEN 'Non-affiliated'
                    WHEN 'NNE' THEN 'None' WHEN 'OTH' THEN 'Other' WHEN 'UNK' THEN 'Unknown'
                    WHEN 'WOR' THEN 'Working Families' WHEN '' THEN 'Unknown / other'
                    ELSE upper(trim(party)) END END AS party_label
        FROM summary"""),
    "classed": (["labelled"], """
        SELECT *, CASE WHEN lower(party_label) LIKE '%democrat%' THEN 'd'
                       WHEN lower(party_label) LIKE '%republican%' THEN 'r'
                       WHEN lower(party_label) LIKE '%independent%'
                         OR lower(party_label) LIKE '%green%'
                         OR lower(party_label) LIKE '%libertarian%' THEN 'i'
                       ELSE 'o' END AS party_class
        FROM labelled"""),
    "feed": (["feed_raw"], """
        SELECT sub_id, committee_id, contributor_state,
               CAST(contribution_receipt_amount AS DECIMAL(18,2)) AS amount,
               contribution_receipt_date, _loaded_at AS loaded_at
        FROM feed_raw
        QUALIFY row_number() OVER (PARTITION BY sub_id ORDER BY _loaded_at DESC) = 1"""),
    "feed_first": (["feed_raw"], """
        SELECT sub_id, committee_id, contributor_state,
               CAST(contribution_receipt_amount AS DECIMAL(18,2)) AS amount,
               contribution_receipt_date, _loaded_at AS loaded_at
        FROM feed_raw WHERE _loaded_at < TIMESTAMP '2024-01-20 00:00:00'
        QUALIFY row_number() OVER (PARTITION BY sub_id ORDER BY _loaded_at DESC) = 1"""),
    "mart": (["feed_first", "com"], "{daily:feed_first}"),
    "fresh": (["feed", "mart"], """
        SELECT * FROM feed WHERE loaded_at > (SELECT max(last_loaded_at) FROM mart)"""),
    "keys": (["fresh"], """
        SELECT DISTINCT contribution_receipt_date, committee_id FROM fresh"""),
    "hit": (["feed", "keys"], """
        SELECT feed.* FROM feed SEMI JOIN keys
          ON feed.contribution_receipt_date = keys.contribution_receipt_date
         AND feed.committee_id = keys.committee_id"""),
    "redone": (["hit", "com"], "{daily:hit}"),
    "merged": (["mart", "keys", "redone"], """
        SELECT mart.* FROM mart ANTI JOIN keys
          ON mart.contribution_receipt_date = keys.contribution_receipt_date
         AND mart.committee_id = keys.committee_id
        UNION ALL SELECT * FROM redone"""),
    "daily": (["stg", "com"], "{daily:stg}"),
    "places": (["summary"], """
        SELECT committee_id, coalesce(nullif(committee_name, ''), committee_id) AS who,
               greatest(total_raised, 0) AS amount,
               row_number() OVER (ORDER BY total_raised DESC, committee_id) AS place
        FROM summary"""),
    "supplied": (["ship"], """
        SELECT g.l_suppkey, n_lines, total_price, avg_price, min_price, max_price, n_orders,
               n_parts, first_ship, last_ship, s_name, n_name
        FROM (SELECT l_suppkey, count(*) AS n_lines, sum(price) AS total_price,
                     CAST(sum(price) AS DOUBLE) / count(*) AS avg_price,
                     min(price) AS min_price, max(price) AS max_price,
                     count(DISTINCT l_orderkey) AS n_orders,
                     count(DISTINCT l_partkey) AS n_parts,
                     min(ship_date) AS first_ship, max(ship_date) AS last_ship
              FROM ship GROUP BY l_suppkey) g
        LEFT JOIN supplier ON s_suppkey = g.l_suppkey
        LEFT JOIN nation ON n_nationkey = s_nationkey"""),
}

DAILY = """
        SELECT g.contribution_receipt_date, g.committee_id,
               coalesce(committee_name, 'Unknown Committee') AS committee_name, party, party_full,
               contribution_count, total_amount, avg_amount, unique_states, last_loaded_at
        FROM (SELECT contribution_receipt_date, committee_id, count(*) AS contribution_count,
                     sum(amount) AS total_amount,
                     CAST(sum(amount) AS DOUBLE) / count(*) AS avg_amount,
                     count(DISTINCT contributor_state) AS unique_states,
                     max(loaded_at) AS last_loaded_at
              FROM {rows} GROUP BY 1, 2) g
        LEFT JOIN com ON com.committee_id = g.committee_id"""


def _closure(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _closure(RELATIONS[name][0], seen)
            seen.append(name)
    return seen


def _sql(final: str, *needs: str) -> str:
    parts = []
    for name in _closure(list(needs), []):
        text = RELATIONS[name][1]
        if text.startswith("{daily:"):
            text = DAILY.replace("{rows}", text[len("{daily:"):-1])
        parts.append(f"{name} AS ({text.strip()})")
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final.strip()


def _whole_usd(value: str) -> str:
    return f"format('{{:,}}', CAST(round(abs({value}), 0) AS BIGINT))"


# Documents as records: the accepted rows, stated directly.
_DOC_STATE = """CASE WHEN doc_id % 97 = 5 THEN 'malformed json'
       WHEN doc_id % 37 IN (0, 1) OR doc_id % 31 IN (0, 1) OR doc_id % 50 IN (10, 11, 12)
         THEN 'missing required field'
       WHEN doc_id % 31 = 4 THEN 'bad amount'
       WHEN doc_id % 37 = 2 THEN 'bad date' ELSE 'loaded' END"""


def _band(position: int, band: str, label: str, detail: str, low: int, high: int) -> str:
    return f"""SELECT {position} AS position, '{band}' AS band, {label} AS label,
           {detail} AS detail, coalesce(sum(amount), 0) AS amount
    FROM places WHERE place BETWEEN {low} AND {high}"""


_BANDS = " UNION ALL ".join([
    _band(1, "top1", "'#1'", "max(who)", 1, 1),
    _band(2, "top5", "'#2–5'", "'Next four by raised'", 2, 5),
    _band(3, "top12", "'#6–12'", "'Rest of top 12'", 6, 12),
    _band(4, "rest", "'Rest (' || count(*) || ')'", "'All other committees'", 13, 1_000_000_000),
])
_SHARED = """SELECT position, band, label, detail, CAST(amount AS DECIMAL(38,2)) AS amount,
       CAST(amount AS DOUBLE) / CAST((SELECT sum(amount) FROM places) AS DOUBLE) AS share
FROM (""" + _BANDS + """) b WHERE amount > 0 OR band = 'rest'"""


def _step(position: int, label: str, high: int) -> str:
    share = "1.0::DOUBLE" if position == 4 else (
        "CAST(sum(amount) AS DOUBLE) / CAST((SELECT sum(amount) FROM places) AS DOUBLE)")
    return f"""SELECT {position} AS position, {label} AS label, sum(amount) AS amount,
           {share} AS share FROM places WHERE place <= {high}"""


_WINDOWED = """SELECT sub_id, committee_id, contribution_receipt_amount, contribution_receipt_date
        FROM raw
        WHERE two_year_transaction_period = 1998 AND is_individual
          AND contributor_state = '1-URGENT' AND contribution_receipt_amount >= 1000
          AND contribution_receipt_date BETWEEN DATE '1997-02-01' AND DATE '1998-11-30'
          AND sub_id IS NOT NULL"""

_WINDOW_KEYS = "contribution_receipt_date, committee_id"

ORACLES: dict[str, str] = {
    "normalize_contributions": f"""
        SELECT CASE WHEN doc_id % 50 = 13 THEN '0' ELSE CAST(doc_id AS VARCHAR) END AS sub_id,
               source AS committee_id, '' AS contributor_name, '' AS contributor_city,
               CASE WHEN doc_id % 13 = 2 THEN '0' WHEN doc_id % 13 IN (0, 1, 3) THEN ''
                    ELSE lang END AS contributor_state,
               '' AS contributor_zip, '' AS contributor_employer, '' AS contributor_occupation,
               CASE doc_id % 31 WHEN 2 THEN 12.5 WHEN 3 THEN 0 ELSE n_chars + 0.25 END::DOUBLE
                 AS contribution_receipt_amount,
               CAST(DATE '2024-01-01' + CAST(doc_id % 300 AS INTEGER) AS DATE)
                 AS contribution_receipt_date,
               '' AS receipt_type, coalesce(text, '') AS memo_text,
               doc_id % 7 IN (0, 3, 6) AS is_individual,
               CASE WHEN doc_id % 11 IN (0, 1) THEN 0 ELSE 2024 END::BIGINT
                 AS two_year_transaction_period,
               '' AS entity_type, TIMESTAMP '2001-08-05 12:45:00' AS _loaded_at
        FROM documents WHERE {_DOC_STATE} = 'loaded'""",
    "normalize_outcomes": f"""
        SELECT {_DOC_STATE} AS outcome, count(*) AS n_rows FROM documents GROUP BY 1""",
    "normalize_committees": """
        SELECT CAST(s_suppkey AS VARCHAR) AS committee_id, s_name AS name,
               CASE s_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'DFL' WHEN 2 THEN ''
                    ELSE 'XYZ' END AS party,
               '' AS party_full, CAST(s_nationkey AS VARCHAR) AS state, '' AS designation,
               '' AS designation_full, '' AS committee_type, '' AS committee_type_full,
               '' AS treasurer_name,
               CASE WHEN s_suppkey % 4 = 3 THEN DATE '1999-12-31' END AS first_file_date,
               TIMESTAMP '2001-08-05 12:45:00' AS _loaded_at
        FROM supplier WHERE s_suppkey % 9 > 2""",
    "scan_ndjson": _sql("""
        SELECT sub_id, committee_id, contributor_state, contribution_receipt_amount,
               contribution_receipt_date, is_individual, two_year_transaction_period, _loaded_at
        FROM raw""", "raw"),
    "stg_contributions": _sql("SELECT * FROM stg", "stg"),
    "stg_committees": _sql("SELECT * FROM com", "com"),
    "dedupe_latest": _sql("""
        SELECT * FROM ship QUALIFY row_number() OVER (PARTITION BY l_orderkey
          ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
                   price DESC, l_returnflag DESC) = 1""", "ship"),
    "valid_and_skipped": _sql("""
        SELECT count(*) FILTER (WHERE ok) AS n_valid, count(*) FILTER (WHERE NOT ok) AS n_skipped
        FROM (SELECT coalesce(sub_id, '') <> '' AND contribution_receipt_date IS NOT NULL
                     AND contribution_receipt_amount IS NOT NULL AS ok FROM raw) r""", "raw"),
    "windowed_fetch": _sql(f"""
        {_WINDOWED} ORDER BY contribution_receipt_date DESC, md5(sub_id),
          contribution_receipt_amount LIMIT 250""", "raw"),
    "windowed_fetch_all": _sql(_WINDOWED, "raw"),
    "dim_fetch_by_ids": _sql("""
        SELECT committee_id, name, party, _loaded_at FROM com_raw
        WHERE committee_id IN (SELECT committee_id FROM raw)""", "raw", "com_raw"),
    "dim_fetch_by_cycle": """
        SELECT o_custkey AS c_custkey,
               count(DISTINCT year(o_orderdate) + year(o_orderdate) % 2) AS n_cycles
        FROM orders GROUP BY o_custkey
        HAVING bool_or(year(o_orderdate) IN (1999, 2000))""",
    "needed_dim_keys": _sql("""
        SELECT DISTINCT committee_id FROM raw WHERE committee_id <> ''""", "raw"),
    "existing_dim_state": _sql("""
        SELECT committee_id, max(_loaded_at) AS loaded_at FROM com_raw
        WHERE committee_id <> '' GROUP BY 1""", "com_raw"),
    "dim_delta_keys": _sql("""
        SELECT committee_id FROM raw WHERE committee_id <> ''
        EXCEPT SELECT committee_id FROM com_raw""", "raw", "com_raw"),
    "dim_refresh_plan": _sql("""
        SELECT DISTINCT committee_id, 'delta' AS mode FROM raw WHERE committee_id <> ''
          AND committee_id NOT IN (SELECT committee_id FROM com_raw)""", "raw", "com_raw"),
    "dim_refresh_plan_stale": _sql("""
        SELECT DISTINCT committee_id, 'full: stale' AS mode FROM raw
        WHERE committee_id <> ''""", "raw"),
    "committee_summary": _sql("SELECT * FROM summary", "summary"),
    "daily_contributions": _sql("SELECT * FROM daily", "daily"),
    "supplier_summary": _sql("SELECT * FROM supplied", "supplied"),
    "daily_shipments": _sql("""
        SELECT ship_date, l_suppkey, count(*) AS n_lines, sum(price) AS total_price,
               CAST(sum(price) AS DOUBLE) / count(*) AS avg_price,
               count(DISTINCT l_returnflag) AS n_flags
        FROM ship GROUP BY 1, 2""", "ship"),
    "high_water_mark": _sql("""
        SELECT max(contribution_receipt_date) AS max_date FROM raw
        WHERE contribution_receipt_date <= DATE '2001-06-30'""", "raw"),
    "watermark_window": _sql("""
        SELECT max(contribution_receipt_date) AS max_date,
               CAST(max(contribution_receipt_date) - 7 AS DATE) AS min_date, 'watermark' AS mode
        FROM raw WHERE contribution_receipt_date <= DATE '2001-06-30'""", "raw"),
    "incremental_new_rows": _sql("""
        SELECT sub_id, committee_id, amount, contribution_receipt_date, loaded_at
        FROM fresh""", "fresh"),
    "affected_keys": _sql(f"SELECT {_WINDOW_KEYS} FROM keys", "keys"),
    "affected_key_recompute": _sql("SELECT * FROM redone", "redone"),
    "merge_upsert": _sql("SELECT * FROM merged", "merged"),
    "incremental_run": _sql("SELECT * FROM merged", "merged"),
    "dq_unique": _sql("""
        SELECT sub_id, count(*) AS n_rows FROM raw WHERE sub_id IS NOT NULL
        GROUP BY 1 HAVING count(*) > 1""", "raw"),
    "dq_not_null": _sql("""
        SELECT column_name, null_rows FROM (
          SELECT 'sub_id' AS column_name, count(*) - count(sub_id) AS null_rows FROM raw
          UNION ALL SELECT 'committee_id', count(*) - count(committee_id) FROM raw
          UNION ALL SELECT 'contribution_receipt_amount',
                           count(*) - count(contribution_receipt_amount) FROM raw
          UNION ALL SELECT 'contribution_receipt_date',
                           count(*) - count(contribution_receipt_date) FROM raw) c
        WHERE null_rows > 0""", "raw"),
    "dq_no_future": _sql("""
        SELECT sub_id, contribution_receipt_date FROM stg
        WHERE contribution_receipt_date > DATE '2001-06-30'""", "stg"),
    "dq_min_volume": _sql("""
        SELECT count(*) AS n_rows FROM stg HAVING count(*) < 1000000000""", "stg"),
    "dq_positive_count": _sql("""
        SELECT committee_id, total_raised FROM summary WHERE total_raised <= 0""", "summary"),
    "orphan_ratio": _sql("""
        SELECT count(*) AS n_facts, count(*) FILTER (WHERE com.committee_id IS NULL) AS n_orphans,
               CAST(count(*) FILTER (WHERE com.committee_id IS NULL) AS DOUBLE) / count(*)
                 AS orphan_ratio
        FROM stg LEFT JOIN com ON com.committee_id = stg.committee_id""", "stg", "com"),
    "orphan_ratio_breach": _sql("""
        SELECT * FROM (
          SELECT count(*) AS n_facts,
                 count(*) FILTER (WHERE com.committee_id IS NULL) AS n_orphans,
                 CAST(count(*) FILTER (WHERE com.committee_id IS NULL) AS DOUBLE) / count(*)
                   AS orphan_ratio
          FROM stg LEFT JOIN com ON com.committee_id = stg.committee_id) r
        WHERE orphan_ratio > 0.01""", "stg", "com"),
    "orphan_keys": _sql("""
        SELECT committee_id, count(*) AS n_orphans FROM stg
        WHERE committee_id NOT IN (SELECT committee_id FROM com)
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""", "stg", "com"),
    "freshness": _sql("""
        SELECT max(_loaded_at) AS last_loaded_at,
               date_sub('hour', max(_loaded_at), TIMESTAMP '2001-08-05 12:45:00')
                 AS hours_since_load,
               date_sub('hour', max(_loaded_at), TIMESTAMP '2001-08-05 12:45:00') > 24
                 AS is_stale
        FROM raw""", "raw"),
    "dq_suite": _sql("""
        SELECT 'not_null:stg_contributions.' || c AS assertion, n AS failing_rows FROM (
          SELECT 'sub_id' AS c, count(*) - count(sub_id) AS n FROM stg
          UNION ALL SELECT 'amount', count(*) - count(amount) FROM stg
          UNION ALL SELECT 'committee_id', count(*) - count(committee_id) FROM stg
          UNION ALL SELECT 'contribution_receipt_date',
                           count(*) - count(contribution_receipt_date) FROM stg) a
        UNION ALL SELECT 'no_future:stg_contributions.contribution_receipt_date',
               count(*) FROM stg WHERE contribution_receipt_date > current_date
        UNION ALL SELECT 'min_volume:stg_contributions',
               CASE WHEN count(*) < 100 THEN 1 ELSE 0 END FROM stg
        UNION ALL SELECT 'not_null:stg_committees.committee_id',
               count(*) - count(committee_id) FROM com
        UNION ALL SELECT 'not_null:stg_committees.committee_name',
               count(*) - count(committee_name) FROM com
        UNION ALL SELECT 'not_null:daily_contributions.' || c, n FROM (
          SELECT 'contribution_receipt_date' AS c,
                 count(*) - count(contribution_receipt_date) AS n FROM daily
          UNION ALL SELECT 'committee_id', count(*) - count(committee_id) FROM daily
          UNION ALL SELECT 'contribution_count', count(*) - count(contribution_count) FROM daily
          UNION ALL SELECT 'total_amount', count(*) - count(total_amount) FROM daily
          UNION ALL SELECT 'committee_name', count(*) - count(committee_name) FROM daily) d
        UNION ALL SELECT 'positive:daily_contributions.contribution_count',
               count(*) FROM daily WHERE contribution_count <= 0
        UNION ALL SELECT 'not_null:committee_summary.' || c, n FROM (
          SELECT 'committee_id' AS c, count(*) - count(committee_id) AS n FROM summary
          UNION ALL SELECT 'total_contributions', count(*) - count(total_contributions)
                    FROM summary
          UNION ALL SELECT 'total_raised', count(*) - count(total_raised) FROM summary) s
        UNION ALL SELECT 'unique:stg_contributions.sub_id', count(*) FROM
          (SELECT sub_id FROM stg GROUP BY 1 HAVING count(*) > 1) u1
        UNION ALL SELECT 'unique:stg_committees.committee_id', count(*) FROM
          (SELECT committee_id FROM com GROUP BY 1 HAVING count(*) > 1) u2
        UNION ALL SELECT 'unique:committee_summary.committee_id', count(*) FROM
          (SELECT committee_id FROM summary GROUP BY 1 HAVING count(*) > 1) u3
        UNION ALL SELECT 'orphan_ratio:stg_contributions',
               CASE WHEN avg(CASE WHEN com.committee_id IS NULL THEN 1.0 ELSE 0.0 END) > 0.05
                    THEN 1 ELSE 0 END
          FROM stg LEFT JOIN com ON com.committee_id = stg.committee_id""",
        "stg", "com", "daily", "summary"),
    "duplicate_key_count": _sql("""
        SELECT 'raw' AS layer, count(*) AS duplicate_keys FROM
          (SELECT sub_id FROM raw GROUP BY 1 HAVING count(*) > 1) r
        UNION ALL SELECT 'staging', count(*) FROM
          (SELECT sub_id FROM stg GROUP BY 1 HAVING count(*) > 1) s""", "raw", "stg"),
    "layer_counts": _sql("""
        SELECT 'raw' AS layer, count(*) AS row_count FROM raw
        UNION ALL SELECT 'staging', count(*) FROM stg
        UNION ALL SELECT 'mart (daily)', count(*) FROM daily
        UNION ALL SELECT 'mart (committee)', count(*) FROM summary""",
        "raw", "stg", "daily", "summary"),
    "load_summary": _sql("""
        SELECT count(*) AS n_records, count(DISTINCT nullif(committee_id, '')) AS n_entities,
               count(DISTINCT nullif(contributor_state, '')) AS n_regions,
               min(contribution_receipt_date) AS first_date,
               max(contribution_receipt_date) AS last_date,
               count(DISTINCT contribution_receipt_date) AS n_dates,
               sum(CAST(contribution_receipt_amount AS DECIMAL(18,2))) AS total_amount,
               CAST(sum(CAST(contribution_receipt_amount AS DECIMAL(18,2))) AS DOUBLE)
                 / count(contribution_receipt_amount) AS avg_amount
        FROM raw""", "raw"),
    "date_concentration": _sql("""
        SELECT contribution_receipt_date AS peak_date, count(*) AS peak_count,
               count(*) / (SELECT count(*) FROM stg) AS peak_share, sum(amount) AS peak_amount,
               count(*) / (SELECT count(*) FROM stg) >= 0.5 AS is_concentrated
        FROM stg GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 1""", "stg"),
    "dim_party_counts": _sql("""
        SELECT coalesce(nullif(party, ''), 'Unknown') AS party, count(*) AS n_rows
        FROM com_raw GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""", "com_raw"),
    "month_total_pruned": _sql("""
        SELECT sum(CAST(contribution_receipt_amount AS DECIMAL(18,2))) AS total_amount FROM raw
        WHERE contribution_receipt_date BETWEEN DATE '1998-06-01' AND DATE '1998-06-30'""",
        "raw"),
    "whole_total": _sql("""
        SELECT sum(CAST(contribution_receipt_amount AS DECIMAL(18,2))) AS total_amount
        FROM raw""", "raw"),
    "party_filter": _sql("""
        SELECT committee_id, committee_name, party, party_full, total_raised FROM labelled
        WHERE party_label = 'Democratic-Farmer-Labor'""", "labelled"),
    "party_label": _sql("SELECT committee_id, party_label FROM labelled", "labelled"),
    "party_class": _sql("SELECT committee_id, party_class FROM classed", "classed"),
    "unique_parties": _sql("SELECT DISTINCT party_label FROM labelled", "labelled"),
    "party_rollup": _sql("""
        SELECT party_label, sum(total_raised) AS total_raised, count(*) AS committees
        FROM labelled GROUP BY 1""", "labelled"),
    "party_rollup_sql": _sql("""
        SELECT party_full, count(*) AS committees,
               CAST(sum(total_contributions) AS BIGINT) AS contributions,
               round(sum(total_raised), 2) AS total_raised
        FROM summary WHERE party_full <> '' GROUP BY 1""", "summary"),
    "daily_to_committee_rollup": _sql("""
        SELECT committee_id, CAST(sum(contribution_count) AS BIGINT) AS contributions,
               round(sum(total_amount), 2) AS total
        FROM daily GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10""", "daily"),
    "top_committees": _sql("""
        SELECT committee_id, who AS name,
               CASE WHEN length(who) > 42 THEN substring(who, 1, 41) || '…' ELSE who END AS label,
               total_raised, party_class
        FROM (SELECT *, coalesce(nullif(committee_name, ''), committee_id) AS who FROM classed) c
        ORDER BY total_raised DESC, committee_id LIMIT 12""", "classed"),
    "top10_report": _sql("""
        SELECT committee_name, party, total_contributions, round(total_raised, 2) AS total_raised
        FROM summary ORDER BY summary.total_raised DESC, committee_id LIMIT 10""", "summary"),
    "kpi_strip": _sql("""
        SELECT sum(total_raised) AS total_raised,
               CAST(sum(total_contributions) AS BIGINT) AS total_contributions,
               count(*) AS committees,
               (SELECT strftime(min(contribution_receipt_date), '%b %-d, %Y') || ' – '
                    || strftime(max(contribution_receipt_date), '%b %-d, %Y') FROM daily)
                 AS date_range
        FROM labelled WHERE party_label = 'GREEN PARTY'""", "labelled", "daily"),
    "concentration_bands": _sql(_SHARED, "places"),
    "concentration_ladder": _sql(" UNION ALL ".join([
        _step(1, "'#1 committee'", 1), _step(2, "'Top 5'", 5), _step(3, "'Top 12'", 12),
        _step(4, "'All ' || count(*)", 1_000_000_000)]), "places"),
    "concentration_summary": _sql("""
        SELECT sum(amount) AS total, count(*) AS committees,
               CAST(sum(amount) FILTER (WHERE place <= 12) AS DOUBLE)
                 / CAST(sum(amount) AS DOUBLE) AS top12_share
        FROM (SELECT greatest(total_raised, 0) AS amount,
                     row_number() OVER (ORDER BY total_raised DESC, committee_id) AS place
              FROM labelled WHERE party_label = 'GREEN PARTY') p""", "labelled"),
    "supplier_concentration": _sql(
        _SHARED.replace("places", """(SELECT coalesce(nullif(s_name, ''),
            CAST(l_suppkey AS VARCHAR)) AS who, greatest(total_price, 0) AS amount,
            row_number() OVER (ORDER BY total_price DESC, CAST(l_suppkey AS VARCHAR)) AS place
          FROM supplied) places"""), "supplied"),
    "format_report": _sql(f"""
        SELECT committee_id,
               CASE WHEN t < 0 THEN '-$' ELSE '$' END || {_whole_usd('t')} AS raised,
               CASE WHEN t < 0 THEN '-$' ELSE '$' END || format('{{:,}}', cents // 100) || '.'
                 || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS raised_cents,
               format('{{:,}}', total_contributions) AS contributions,
               CASE WHEN t < 0 THEN '-' ELSE '' END ||
               CASE WHEN cents >= 100000000
                      THEN (tenths // 10) || '.' || (tenths % 10) || 'M'
                    WHEN cents >= 100000 THEN ((cents + 50000) // 100000) || 'k'
                    ELSE CAST((cents + 50) // 100 AS VARCHAR) END AS raised_compact,
               strftime(first_contribution_date, '%b %-d, %Y') AS first_day,
               strftime(last_contribution_date, '%b %-d, %Y') AS last_day,
               printf('%.1f%%', CAST(t AS DOUBLE)
                 / CAST((SELECT sum(total_raised) FROM summary) AS DOUBLE) * 100) AS share
        FROM (SELECT *, total_raised AS t, CAST(abs(total_raised) * 100 AS BIGINT) AS cents,
                     (CAST(abs(total_raised) * 100 AS BIGINT) + 5000000) // 10000000 AS tenths
              FROM summary) s""", "summary"),
    "election_cycle": """
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS day,
               year(o_orderdate) + year(o_orderdate) % 2 AS cycle
        FROM orders""",
    "bootstrap_min_date": """
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS day,
               greatest(make_date(year(o_orderdate) + year(o_orderdate) % 2 - 1, 1, 1),
                        CAST(CAST(o_orderdate AS DATE) - 365 AS DATE)) AS min_date
        FROM orders""",
    "export_daily": _sql("""
        SELECT CAST(d.contribution_receipt_date AS VARCHAR) AS contribution_receipt_date,
               d.committee_id, coalesce(s.committee_name, 'Unknown Committee') AS committee_name,
               s.party, s.party_full, d.contribution_count,
               CAST(d.total_amount AS DOUBLE) AS total_amount, d.avg_amount, d.unique_states
        FROM daily d LEFT JOIN summary s ON s.committee_id = d.committee_id""",
        "daily", "summary"),
    "export_summary": _sql("""
        SELECT * REPLACE (CAST(total_raised AS DOUBLE) AS total_raised,
                          CAST(min_contribution AS DOUBLE) AS min_contribution,
                          CAST(max_contribution AS DOUBLE) AS max_contribution,
                          CAST(first_contribution_date AS VARCHAR) AS first_contribution_date,
                          CAST(last_contribution_date AS VARCHAR) AS last_contribution_date)
        FROM summary""", "summary"),
    "export_meta": _sql("""
        SELECT '2001-08-05T12:45:00.000000+00:00' AS exported_at, 'local' AS project,
               'mart' AS dataset, (SELECT count(*) FROM daily) AS daily_contributions_rows,
               count(*) AS committee_summary_rows,
               (SELECT CAST(min(contribution_receipt_date) AS VARCHAR) FROM daily) AS date_min,
               (SELECT CAST(max(contribution_receipt_date) AS VARCHAR) FROM daily) AS date_max,
               CAST(sum(total_raised) AS DOUBLE) AS total_raised,
               CAST(sum(total_contributions) AS BIGINT) AS total_contributions
        FROM summary""", "daily", "summary"),
}

# What a run publishes equals what is exported.
ORACLES["pipeline_run"] = ORACLES["export_daily"]
ORACLES["published_summary"] = ORACLES["export_summary"]
ORACLES["dimension_reload"] = _sql("""
    SELECT committee_id, name, party, party_full, state, _loaded_at FROM com_raw""", "com_raw")
ORACLES["counted_summary"] = ORACLES["committee_summary"]
ORACLES["dq_incremental"] = ORACLES["dq_suite"]
ORACLES["footer_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS layer, count(*) AS n_rows, min({key}) AS least, max({key}) AS greatest FROM {t}"
    for t, key in (("customer", "c_custkey"), ("events", "event_id"), ("lineitem", "l_orderkey"), ("orders", "o_orderkey")))
ORACLES["latest_in_sessions"] = """
    WITH marked AS (
      SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 1 HOUR THEN 0 ELSE 1 END AS opens
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM marked),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, session ORDER BY ts DESC, event_id DESC) AS place,
                      count(*) OVER (PARTITION BY user_id, session) AS n_versions FROM numbered)
    SELECT event_id, ts, user_id, value, n_versions FROM ranked WHERE place = 1"""
ORACLES["loaded_once"] = _sql("""
    SELECT CAST(year(contribution_receipt_date) AS INTEGER) AS year, count(*) AS n_rows, count(DISTINCT sub_id) AS n_records
    FROM raw GROUP BY 1""", "raw")
ORACLES["committee_ranking"] = _sql("""
    SELECT committee_id, total_raised, place, running, CAST(running AS DOUBLE) / CAST(whole AS DOUBLE) AS running_share
    FROM (SELECT committee_id, total_raised, row_number() OVER w AS place,
                 sum(greatest(total_raised, 0)) OVER w AS running, sum(greatest(total_raised, 0)) OVER () AS whole
          FROM summary WINDOW w AS (ORDER BY total_raised DESC, committee_id NULLS FIRST
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) r""", "summary")
ORACLES["newest_shipments"] = _sql("""
    SELECT l_orderkey, l_linenumber, ship_date, price FROM ship
    ORDER BY ship_date DESC, md5(CAST(l_orderkey AS VARCHAR)), l_linenumber, price LIMIT 20000""", "ship")
