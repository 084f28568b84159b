"""ANSI SQL counterparts of the registered queries, for comparison by another engine."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import product

from batchlens.catalog.queries import CLEANING, RENDERED, WIDE_KINDS
from batchlens.catalog.subjects import (
    ALL_ORDER_KINDS,
    ALL_SHIPMENT_KINDS,
    DOCUMENT_KINDS,
    EVENT_KINDS,
    ORDER_KINDS,
    SHIPMENT_KINDS,
)
from batchlens.kinds import CATEGORICAL, NUMERIC, of_kind
from batchlens.operators.rules import CONFIDENCES, MIN_RULES, SUPPORTS
from batchlens.plans.report import (
    BATCH_HEAD,
    CATEGORICAL_TITLE,
    DQ_TITLE,
    EDA_TITLE,
    FEATURE_HEAD,
    HISTOGRAMS,
    NUMERIC_TITLE,
    OVERVIEW_HEAD,
    STAT_NAMES,
    VALUE_HEAD,
)

SHIPMENTS = """SELECT strftime(l_shipdate, '%Y-%m') AS batch_id, l_shipdate, l_orderkey, l_partkey, l_suppkey,
  l_quantity, l_extendedprice, l_discount, nullif(l_tax, 0) AS tax, nullif(l_returnflag, 'N') AS flag,
  l_linestatus, l_linenumber FROM lineitem WHERE l_shipdate IS NOT NULL"""
ORDERS = """SELECT strftime(o_orderdate, '%Y-%m') AS batch_id, o_orderkey, o_custkey, o_orderdate, o_totalprice,
  o_orderstatus, o_orderpriority FROM orders WHERE o_orderdate IS NOT NULL"""
EVENTS = "SELECT strftime(ts, '%Y-%m') AS batch_id, event_id, ts, user_id, event_type, value, props FROM events WHERE ts IS NOT NULL"
DOCUMENTS = """SELECT 'all' AS batch_id, doc_id, text, lang, source, n_chars, quality, toxic
  FROM documents LEFT JOIN labels USING (doc_id)"""

NUM_STATS = "min({x})::DOUBLE AS min, max({x})::DOUBLE AS max, avg({x}) AS mean, stddev_samp({x}) AS std"
NO_STATS = "NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean, NULL::DOUBLE AS std"


def _dq(view: str, kinds: Mapping[str, str]) -> str:
    """CTEs v, dq (one row per batch and feature) and ranked (values by falling count)."""
    records, values = [], []
    for name, kind in kinds.items():
        stats = NUM_STATS.format(x=name) if kind == NUMERIC else NO_STATS
        records.append(
            f"SELECT batch_id, '{name}' AS feature, '{kind}' AS value_type, count(*) AS n_rows, "
            f"(count(*) - count({name})) / count(*) AS missing_rate, "
            f"count(DISTINCT {name}) AS unique_count, count({name}) AS n_valid, {stats} FROM v GROUP BY batch_id"
        )
        if kind == CATEGORICAL:
            values.append(
                f"SELECT batch_id, '{name}' AS feature, {name}::VARCHAR AS value, count(*) AS cnt "
                f"FROM v WHERE {name} IS NOT NULL GROUP BY ALL"
            )
    ranked = (
        "SELECT *, row_number() OVER (PARTITION BY batch_id, feature ORDER BY cnt DESC, value) AS rank "
        f"FROM ({' UNION ALL '.join(values)})"
    )
    return (
        f"WITH v AS ({view}), dq0 AS ({' UNION ALL '.join(records)}), "
        "dq AS (SELECT * REPLACE (CASE WHEN n_valid = 1 AND value_type = 'numeric' THEN 0.0 ELSE std END AS std) "
        f"FROM dq0), ranked AS ({ranked})"
    )


def _profile(view: str, kinds: Mapping[str, str]) -> str:
    return (
        _dq(view, kinds)
        + ", tops AS (SELECT batch_id, feature, string_agg(value || ':' || cnt, ';' ORDER BY cnt DESC, value) AS top "
        "FROM ranked WHERE rank <= 10 GROUP BY batch_id, feature) "
        "SELECT batch_id, feature, value_type, n_rows, missing_rate, unique_count, "
        "round(min, 6) AS min, round(max, 6) AS max, round(mean, 6) AS mean, round(std, 6) AS std, top "
        "FROM dq LEFT JOIN tops USING (batch_id, feature)"
    )


def _eda_overview(view: str, kinds: Mapping[str, str]) -> str:
    rows = [
        f"SELECT {i} AS ord, '{c}' AS feature, '{k}' AS value_type, "
        f"100.0::DOUBLE * ((count(*) - count({c})) / count(*)) AS missing_pct, "
        f"count(DISTINCT {c}) AS unique_count FROM v"
        for i, (c, k) in enumerate(kinds.items())
    ]
    return f"WITH v AS ({view}) " + " UNION ALL ".join(rows)


def _eda_describe(view: str, kinds: Mapping[str, str]) -> str:
    rows = []
    for i, c in enumerate(of_kind(kinds, NUMERIC)):
        quartiles = ", ".join(
            f"round_even(quantile_cont({c}::DOUBLE, {p}), 4) AS {n}" for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
        )
        rows.append(
            f"SELECT {i} AS ord, '{c}' AS feature, count({c}) AS count, round_even(avg({c}), 4) AS mean, "
            f"round_even(stddev_samp({c}), 4) AS std, round_even(min({c})::DOUBLE, 4) AS min, {quartiles}, "
            f"round_even(max({c})::DOUBLE, 4) AS max FROM v"
        )
    return f"WITH v AS ({view}) " + " UNION ALL ".join(rows)


def _eda_correlation(view: str, kinds: Mapping[str, str]) -> str:
    nums = of_kind(kinds, NUMERIC)
    rows = []
    for x, y in product(nums, nums):
        corr = "1.0::DOUBLE" if x == y else f"round(corr({x}, {y}), 6)"
        rows.append(f"SELECT '{x}' AS x, '{y}' AS y, {corr} AS corr" + ("" if x == y else " FROM v"))
    return f"WITH v AS ({view}) " + " UNION ALL ".join(rows)


def _eda_histogram(view: str, kinds: Mapping[str, str], bins: int = 30) -> str:
    parts = []
    for c in of_kind(kinds, NUMERIC):
        parts.append(f"SELECT '{c}' AS feature, {c}::DOUBLE AS x FROM v WHERE {c} IS NOT NULL")
    return f"""WITH v AS ({view}), cells AS ({' UNION ALL '.join(parts)}),
ends AS (SELECT feature, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS a,
  CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS b FROM cells GROUP BY feature),
edges AS (SELECT feature, k::INTEGER AS bin, a + k * ((b - a) / {bins}) AS lo,
  CASE WHEN k = {bins - 1} THEN b ELSE a + (k + 1) * ((b - a) / {bins}) END AS hi
  FROM ends, range({bins}) AS t(k)),
counted AS (SELECT e.feature, e.bin, count(*) AS cnt FROM cells c JOIN edges e ON c.feature = e.feature
  AND c.x >= e.lo AND (c.x < e.hi OR (e.bin = {bins - 1} AND c.x <= e.hi)) GROUP BY ALL)
SELECT feature, bin, round(lo, 6) AS lo, round(hi, 6) AS hi, coalesce(cnt, 0) AS cnt
FROM edges LEFT JOIN counted USING (feature, bin)"""


def _top(view: str, kinds: Mapping[str, str], keep_batch: bool) -> str:
    batch = "batch_id, " if keep_batch else ""
    return _dq(view, kinds) + f" SELECT {batch}feature, rank::INTEGER AS rank, value, cnt FROM ranked WHERE rank <= 10"


def _all_rows(view: str) -> str:
    return f"SELECT * REPLACE ('all' AS batch_id) FROM ({view})"


def _medians(kinds: Mapping[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT batch_id, '{c}' AS feature, median({c}::DOUBLE) AS median FROM v GROUP BY batch_id"
        for c in of_kind(kinds, NUMERIC)
    )


def _baskets(view: str, kinds: Mapping[str, str], extra: str = "") -> str:
    """CTEs v, med (medians) and rows_items (the items of every row, in text order)."""
    nums = of_kind(kinds, NUMERIC)
    picks = ", ".join(["batch_id", "count(*) AS n_rows"] + [f"median({c}::DOUBLE) AS med_{c}" for c in nums])
    items = [
        f"CASE WHEN {c} > med_{c} THEN '{c}=above_median' END" if k == NUMERIC else f"'{c}=' || {c}"
        for c, k in kinds.items()
    ]
    return (
        f"WITH v AS ({view}), med AS (SELECT {picks} FROM v GROUP BY batch_id), "
        f"rows_items AS (SELECT batch_id, {extra} list_filter([{', '.join(items)}], lambda x: x IS NOT NULL) AS items "
        "FROM v JOIN med USING (batch_id))"
    )


def _sets(view: str, kinds: Mapping[str, str], min_support: float) -> str:
    """CTE sets: (batch_id, items, cnt, n_rows, support), all subsets of the baskets counted."""
    return (
        _baskets(view, kinds)
        + f""", baskets AS MATERIALIZED (SELECT batch_id, list_sort(items) AS items, count(*) AS w FROM rows_items
  WHERE len(items) > 0 GROUP BY ALL),
subsets AS (SELECT batch_id, list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS items, w
  FROM baskets, range(1, {2 ** len(kinds)}) AS t(mask) WHERE mask < (1 << len(items))),
sets AS MATERIALIZED (SELECT s.batch_id, s.items, sum(w)::BIGINT AS cnt, n_rows, sum(w)::BIGINT / n_rows AS support
  FROM subsets s JOIN med USING (batch_id) GROUP BY s.batch_id, s.items, n_rows
  HAVING sum(w)::BIGINT / n_rows >= {min_support})"""
    )


def _rules(view: str, kinds: Mapping[str, str], min_support: float, min_confidence: float) -> str:
    """CTE rules over CTE sets."""
    return (
        _sets(view, kinds, min_support)
        + f""", splits AS (SELECT batch_id, support,
  list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS a,
  list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 0) AS c
  FROM sets, range(1, {2 ** len(kinds)}) AS t(mask) WHERE len(items) >= 2 AND mask < (1 << len(items)) - 1),
rules AS MATERIALIZED (SELECT s.batch_id, s.a, s.c, s.support, s.support / l.support AS confidence,
  s.support / l.support / r.support AS lift
  FROM splits s JOIN sets l ON s.batch_id = l.batch_id AND s.a = l.items
  JOIN sets r ON s.batch_id = r.batch_id AND s.c = r.items WHERE s.support / l.support >= {min_confidence})"""
    )


RULE_COLUMNS = """batch_id, array_to_string(a, ',') AS antecedents, array_to_string(c, ',') AS consequents,
  support, confidence, lift"""


def _ladder(view: str, kinds: Mapping[str, str], min_rules: int, columns: str = RULE_COLUMNS) -> str:
    steps, earlier = [], None
    for s in SUPPORTS:
        for c in CONFIDENCES:
            cond = f"(support >= {s} AND confidence >= {c})"
            steps.append(cond if earlier is None else f"({cond} OR support >= {earlier})")
        earlier = s
    last = len(steps) - 1
    totals = ", ".join(f"count(*) FILTER (WHERE {cond}) AS n{i}" for i, cond in enumerate(steps))
    stop = " ".join(f"WHEN n{i} >= {min_rules} THEN {i}" for i in range(last))
    keep = " ".join(f"WHEN {i} THEN {cond}" for i, cond in enumerate(steps))
    return (
        _rules(view, kinds, SUPPORTS[-1], CONFIDENCES[-1])
        + f", totals AS (SELECT batch_id, {totals} FROM rules GROUP BY batch_id), "
        f"stops AS (SELECT batch_id, CASE {stop} ELSE {last} END AS stop FROM totals) "
        f"SELECT {columns} FROM rules JOIN stops USING (batch_id) WHERE CASE stop {keep} END"
    )


def _clean(view: str, kinds: Mapping[str, str]) -> str:
    return _dq(view, kinds) + (
        ", verdicts AS (SELECT batch_id, feature, CASE "
        f"WHEN missing_rate > {CLEANING['max_missing_rate']} THEN 'drop_missing' "
        f"WHEN unique_count / n_rows < {CLEANING['min_unique_ratio']} THEN 'drop_low_unique' "
        f"WHEN unique_count / n_rows > {CLEANING['max_unique_ratio']} THEN 'drop_high_unique' "
        "ELSE 'keep' END AS verdict FROM dq)"
    )


def _clean_long(view: str, kinds: Mapping[str, str]) -> str:
    cells = " UNION ALL ".join(
        f"SELECT batch_id, '{c}' AS feature, "
        + (f"{c}::DOUBLE AS num, NULL::VARCHAR AS text" if k == NUMERIC else f"NULL::DOUBLE AS num, {c}::VARCHAR AS text")
        + " FROM v"
        for c, k in kinds.items()
    )
    return (
        _clean(view, kinds)
        + f", cells AS ({cells}) SELECT batch_id, feature, count(*) AS cells, round(avg(num), 6) AS mean, "
        "max(text) AS last_text FROM cells JOIN verdicts USING (batch_id, feature) "
        "WHERE verdict = 'keep' GROUP BY batch_id, feature"
    )


def _clean_batch_orders() -> str:
    """The orders without the columns whose missing rate or share of distinct values is too high.

    The verdicts are computed; a dropped column shows as text in place of its values, and none may show.
    """
    columns = ("o_custkey", "o_orderstatus", "o_orderpriority")
    bad = " UNION ALL ".join(
        f"SELECT count({c}) < 0.5 * count(*) OR count(DISTINCT {c}) > 0.9 * count(*) AS bad FROM c"
        for c in columns
    )
    dropped = " UNION ALL ".join(
        f"SELECT NOT (count({c}) < 0.5 * count(*) OR count(DISTINCT {c}) > 0.9 * count(*)) AS bad FROM c"
        for c in ("o_orderkey", "o_totalprice", "closed_priority")
    )
    return f"""WITH c AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS closed_priority FROM orders)
SELECT {', '.join(columns)} FROM orders WHERE NOT (SELECT bool_or(bad) FROM ({bad} UNION ALL {dropped}))"""


BY_BATCH = """SELECT batch_id, count(*) AS n_features, avg(missing_rate) AS avg_missing_rate,
  avg(unique_count) AS avg_unique_count FROM dq GROUP BY batch_id"""
BY_FEATURE = """SELECT feature, arg_min(value_type, batch_id) AS value_type, count(*) AS n_batches,
  avg(missing_rate) AS avg_missing_rate, min(missing_rate) AS min_missing_rate, max(missing_rate) AS max_missing_rate,
  avg(unique_count) AS avg_unique_count, min(unique_count) AS min_unique_count, max(unique_count) AS max_unique_count
  FROM dq GROUP BY feature"""
SUMMARY = """SELECT count(DISTINCT batch_id) AS batches, count(DISTINCT feature) AS features, count(*) AS records
  FROM dq"""


def _rounded(inner: str, columns: list[str]) -> str:
    parts = ", ".join(f"round({c}, 6) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({parts}) FROM ({inner})"


def _text_lines(section: int, lines: list[str]) -> str:
    rows = ", ".join(f"({section}, '{i:04d}', '{line}')" for i, line in enumerate(lines))
    return f"SELECT * FROM (VALUES {rows}) AS t(section, ord, line)"


def _report_lines(view: str, kinds: Mapping[str, str]) -> str:
    bullets = " UNION ALL ".join(
        f"SELECT 1, '{i:04d}', '- **{name}:** ' || {name.lower()} FROM ({SUMMARY})"
        for i, name in enumerate(("Batches", "Features", "Records"))
    )
    parts = [
        _text_lines(0, [DQ_TITLE, "", "## Summary", ""]),
        bullets,
        _text_lines(2, ["", "---", "", *BATCH_HEAD]),
        "SELECT 3, batch_id, printf('| %s | %d | %.4f | %.1f |', batch_id, n_features, avg_missing_rate, "
        f"avg_unique_count) FROM ({BY_BATCH})",
        _text_lines(4, ["", *FEATURE_HEAD]),
        "SELECT 5, feature, printf('| %s | %s | %d | %.4f | %.4f | %.4f | %.1f | %d | %d |', feature, value_type, "
        "n_batches, avg_missing_rate, min_missing_rate, max_missing_rate, avg_unique_count, min_unique_count, "
        f"max_unique_count) FROM ({BY_FEATURE})",
        _text_lines(6, [""]),
    ]
    return _dq(view, kinds) + " " + " UNION ALL ".join(parts)


def _eda_lines(view: str, kinds: Mapping[str, str]) -> str:
    """All lines of the exploratory part, in no order, of a table with one numeric column."""
    number = of_kind(kinds, NUMERIC)[0]
    cats = of_kind(kinds, CATEGORICAL)
    shown = "regexp_replace(printf('%.4f', {x}), '(\\.\\d+?)0+$', '\\1')"
    stats = " UNION ALL ".join(
        f"SELECT '| {STAT_NAMES.get(x, x)} | ' || {shown.format(x=f'{x}::DOUBLE')} || ' |' FROM describe_all"
        for x in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")
    )
    fixed = ["---", EDA_TITLE, "## Summary", *OVERVIEW_HEAD, NUMERIC_TITLE, f"| index | {number} |", "|---|---|"]
    fixed += [CATEGORICAL_TITLE, *[line for c in cats for line in (f"### {c}", *VALUE_HEAD)]]
    head = " UNION ALL ".join(f"SELECT '{line}' AS line" for line in fixed if line)
    return f"""WITH describe_all AS ({_eda_describe(view, {number: NUMERIC})}), overview_all AS ({_eda_overview(view, kinds)}),
  top_all AS ({_top(_all_rows(view), kinds, False)})
  {head} UNION ALL SELECT '- **Rows:** ' || format('{{:,}}', count(*)) FROM ({view})
  UNION ALL SELECT '- **Columns:** {len(kinds)}'
  UNION ALL SELECT printf('| %s | %s | %.2f%% | %d |', feature, value_type, missing_pct, unique_count) FROM overview_all
  UNION ALL {stats} UNION ALL SELECT '| ' || value || ' | ' || cnt || ' |' FROM top_all"""


CONSTRAINTS = _dq(SHIPMENTS, SHIPMENT_KINDS) + f""", o AS ({ORDERS})
SELECT * FROM (
SELECT 'dq batch in ledger' AS "check", count(*) AS n FROM dq WHERE batch_id NOT IN (SELECT batch_id FROM o)
UNION ALL SELECT 'line key unique', count(*) FROM
  (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'order status domain', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'tax not null', count(*) FROM v WHERE tax IS NULL OR flag IS NULL
UNION ALL SELECT 'line order exists', count(*) FROM lineitem
  WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)) WHERE n > 0"""

PENDING = f"""WITH v AS ({SHIPMENTS}), o AS ({ORDERS}) SELECT batch_id, count(*) AS n_rows FROM v
WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.batch_id = v.batch_id) GROUP BY batch_id"""

UPDATE_KINDS = {"l_shipdate": CATEGORICAL, **SHIPMENT_KINDS}
MINED_ORDERS = {c: k for c, k in ORDER_KINDS.items() if c != "o_totalprice"}

_DQ = _dq(SHIPMENTS, ALL_SHIPMENT_KINDS)
_RATES = ["avg_missing_rate", "avg_unique_count"]

ORACLES: dict[str, str] = {
    "batch_ledger": f"SELECT batch_id, count(*) AS n_rows FROM ({SHIPMENTS}) GROUP BY batch_id ORDER BY batch_id",
    "dq_profile": _profile(SHIPMENTS, ALL_SHIPMENT_KINDS),
    "dq_profile_orders": _profile(ORDERS, ALL_ORDER_KINDS),
    "dq_profile_events": _profile(EVENTS, EVENT_KINDS),
    "dq_missing_unique": _DQ + " SELECT batch_id, feature, missing_rate, unique_count FROM dq",
    "dq_numeric_stats": _DQ
    + " SELECT batch_id, feature, round(min, 6) AS min, round(max, 6) AS max, round(mean, 6) AS mean, "
    "round(std, 6) AS std FROM dq WHERE value_type = 'numeric'",
    "dq_top10": _top(SHIPMENTS, ALL_SHIPMENT_KINDS, True),
    "dq_stats_json": _dq(ORDERS, ALL_ORDER_KINDS)
    + """ SELECT batch_id, feature, '{' || string_agg('"' || value || '":' || cnt, ',' ORDER BY rank) || '}' AS stats_json
  FROM ranked WHERE rank <= 10 GROUP BY batch_id, feature""",
    "dq_by_batch": _DQ + " " + _rounded(BY_BATCH, _RATES),
    "dq_by_feature": _DQ + " " + _rounded(BY_FEATURE, _RATES),
    "dq_summary": _DQ + " " + SUMMARY,
    "report_lines": _report_lines(SHIPMENTS, ALL_SHIPMENT_KINDS),
    "clean_verdicts": _clean(SHIPMENTS, ALL_SHIPMENT_KINDS) + " SELECT * FROM verdicts",
    "clean_long": _clean_long(SHIPMENTS, ALL_SHIPMENT_KINDS),
    "clean_batch_orders": _clean_batch_orders(),
    "eda_summary": f"SELECT count(*) AS n_rows, {len(ALL_SHIPMENT_KINDS)} AS n_columns FROM ({SHIPMENTS})",
    "eda_overview": _eda_overview(SHIPMENTS, ALL_SHIPMENT_KINDS),
    "eda_overview_documents": _eda_overview(DOCUMENTS, DOCUMENT_KINDS),
    "eda_describe": _eda_describe(SHIPMENTS, ALL_SHIPMENT_KINDS),
    "eda_describe_ranged": _eda_describe(SHIPMENTS, ALL_SHIPMENT_KINDS),
    "eda_describe_documents": _eda_describe(DOCUMENTS, DOCUMENT_KINDS),
    "eda_correlation": _eda_correlation(SHIPMENTS, ALL_SHIPMENT_KINDS),
    "eda_histogram": _eda_histogram(SHIPMENTS, ALL_SHIPMENT_KINDS),
    "eda_top10": _top(_all_rows(SHIPMENTS), ALL_SHIPMENT_KINDS, False),
    "eda_top10_documents": _top(DOCUMENTS, DOCUMENT_KINDS, False),
    "batch_medians": f"WITH v AS ({SHIPMENTS}) SELECT * REPLACE (round(median, 6) AS median) FROM "
    f"({_medians(SHIPMENT_KINDS)})",
    "row_items": _baskets(SHIPMENTS, SHIPMENT_KINDS, "l_orderkey, l_partkey, l_suppkey, l_linenumber,")
    + " SELECT * REPLACE (array_to_string(items, ',') AS items) FROM rows_items",
    "frequent_itemsets": _sets(SHIPMENTS, SHIPMENT_KINDS, 0.05)
    + " SELECT batch_id, array_to_string(items, ',') AS items, cnt, support FROM sets",
    "rules_fixed": _rules(SHIPMENTS, SHIPMENT_KINDS, 0.05, 0.3) + f" SELECT {RULE_COLUMNS} FROM rules",
    "rules_ladder": _ladder(SHIPMENTS, SHIPMENT_KINDS, 500),
    "rules_orders": _ladder(ORDERS, MINED_ORDERS, MIN_RULES),
    "pending_dq": PENDING,
    "pending_rules": PENDING,
    "late_rows": f"""WITH v AS ({SHIPMENTS}), o AS ({ORDERS}) SELECT batch_id,
  CASE WHEN batch_id IN (SELECT batch_id FROM o) THEN 'late' ELSE 'new' END AS state, count(*) AS n_rows
  FROM v GROUP BY batch_id""",
    "constraint_checks": CONSTRAINTS,
    "json_roundtrip": f"SELECT batch_id, l_orderkey, {', '.join(SHIPMENT_KINDS)} FROM ({SHIPMENTS})",
    "csv_union": """SELECT o_orderkey::DOUBLE AS o_orderkey, o_custkey::DOUBLE AS custkey, o_totalprice,
  NULL::VARCHAR AS segment, NULL::DOUBLE AS c_acctbal FROM orders
  UNION ALL SELECT NULL, c_custkey::DOUBLE, NULL, nullif(c_mktsegment, 'BUILDING'), c_acctbal FROM customer""",
    "time_parse": """SELECT CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m') END AS batch_id,
  count(*) AS n_rows FROM orders GROUP BY ALL""",
    "seed_from_csv": f"SELECT batch_id, count(*) AS n_rows FROM ({ORDERS}) GROUP BY batch_id ORDER BY batch_id",
    "latest_batch": f"SELECT {', '.join(SHIPMENT_KINDS)} FROM ({SHIPMENTS}) "
    f"WHERE batch_id = (SELECT max(batch_id) FROM ({SHIPMENTS}))",
    "eda_histogram_wide": _eda_histogram(
        f"SELECT {', '.join(f'o_totalprice + {i} AS p{i}' for i in range(len(WIDE_KINDS)))} FROM orders", WIDE_KINDS, 5
    ),
    "dq_stats_json_numeric": _dq(ORDERS, ALL_ORDER_KINDS)
    + " SELECT batch_id, feature, round(min, 6) AS min, round(max, 6) AS max, round(mean, 6) AS mean, "
    "round(std, 6) AS std FROM dq WHERE value_type = 'numeric'",
    "time_parse_formats": f"""SELECT (o_orderkey % {len(RENDERED)})::INTEGER AS turn,
  strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL""",
    "stream_two_sources": f"""WITH o AS (SELECT batch_id, count(*) AS n_rows FROM ({ORDERS}) GROUP BY batch_id),
  v AS (SELECT batch_id, count(*) AS n_rows FROM ({SHIPMENTS}) GROUP BY batch_id)
  SELECT * FROM o UNION ALL SELECT * FROM v WHERE batch_id NOT IN (SELECT batch_id FROM o)""",
    "raw_mixed_types": """SELECT strftime(o_orderdate, '%Y-%m') AS batch_id, o_orderkey,
  CASE WHEN o_orderdate < '1998-01-01' THEN o_custkey::DOUBLE ELSE o_custkey + 0.5::DOUBLE END AS o_custkey,
  CASE WHEN o_orderdate >= '1998-01-01' THEN 'n' END AS note FROM orders WHERE o_orderdate IS NOT NULL""",
    "dq_listing": _dq(ORDERS, {"o_orderdate": CATEGORICAL, **ORDER_KINDS})
    + """ SELECT row_number() OVER (ORDER BY batch_id, feature) - 1 AS place, batch_id, feature, unique_count,
  (SELECT count(*) FROM v) AS ledger_rows FROM dq""",
    "written_report": f"SELECT line FROM ({_report_lines(SHIPMENTS, ALL_SHIPMENT_KINDS)}) WHERE line <> ''",
    "row_items_equals_one": _baskets(SHIPMENTS, SHIPMENT_KINDS, "l_orderkey, l_partkey, l_suppkey, l_linenumber,")
    + """ SELECT * REPLACE (array_to_string(list_transform(list_filter(items, lambda x: x NOT LIKE 'l_linenumber=%'
  OR x = 'l_linenumber=1'), lambda x: CASE WHEN x = 'l_linenumber=1' THEN 'l_linenumber' ELSE x END), ',') AS items)
  FROM rows_items""",
    "update_run_dq": _profile(SHIPMENTS, UPDATE_KINDS),
    "written_report_stored": f"""SELECT line FROM (
  {_report_lines(ORDERS, {"o_orderdate": CATEGORICAL, **ORDER_KINDS})}) WHERE line <> ''
  UNION ALL SELECT line FROM ({_eda_lines(ORDERS, {"o_orderdate": CATEGORICAL, **ORDER_KINDS})})""",
    "eda_histogram_first": _eda_histogram(
        f"SELECT {', '.join(f'o_totalprice + {i} AS p{i}' for i in range(len(WIDE_KINDS)))} FROM orders",
        dict(list(WIDE_KINDS.items())[:HISTOGRAMS]),
        5,
    ),
    "rules_listing": f"""SELECT batch_id, row_number() OVER (ORDER BY batch_id, lift DESC, a, c) - 1 AS place,
  array_to_string(a, ',') AS antecedents, array_to_string(c, ',') AS consequents, support, confidence, lift
  FROM ({_ladder(ORDERS, MINED_ORDERS, MIN_RULES, "*")})""",
    "rules_json": f"""SELECT batch_id, '["' || array_to_string(a, '","') || '"]' AS antecedents,
  '["' || array_to_string(c, '","') || '"]' AS consequents, support, confidence, lift
  FROM ({_ladder(ORDERS, MINED_ORDERS, MIN_RULES, "*")})""",
    "two_writers": f"""SELECT batch_id, count(*) AS n_rows, count(*) AS stored_rows FROM ({ORDERS})
  GROUP BY batch_id""",
    "guarded_ingest": f"""WITH o AS ({ORDERS}), bad AS (
    SELECT batch_id, 'price in range' AS "check", count(*) AS n FROM o
    WHERE NOT o_totalprice BETWEEN 1000 AND 499700 GROUP BY batch_id
    UNION ALL SELECT batch_id, 'one order a day, customer and priority', count(*) FROM (
      SELECT batch_id FROM o GROUP BY batch_id, o_custkey, o_orderdate, o_orderpriority HAVING count(*) > 1)
    GROUP BY batch_id
    UNION ALL SELECT batch_id, 'customer exists', count(*) FROM o
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey > 1) GROUP BY batch_id)
  SELECT * FROM bad UNION ALL SELECT batch_id, 'stored', count(*) FROM o
  WHERE batch_id NOT IN (SELECT batch_id FROM bad) GROUP BY batch_id""",
    "stream_closed_months": f"""WITH o AS ({ORDERS}),
  closed AS (
    SELECT strftime(max(date_trunc('day', o_orderdate) + INTERVAL 1 DAY), '%Y-%m') AS month FROM o
    WHERE date_trunc('day', o_orderdate) + INTERVAL 1 DAY <= (SELECT max(o_orderdate) - INTERVAL 10 DAY FROM o))
  SELECT batch_id, count(*) AS n_rows, count(*) FILTER (o_orderkey % 50 = 0) AS late_rows
  FROM o, closed WHERE batch_id < month GROUP BY batch_id""",
}
ORACLES["batch_medians_ranged"] = ORACLES["batch_medians"]
ORACLES["frequent_itemsets_stepwise"] = ORACLES["frequent_itemsets"]
ORACLES["undated_rows"] = ORACLES["time_parse"]
ORACLES["time_parse_bad"] = ORACLES["time_parse"]
ORACLES["stream_ingest"] = ORACLES["batch_ledger"]
ORACLES["update_run_rules"] = ORACLES["rules_orders"]
ORACLES["stored_describe"] = ORACLES["eda_describe"]
ORACLES["stored_correlation"] = ORACLES["eda_correlation"]
