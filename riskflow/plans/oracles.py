"""The same questions in DuckDB SQL, written from the semantics rather than from the Spark plans."""

# Amounts are exact two-digit decimals in the tables.
EVENTS = """e AS (
  SELECT event_id, ts, event_type, value, props,
         cast(user_id % 10 AS varchar) AS from_bank, cast(user_id AS varchar) AS from_account,
         cast((user_id + 1) % 10 AS varchar) AS to_bank, cast(user_id + 1 AS varchar) AS to_account,
         cast(value AS decimal(18,2)) AS amt, user_id
  FROM events)"""

ORDERS = """o AS (
  SELECT o_orderkey AS transaction_id, cast(o_custkey AS varchar) AS from_account,
         cast(o_totalprice AS decimal(18,2)) AS amt, o_orderstatus AS cur, o_orderpriority AS fmt,
         o_orderdate AS ts, hour(o_orderdate) AS h,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AND o_totalprice > 300000
              THEN 1 ELSE 0 END AS is_l
  FROM orders)"""

RAW = """r AS (
  SELECT event_id,
         CASE event_type WHEN 'purchase' THEN strftime(ts, '%Y/%m/%d %H:%M')
                         WHEN 'signup' THEN strftime(ts, '%d-%m-%Y')
                         ELSE strftime(ts, '%Y/%m/%d %H:%M:%S') END AS stamp,
         from_bank, from_account, to_bank, to_account, amt AS received, props AS cur,
         CASE WHEN value >= 1 THEN amt END AS paid, event_type AS fmt,
         CASE WHEN event_type = 'error' AND value > 200 THEN 1 ELSE 0 END AS is_l
  FROM e),
c AS (
  SELECT *, try_strptime(stamp, ['%Y/%m/%d %H:%M:%S', '%Y/%m/%d %H:%M']) AS parsed
  FROM r WHERE from_account IS NOT NULL AND paid IS NOT NULL AND stamp IS NOT NULL)"""


def _features(source: str, stddev: bool = False) -> str:
    spread = "round(stddev_samp(cast(amt AS double)), 2) AS StdDevAmount,"
    return f"""f AS (
  SELECT from_account AS From_Account, count(*) AS TxnCount, cast(sum(amt) AS double) AS TotalAmount,
         cast(sum(amt) AS double) / count(*) AS AvgAmount, cast(max(amt) AS double) AS MaxAmount,
         cast(min(amt) AS double) AS MinAmount, {spread if stddev else ""}
         count(DISTINCT cur) AS NumCurrencies, count(DISTINCT fmt) AS NumFormats,
         cast(quantile_disc(h, 0.5) AS integer) AS HourBucket
  FROM {source} GROUP BY 1)"""


EVENT_TX = "t AS (SELECT from_account, amt, props AS cur, event_type AS fmt, hour(ts) AS h FROM e)"
EVENT_FEATURES = f"WITH {EVENTS}, {EVENT_TX}, {_features('t')}"

EVENT_LABELS = """l AS (
  SELECT from_account AS From_Account, max(CASE WHEN value > 200 THEN 1 ELSE 0 END) AS IsLaundering
  FROM e WHERE event_type = 'error' GROUP BY 1)"""


def _dataset(stddev: bool = False) -> str:
    return f"""WITH {ORDERS}, {_features("o", stddev)},
ml AS (SELECT f.*, coalesce(l.IsLaundering, 0) AS IsLaundering
       FROM f LEFT JOIN (SELECT from_account AS From_Account, max(is_l) AS IsLaundering FROM o GROUP BY 1) l
       USING (From_Account))"""


DATASET = _dataset()
DATASET_SPREAD = _dataset(stddev=True)
LABELLED = f"""{EVENT_FEATURES}, {EVENT_LABELS}
SELECT f.*, coalesce(l.IsLaundering, 0) AS IsLaundering FROM f LEFT JOIN l USING (From_Account)"""


BINS, UNIT = 256, 67108864


def _booster(trees: int, depth: int = 6, rate: float = 0.1) -> str:
    """Splits of the first trees, each level from sums over (node, feature, bin)."""
    features = [c for c in BOOSTED if c != "StdDevAmount"]
    shares = ", ".join(str(k / BINS) for k in range(1, BINS))
    cuts = ", ".join(f"list_sort(list_distinct(quantile_disc({f}, [{shares}]))) AS c{k}" for k, f in enumerate(features))
    bins = ", ".join(f"len(list_filter(c{k}, lambda c: c <= {f}))" for k, f in enumerate(features))
    names = "[" + ", ".join(f"'{f}'" for f in features) + "]"
    doubles = ", ".join(f"cast({f} AS double) AS {f}" for f in features)
    steps = [
        f"x AS (SELECT row_number() OVER () AS rid, IsLaundering AS label, {doubles} FROM ml WHERE {_uniform('From_Account')} < cast(0.8 AS double))",
        f"cuts AS (SELECT {cuts} FROM x)",
        f"b AS MATERIALIZED (SELECT rid, label, [{bins}] AS bins FROM x, cuts)",
        f"cut_of AS (SELECT [{', '.join(f'c{k}' for k in range(len(features)))}] AS cuts FROM cuts)",
        "m0 AS (SELECT rid, cast(0 AS double) AS margin FROM b)",
    ]
    for t in range(trees):
        steps.append(
            f"""g{t} AS MATERIALIZED (SELECT rid, bins, cast(round((p - label) * {UNIT}) AS bigint) AS g, cast(round(p * (1 - p) * {UNIT}) AS bigint) AS h
  FROM (SELECT rid, bins, label, 1 / (1 + exp(-margin)) AS p FROM b JOIN m{t} USING (rid)))"""
        )
        steps.append(f"n{t}_0 AS (SELECT rid, 1 AS node FROM b)")
        for d in range(depth):
            steps += [
                f"""cells{t}_{d} AS (SELECT node, feature, bin, sum(g) AS g, sum(h) AS h, count(*) AS n
  FROM (SELECT node, g, h, unnest(bins) AS bin, unnest(range({len(features)})) AS feature
        FROM n{t}_{d} JOIN g{t} USING (rid) WHERE node >= {1 << d}) GROUP BY ALL)""",
                f"""sums{t}_{d} AS (SELECT node, feature, lead(bin) OVER w AS bin, sum(g) OVER w / cast({UNIT} AS double) AS gl,
    sum(h) OVER w / cast({UNIT} AS double) AS hl, sum(g) OVER a / cast({UNIT} AS double) AS ga, sum(h) OVER a / cast({UNIT} AS double) AS ha,
    (sum(g) OVER a - sum(g) OVER w) / cast({UNIT} AS double) AS gr, (sum(h) OVER a - sum(h) OVER w) / cast({UNIT} AS double) AS hr, sum(n) OVER a AS n
  FROM cells{t}_{d} WINDOW w AS (PARTITION BY node, feature ORDER BY bin ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY node, feature))""",
                f"""best{t}_{d} AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, bin) AS place
  FROM (SELECT *, (gl * gl / (hl + 1) + gr * gr / (hr + 1) - ga * ga / (ha + 1)) / 2 AS gain FROM sums{t}_{d}
        WHERE bin IS NOT NULL AND hl >= 1 AND hr >= 1)) WHERE place = 1 AND gain > 1e-9)""",
                f"""n{t}_{d + 1} AS MATERIALIZED (SELECT rid, CASE WHEN s.node IS NULL THEN r.node
    ELSE 2 * r.node + CASE WHEN bins[s.feature + 1] >= s.bin THEN 1 ELSE 0 END END AS node
  FROM n{t}_{d} r JOIN b USING (rid) LEFT JOIN best{t}_{d} s ON s.node = r.node)""",
            ]
        steps.append(
            f"""m{t + 1} AS (SELECT rid, margin + value AS margin FROM m{t} JOIN n{t}_{depth} USING (rid) JOIN (
  SELECT node, -{rate} * (sum(g) / cast({UNIT} AS double)) / (sum(h) / cast({UNIT} AS double) + 1) AS value
  FROM n{t}_{depth} JOIN g{t} USING (rid) GROUP BY 1) USING (node))"""
        )
    found = " UNION ALL ".join(
        f"SELECT {t} AS tree, node, {names}[feature + 1] AS feature, cuts[feature + 1][bin] AS cut, round(gain, 6) AS gain, cast(n AS bigint) AS n FROM best{t}_{d}, cut_of"
        for t in range(trees)
        for d in range(depth)
    )
    return f"{DATASET},\n" + ",\n".join(steps) + f"\n{found}"


def _uniform(key: str) -> str:
    digest = f"md5(concat(cast({key} AS varchar), ':42'))"
    return f"(cast(cast('0x' || substr({digest}, 1, 13) AS bigint) AS double) / 4503599627370496.0)"


LOG = f"""WITH {EVENTS}, log AS (
  SELECT from_bank AS source, event_id AS line_no,
    CASE WHEN event_type = 'error'
         THEN concat('BEGIN LAUNDERING ATTEMPT - P', user_id % 8, ':  Max ', user_id)
         WHEN event_type = 'signup' THEN 'END LAUNDERING ATTEMPT - P'
         WHEN event_type = 'view' AND value > 150
         THEN concat(strftime(ts, '%Y/%m/%d %H:%M'), ',', from_bank, ',', from_account)
         ELSE concat(strftime(ts, '%Y/%m/%d %H:%M'), ',', from_bank, ',', from_account, ',', to_bank, ',',
                     to_account, ',', CASE WHEN value >= 1 THEN cast(amt AS varchar) ELSE '' END, ',', props, ',',
                     cast(amt AS varchar), ',', props, ',', event_type, ',',
                     CASE WHEN value > 100 THEN '1' ELSE '0' END)
    END AS value
  FROM e),
h AS (
  SELECT *, CASE WHEN regexp_matches(value, 'BEGIN LAUNDERING ATTEMPT - (.+)')
                 THEN regexp_extract(value, 'BEGIN LAUNDERING ATTEMPT - (.+)', 1) END AS header
  FROM log)"""

FILLED = f"""{LOG},
filled AS (
  SELECT source, line_no, value,
         last_value(header IGNORE NULLS) OVER (
           PARTITION BY source ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS Pattern_Type
  FROM h)"""

BLOCKS = f"""{LOG},
events2 AS (
  SELECT *, CASE WHEN contains(value, 'END LAUNDERING ATTEMPT') THEN '' ELSE header END AS mark FROM h)
SELECT source, line_no, nullif(last_value(mark IGNORE NULLS) OVER (
         PARTITION BY source ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS Pattern_Type
FROM events2"""

FIELDS = [
    "Timestamp",
    "From_Bank",
    "From_Account",
    "To_Bank",
    "To_Account",
    "Amount_Received",
    "Receiving_Currency",
    "Amount_Paid",
    "Payment_Currency",
    "Payment_Format",
]
PATTERN_ROWS = f"""{FILLED},
pr AS (
  SELECT source, line_no, {", ".join(f'string_split(value, chr(44))[{i}] AS "{c}"' for i, c in enumerate(FIELDS, 1))},
         string_split(value, chr(44))[11] AS flag,
         Pattern_Type AS full_name, regexp_replace(Pattern_Type, ':.*', '') AS Pattern_Type
  FROM filled
  WHERE NOT contains(value, 'END LAUNDERING ATTEMPT')
    AND regexp_matches(value, '\\d{{4}}/\\d{{2}}/\\d{{2}}'))"""
FIELD_LIST = ", ".join(f'"{c}"' for c in FIELDS)

SCORED = f"""WITH {ORDERS}, u AS (SELECT *, {_uniform("transaction_id")} AS u FROM o),
band AS (
  SELECT *, CASE WHEN amt > 50000 THEN cast(0.7 AS double) WHEN amt > 20000 THEN cast(0.4 AS double)
                 ELSE cast(0.05 AS double) END AS lo,
            CASE WHEN amt > 50000 THEN cast(0.95 AS double) WHEN amt > 20000 THEN cast(0.7 AS double)
                 ELSE cast(0.4 AS double) END AS hi
  FROM u),
s AS (
  SELECT transaction_id, from_account AS From_Account, cast(amt AS double) AS amount, is_l,
         floor((lo + (hi - lo) * u) * cast(10000 AS double) + cast(0.5 AS double)) / cast(10000 AS double)
           AS LaunderingProbability
  FROM band),
p AS (SELECT *, CASE WHEN LaunderingProbability >= cast(0.5 AS double) THEN 1 ELSE 0 END AS Prediction FROM s)"""

FILL_DEFAULTS = """5 AS TxnCount, amount AS TotalAmount, cast(5000 AS double) AS AvgAmount, amount AS MaxAmount,
  cast(100 AS double) AS MinAmount, cast(2000 AS double) AS StdDevAmount, 2 AS NumCurrencies, 2 AS NumFormats,
  14 AS HourBucket"""
BATCH = f"""{SCORED}
SELECT transaction_id, From_Account, {FILL_DEFAULTS}, LaunderingProbability, Prediction FROM p"""


def _div(top: str, bottom: str) -> str:
    return f"(CASE WHEN {bottom} = 0 THEN cast(0 AS double) ELSE cast({top} AS double) / cast({bottom} AS double) END)"


def _cells(condition: str) -> str:
    return f"""count(*) FILTER (WHERE is_l = 0 AND NOT ({condition})) AS tn,
         count(*) FILTER (WHERE is_l = 0 AND ({condition})) AS fp,
         count(*) FILTER (WHERE is_l = 1 AND NOT ({condition})) AS fn,
         count(*) FILTER (WHERE is_l = 1 AND ({condition})) AS tp"""


REPORT = f"""{SCORED},
k AS (SELECT {_cells("Prediction = 1")} FROM p),
per AS (
  SELECT *, {_div("tn", "(tn + fn)")} AS p0, {_div("tn", "(tn + fp)")} AS r0,
            {_div("2 * tn", "(2 * tn + fn + fp)")} AS f0, tn + fp AS n0,
            {_div("tp", "(tp + fp)")} AS p1, {_div("tp", "(tp + fn)")} AS r1,
            {_div("2 * tp", "(2 * tp + fp + fn)")} AS f1, tp + fn AS n1
  FROM k)
SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, n0 AS support FROM per
UNION ALL SELECT '1', p1, r1, f1, n1 FROM per
UNION ALL SELECT 'accuracy', NULL, NULL, {_div("tn + tp", "(n0 + n1)")}, n0 + n1 FROM per
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n0 + n1 FROM per
UNION ALL SELECT 'weighted avg', {_div("p0 * n0 + p1 * n1", "(n0 + n1)")}, {_div("r0 * n0 + r1 * n1", "(n0 + n1)")},
                 {_div("f0 * n0 + f1 * n1", "(n0 + n1)")}, n0 + n1 FROM per"""


def _threshold(value: str) -> str:
    return f"""SELECT cast({value} AS double) AS threshold, tn, fp, fn, tp, {_div("tp", "(tp + fp)")} AS precision,
  {_div("tp", "(tp + fn)")} AS recall, {_div("2 * tp", "(2 * tp + fp + fn)")} AS f1,
  {_div("tn + tp", "(tn + fp + fn + tp)")} AS accuracy
FROM (SELECT {_cells(f"LaunderingProbability >= cast({value} AS double)")} FROM s)"""


RANKED = f"""{DATASET},
sizes AS (SELECT count(*) FILTER (WHERE IsLaundering = 1) AS n1, count(*) FILTER (WHERE IsLaundering = 0) AS n0 FROM ml),
small AS (
  SELECT CASE WHEN n1 <= n0 THEN 1 ELSE 0 END AS cls, least(n0, n1) AS n, greatest(n0, n1) - least(n0, n1) AS missing
  FROM sizes),
idx AS (
  SELECT ml.*, row_number() OVER (ORDER BY {_uniform("From_Account")}, From_Account) - 1 AS i
  FROM ml, small WHERE IsLaundering = cls)"""
DATASET_COLUMNS = """From_Account, TxnCount, TotalAmount, AvgAmount, MaxAmount, MinAmount, NumCurrencies, NumFormats,
  HourBucket, IsLaundering"""

BOOSTED = [
    "TxnCount",
    "TotalAmount",
    "AvgAmount",
    "MaxAmount",
    "MinAmount",
    "StdDevAmount",
    "NumCurrencies",
    "NumFormats",
    "HourBucket",
]
NUMERIC = f"""{DATASET_SPREAD}
SELECT From_Account, {", ".join(f"cast({c} AS double) AS {c}" for c in BOOSTED)}, cast(IsLaundering AS double) AS label
FROM ml"""

SAMPLE_ORDER = "md5(concat(From_Account, ':42')), From_Account"

TOTALS = f"""WITH {EVENTS}
SELECT from_account AS Account, cast(sum(amt) AS double) AS TotalAmount, count(*) AS TxnCount,
       cast(sum(amt) AS double) / count(*) AS AvgAmount
FROM e GROUP BY 1"""

ORACLES: dict[str, str] = {
    "clean_transactions": f"""WITH {EVENTS}, {RAW}
SELECT from_bank AS From_Bank, from_account AS From_Account, to_bank AS To_Bank, to_account AS To_Account,
       cast(received AS double) AS Amount_Received, cur AS Receiving_Currency, cast(paid AS double) AS Amount_Paid,
       cur AS Payment_Currency, fmt AS Payment_Format, is_l AS Is_Laundering, parsed AS "Timestamp",
       cast(hour(parsed) AS integer) AS Hour
FROM c""",
    "parse_timestamp": f"""WITH {EVENTS}, {RAW}
SELECT event_id, stamp AS Timestamp_str,
       try_strptime(stamp, ['%Y/%m/%d %H:%M:%S', '%Y/%m/%d %H:%M']) AS "Timestamp" FROM r""",
    "account_features": f"{EVENT_FEATURES} SELECT * FROM f",
    "account_features_any_categories": f"{EVENT_FEATURES} SELECT * FROM f",
    "account_stddev": f"{DATASET_SPREAD} SELECT From_Account, StdDevAmount FROM ml",
    "hour_bucket": f"{EVENT_FEATURES} SELECT From_Account, HourBucket FROM f",
    "distinct_counts": f"{EVENT_FEATURES} SELECT From_Account, NumCurrencies, NumFormats FROM f",
    "total_count_avg": TOTALS,
    "labels_max": f"WITH {EVENTS}, {EVENT_LABELS} SELECT * FROM l",
    "features_with_labels": LABELLED,
    "features_with_bank_labels": f"""{EVENT_FEATURES},
l AS (SELECT cast(from_bank AS bigint) AS bank, max(CASE WHEN value > 200 THEN 1 ELSE 0 END) AS IsLaundering
      FROM e WHERE event_type = 'error' GROUP BY 1)
SELECT f.*, coalesce(l.IsLaundering, 0) AS IsLaundering FROM f LEFT JOIN l ON try_cast(f.From_Account AS bigint) = l.bank""",
    "pattern_lines": f"{LOG} SELECT value, count(*) AS n_lines FROM log GROUP BY 1",
    "pattern_header": f"{LOG} SELECT source, line_no, header AS Pattern_Type FROM h",
    "pattern_lines_no_end": f"""{LOG}
SELECT source, line_no, value FROM log WHERE NOT contains(value, 'END LAUNDERING ATTEMPT')""",
    "pattern_forward_fill": f"{FILLED} SELECT source, line_no, Pattern_Type FROM filled",
    "pattern_block_fill": BLOCKS,
    "pattern_file_fill": f"{FILLED} SELECT source, value, Pattern_Type, count(*) AS n_lines FROM filled GROUP BY ALL",
    "pattern_transactions": f"""{PATTERN_ROWS}
SELECT source, line_no, {FIELD_LIST}, Pattern_Type, 1 AS isLaundering FROM pr""",
    "pattern_narrow": f"""{PATTERN_ROWS}
SELECT "Timestamp", From_Bank, full_name AS Pattern_Type, 1 AS isLaundering FROM pr""",
    "pattern_name_clean": f"""{LOG}
SELECT source, line_no, header AS Pattern_Type, regexp_replace(header, ':.*', '') AS short_name
FROM h WHERE header IS NOT NULL""",
    "pattern_counts": f'{PATTERN_ROWS} SELECT Pattern_Type, count(Pattern_Type) AS "count" FROM pr GROUP BY 1',
    "label_counts": f"""{PATTERN_ROWS}
SELECT cast(flag AS integer) AS isLaundering, count(*) AS "count" FROM pr GROUP BY 1""",
    "empty_string_counts": f"""{PATTERN_ROWS}
SELECT {", ".join(f"count(*) FILTER (WHERE {c} = '') AS {c}" for c in [f'"{n}"' for n in FIELDS] + ["Pattern_Type"])}
FROM pr""",
    "union_sources": f"""{FILLED}
SELECT CASE WHEN cast(source AS integer) % 2 = 0 THEN 'even' ELSE 'odd' END AS origin,
       cast(cast(source AS integer) // 2 AS varchar) AS source, line_no, Pattern_Type
FROM filled""",
    "union_transactions": f"""WITH {EVENTS}, {ORDERS}
SELECT from_account AS From_Account, cast(amt AS double) AS Amount_Paid, props AS Payment_Currency,
       event_type AS Payment_Format, ts AS "Timestamp", 'events' AS origin FROM e
UNION ALL SELECT from_account, cast(amt AS double), cur, fmt, ts, 'orders' FROM o""",
    "null_counts": f"""WITH {EVENTS}, {RAW}
SELECT count(*) AS n_rows, count(*) - count(from_account) AS From_Account, count(*) - count(paid) AS Amount_Paid,
       count(*) - count(parsed) AS "Timestamp", count(*) - count(hour(parsed)) AS Hour FROM c""",
    "row_counts": f"""WITH {EVENTS}, {RAW}
SELECT 'raw' AS stage, count(*) AS n_rows, 12 AS n_columns FROM r
UNION ALL SELECT 'clean', count(*), 12 FROM c""",
    "class_distribution": f"""{DATASET}
SELECT IsLaundering, count(*) AS "count", count(*) / (SELECT count(*) FROM ml) AS share FROM ml GROUP BY 1""",
    "hash_split": f"""WITH {ORDERS}
SELECT transaction_id, from_account AS From_Account,
       CASE WHEN {_uniform("transaction_id")} < cast(0.8 AS double) THEN 'train' ELSE 'test' END AS split FROM o""",
    "stratified_split": f"""{DATASET}
SELECT From_Account, IsLaundering, CASE WHEN rn <= floor(n * cast(0.7 AS double) + 0.5) THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY IsLaundering ORDER BY {_uniform("From_Account")}, From_Account) AS rn,
             count(*) OVER (PARTITION BY IsLaundering) AS n FROM ml)""",
    "exact_sample": f"{DATASET} SELECT * FROM ml ORDER BY {SAMPLE_ORDER} LIMIT 100",
    "relabel_sample_union": f"""{DATASET}
SELECT * FROM ml
UNION ALL SELECT * REPLACE (1 AS IsLaundering) FROM (SELECT * FROM ml ORDER BY {SAMPLE_ORDER} LIMIT 100)""",
    "oversample_bootstrap": f"""{RANKED},
draws AS (
  SELECT cast(floor({_uniform("d")} * n) AS bigint) AS i
  FROM (SELECT n, unnest(range(missing)) AS d FROM small))
SELECT {DATASET_COLUMNS} FROM ml
UNION ALL SELECT {DATASET_COLUMNS} FROM idx JOIN draws USING (i)""",
    "oversample_replicate": f"""{RANKED}
SELECT {DATASET_COLUMNS} FROM ml
UNION ALL SELECT {DATASET_COLUMNS} FROM (
  SELECT idx.*, unnest(range(missing // n + CASE WHEN i < missing % n THEN 1 ELSE 0 END)) AS copy FROM idx, small)""",
    "ml_numeric_view": NUMERIC,
    "ml_valid_rows": f"{NUMERIC} WHERE StdDevAmount IS NOT NULL",
    "feature_list_select": f"{DATASET_SPREAD} SELECT From_Account, {', '.join(BOOSTED)} FROM ml",
    "fill_missing_columns": f"{SCORED} SELECT transaction_id, From_Account, {FILL_DEFAULTS} FROM s",
    "rule_score": f"{SCORED} SELECT transaction_id, From_Account, amount, LaunderingProbability FROM s",
    "rule_predictions": f"""{SCORED}
SELECT transaction_id, From_Account, amount, LaunderingProbability, Prediction,
       CASE WHEN Prediction = 1 THEN 'Likely Laundering' ELSE 'Not Laundering' END AS verdict FROM p""",
    "threshold_predictions": f"""{SCORED}
SELECT transaction_id, Prediction AS at_default,
       CASE WHEN LaunderingProbability >= cast(0.7 AS double) THEN 1 ELSE 0 END AS at_strict FROM p""",
    "batch_score": BATCH,
    "preview_100": f"""{SCORED}
SELECT From_Account, LaunderingProbability, Prediction FROM p ORDER BY transaction_id LIMIT 100""",
    "preview_20": f"SELECT * FROM ({TOTALS}) ORDER BY Account LIMIT 20",
    "confusion_matrix": f"""{SCORED}
SELECT label, prediction, (SELECT count(*) FROM p WHERE is_l = label AND p.Prediction = cells.prediction) AS "count"
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) cells(label, prediction)""",
    "classification_report": REPORT,
    "threshold_report": f"{SCORED} {_threshold('0.5')} UNION ALL {_threshold('0.7')}",
    "auc_exact": f"""{SCORED},
g AS (SELECT LaunderingProbability AS v, count(*) FILTER (WHERE is_l = 1) AS pos,
             count(*) FILTER (WHERE is_l = 0) AS neg FROM s GROUP BY 1),
b AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT cast(sum(pos * (2 * below + neg)) AS double)
         / (cast(2 AS double) * cast(sum(pos) AS double) * cast(sum(neg) AS double)) AS auc,
       cast(sum(pos) AS bigint) AS n_positive, cast(sum(neg) AS bigint) AS n_negative,
       cast(0 AS bigint) AS n_unscored FROM b""",
    "account_states": f"""WITH {EVENTS}, {EVENT_TX}
SELECT from_account AS From_Account, count(*) AS n, count(amt) AS paid, cast(sum(amt) AS double) AS total,
       cast(max(amt) AS double) AS high, cast(min(amt) AS double) AS low,
       concat_ws('|', {", ".join(f"count(*) FILTER (WHERE h = {k})" for k in range(24))}) AS hours,
       coalesce(string_agg(DISTINCT cur, '|' ORDER BY cur), '') AS currencies,
       coalesce(string_agg(DISTINCT fmt, '|' ORDER BY fmt), '') AS formats
FROM t GROUP BY 1""",
    "merged_state_features": f"WITH {EVENTS}, {EVENT_TX}, {_features('t', stddev=True)} SELECT * FROM f",
    "sketch_estimates": f"""WITH {ORDERS}
SELECT cur AS Payment_Currency, count(*) AS n_sketched, count(DISTINCT transaction_id) AS exact_transaction_id,
       count(DISTINCT from_account) AS "exact_From_Account", 1 AS transaction_id_near, 1 AS "From_Account_near",
       CASE WHEN count(DISTINCT transaction_id) <= 4096 THEN count(DISTINCT transaction_id) END AS transaction_id_kept,
       CASE WHEN count(DISTINCT from_account) <= 4096 THEN count(DISTINCT from_account) END AS "From_Account_kept",
       1 AS q25_near, 1 AS q50_near, 1 AS q90_near
FROM o GROUP BY 1""",
    "trailing_counts": f"""WITH {ORDERS}
SELECT transaction_id, from_account AS From_Account, count(*) OVER w AS TrailingCount, cast(sum(amt) OVER w AS double) AS TrailingAmount
FROM o WINDOW w AS (PARTITION BY from_account ORDER BY ts RANGE BETWEEN INTERVAL 7775999999999 MICROSECONDS PRECEDING AND CURRENT ROW)""",
    "bucketed_features_with_labels": LABELLED,
    "corrupt_counts": f"""WITH {EVENTS}, {RAW},
k AS (SELECT *, CASE WHEN fmt = 'signup' THEN 'short' WHEN fmt = 'error' THEN 'long' WHEN fmt = 'view' AND received > 150 THEN 'quote' END AS kind FROM r)
SELECT 'line: ' || kind AS reason, count(*) AS n_rows FROM k WHERE kind IS NOT NULL GROUP BY 1
UNION ALL SELECT 'malformed line', count(*) FROM k WHERE kind IS NOT NULL
-- What follows a line end in quotes has all fields but a whole time, and is a row.
UNION ALL SELECT 'no amount', count(*) FROM k WHERE (kind IS NULL OR kind = 'quote') AND paid IS NULL""",
    "booster_splits": _booster(trees=2),
    "booster_gain": f"""WITH found AS ({_booster(trees=2)})
SELECT feature, round(avg(gain), 4) AS gain, count(*) AS splits, cast(sum(n) AS bigint) AS n_rows,
       (SELECT count(*) FROM (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY gain DESC, node) AS place FROM found) b
        WHERE place = 1 AND b.feature = found.feature) AS n_best
FROM found GROUP BY feature""",
    "balanced_weights": f"""{DATASET},
v AS (SELECT IsLaundering AS label, {", ".join(f"cast({c} AS double) AS {c}" for c in BOOSTED if c != "StdDevAmount")},
             count(*) OVER () / cast(2 AS double) / count(*) OVER (PARTITION BY IsLaundering) AS w FROM ml),
mean AS (SELECT avg(w) AS m FROM v),
long AS (SELECT label, w, unnest([{", ".join(c for c in BOOSTED if c != "StdDevAmount")}]) AS x,
                unnest(range({len(BOOSTED) - 1})) AS f FROM v),
cuts AS (SELECT f, unnest(list_distinct(quantile_disc(x, [{", ".join(str(k / BINS) for k in range(1, BINS))}]))) AS cut FROM long GROUP BY f),
grad AS (SELECT f, x, cast(round((0.5 - label) * (w / m) * {UNIT}) AS bigint) AS g, cast(round(0.25 * (w / m) * {UNIT}) AS bigint) AS h FROM long, mean),
sides AS (SELECT c.f, c.cut, sum(g) FILTER (WHERE x < cut) / cast({UNIT} AS double) AS gl, sum(h) FILTER (WHERE x < cut) / cast({UNIT} AS double) AS hl,
                 sum(g) FILTER (WHERE x >= cut) / cast({UNIT} AS double) AS gr, sum(h) FILTER (WHERE x >= cut) / cast({UNIT} AS double) AS hr
          FROM cuts c JOIN grad USING (f) GROUP BY ALL),
best AS (SELECT f, cut FROM sides WHERE hl >= 1 AND hr >= 1 ORDER BY round(gl * gl / (hl + 1) + gr * gr / (hr + 1), 9) DESC, f, cut LIMIT 1)
SELECT IsLaundering AS label, count(*) AS n_rows, count(*) AS n_accounts, round((SELECT count(*) FROM ml) / 2, 6) AS weight,
       any_value([{", ".join(f"'{c}'" for c in BOOSTED if c != "StdDevAmount")}][best.f + 1]) AS feature, any_value(best.cut) AS cut
FROM ml, best GROUP BY 1""",
    "label_index": f"""WITH {ORDERS},
known AS (SELECT fmt, row_number() OVER (ORDER BY fmt) - 1 AS k FROM (SELECT DISTINCT fmt FROM o WHERE cur = 'F' AND fmt <> '3-MEDIUM'))
SELECT fmt AS Payment_Format, cast(coalesce(k, (SELECT count(*) FROM known)) AS integer) AS label, count(*) AS n_rows,
       CASE WHEN k IS NULL THEN count(*) ELSE 0 END AS n_unseen
FROM o LEFT JOIN known USING (fmt) GROUP BY fmt, k""",
    "pipeline_batch_score": f"""WITH {ORDERS}
SELECT transaction_id, 5 AS TxnCount, cast(amt AS double) AS TotalAmount, cast(5000 AS double) AS AvgAmount,
       CASE WHEN transaction_id % 5 > 0 THEN cast(amt AS double) END AS MaxAmount, cast(100 AS double) AS MinAmount, 2 AS NumCurrencies,
       2 AS NumFormats, 14 AS HourBucket, CASE WHEN transaction_id % 5 > 0 THEN 1 ELSE 0 END AS Imputed,
       CASE WHEN transaction_id % 5 > 0 THEN 1 ELSE 0 END AS is_scored, 1 AS unchanged
FROM o""",
    "gbt_train_score": f"""{DATASET}
SELECT From_Account, IsLaundering, 1 AS is_probability, 1 AS prediction_follows
FROM ml WHERE {_uniform("From_Account")} >= cast(0.8 AS double)""",
    "compare_models": f"""{DATASET}
SELECT unnest(['gbt_50', 'boosted_100_depth6', 'boosted_100_depth5']) AS model,
       count(*) FILTER (WHERE {_uniform("From_Account")} < cast(0.8 AS double)) AS n_train,
       count(*) FILTER (WHERE {_uniform("From_Account")} >= cast(0.8 AS double)) AS n_test,
       cast(0 AS bigint) AS n_dropped, 1 AS auc_agrees, 1 AS beats_chance FROM ml""",
    "feature_gain": "SELECT unnest(["
    + ", ".join(f"'{c}'" for c in BOOSTED if c != "StdDevAmount")
    + "]) AS feature, 1 AS gain_is_positive",
    "model_batch_score": f"""{DATASET_SPREAD}
SELECT o.transaction_id, ml.From_Account, ml.TxnCount, coalesce(ml.StdDevAmount, 0) AS StdDevAmount, 0 AS Imputed,
       1 AS is_probability
FROM o JOIN ml ON ml.From_Account = o.from_account""",
    "balanced_split": f"""{DATASET},
parts AS (SELECT IsLaundering, CASE WHEN {_uniform("From_Account")} < cast(0.8 AS double) THEN 'train' ELSE 'test' END AS split FROM ml),
k AS (SELECT split, IsLaundering, count(*) AS n FROM parts GROUP BY ALL)
SELECT split, IsLaundering, CASE WHEN split = 'train' THEN (SELECT max(n) FROM k WHERE split = 'train') ELSE n END AS n_rows,
       n AS n_accounts, cast(0 AS bigint) AS n_mixed FROM k""",
    "model_roundtrip": f"""{DATASET}
SELECT From_Account, 1 AS unchanged FROM ml WHERE {_uniform("From_Account")} >= cast(0.8 AS double)""",
    "csv_roundtrip": LABELLED,
    # Purchases have an amount that is no number.
    "raw_csv_features": f"""WITH {EVENTS}, {RAW},
t AS (SELECT from_account, paid AS amt, cur, fmt, hour(parsed) AS h FROM c WHERE fmt <> 'purchase'), {_features("t")}
SELECT * FROM f""",
    "reject_counts": f"""WITH {EVENTS}, {RAW}
SELECT CASE WHEN paid IS NULL THEN 'no amount' ELSE 'amount not readable' END AS reason, count(*) AS n_rows
FROM r WHERE paid IS NULL OR fmt = 'purchase' GROUP BY 1""",
    "label_csv_join": f"""{PATTERN_ROWS},
m AS (SELECT "From_Account", max(cast(flag AS integer)) AS top FROM pr GROUP BY 1),
a AS (SELECT from_account AS acc, cast(quantile_disc(hour(ts), 0.5) AS integer) AS HourBucket FROM e GROUP BY 1)
SELECT acc AS "From_Account", HourBucket, coalesce(top, 0) AS IsLaundering FROM a LEFT JOIN m ON m."From_Account" = a.acc""",
    "batch_csv_score": BATCH,
    "stream_rule_score": BATCH,
    "stream_window_features": f"""WITH {EVENTS}
SELECT date_trunc('day', ts)::timestamp AS window_start, (date_trunc('day', ts) + INTERVAL 1 DAY)::timestamp AS window_end,
       from_account AS From_Account, count(*) AS TxnCount, cast(sum(amt) AS double) AS TotalAmount,
       cast(max(amt) AS double) AS MaxAmount, cast(min(amt) AS double) AS MinAmount,
       cast(quantile_disc(hour(ts), 0.5) AS integer) AS HourBucket, count(DISTINCT props) AS "ApproxCurrencies"
FROM e GROUP BY 1, 2, 3""",
}
ORACLES["raw_csv_any_order"] = ORACLES["raw_csv_features"]
ORACLES["stream_model_score"] = ORACLES["model_batch_score"]
