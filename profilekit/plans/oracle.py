"""DuckDB SQL of each registered query, over the driver's tables as views.

Column names and types are aligned with the Spark results: every computed
column is aliased, integers are cast alike on both sides.
"""

from __future__ import annotations

from profilekit.plans import standins as S
from profilekit.vocab import INTERESTS, SCORED_INTERESTS, ZERO_INTERESTS

SQL: dict[str, str] = {}


def _values(pairs: list[tuple[str, str]]) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in pairs)


def _flags(tag: str = "tag") -> str:
    return ",\n  ".join(f"max(CASE WHEN {tag} = '{t}' THEN 1 ELSE 0 END) AS {t}" for t in INTERESTS)


EVENT_CODES_TAGGED = f"""
codes AS (
  SELECT user_id AS userid, strftime(ts, '%Y-%m-%d') AS etl_dt,
         unnest(string_split(props->>'$.{S.EVENT_JSON_KEY}', ',')) AS code
  FROM events
  WHERE props->>'$.{S.EVENT_JSON_KEY}' <> '' AND NOT starts_with(props->>'$.{S.EVENT_JSON_KEY}', '[')
),
tagged AS (
  SELECT c.userid, c.etl_dt, c.code, coalesce(m.tag, '') AS tag
  FROM codes c LEFT JOIN (VALUES {_values(S.event_code_map())}) m(code, tag) ON c.code = m.code
  WHERE length(c.code) = {S.EVENT_CODE_LEN}
)"""

SQL["json_code"] = f"""
SELECT event_id, user_id AS userid, props->>'$.{S.EVENT_JSON_KEY}' AS code
FROM events WHERE props->>'$.{S.EVENT_JSON_KEY}' <> ''
"""

SQL["code_explode"] = """
SELECT p_partkey, token FROM (
  SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token FROM part
) WHERE length(token) = 5
"""

SQL["code_profile"] = f"""
WITH {EVENT_CODES_TAGGED}
SELECT userid,
  {_flags()},
  'events' AS source, '{S.AS_OF_TEXT}' AS update_dt
FROM tagged GROUP BY userid
"""

SQL["code_profile_day"] = f"""
WITH {EVENT_CODES_TAGGED}
SELECT userid, etl_dt,
  {_flags()},
  'events' AS source, '{S.AS_OF_TEXT}' AS update_dt
FROM tagged GROUP BY userid, etl_dt
"""


def _tag_case(expr: str, tags: tuple[str, ...]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(tags))
    return f"CASE {expr} {whens} END"


APP_TAGGED = f"""
dict_lines AS (
  SELECT p_name AS appname, {_tag_case(f"p_size % {S.APP_TAG_MODULUS}", S.APP_TAGS)} AS tag, p_partkey AS line
  FROM part
),
dict AS (SELECT appname, arg_max(tag, line) AS tag FROM dict_lines GROUP BY appname),
app_log AS (
  SELECT l.l_suppkey AS userid, p.p_name AS appname, strftime(l.l_shipdate, '%Y-%m-%d') AS etl_dt
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
tagged AS (
  SELECT a.userid, a.etl_dt, d.tag FROM app_log a JOIN dict d ON a.appname = d.appname
  WHERE d.tag IS NOT NULL AND d.tag <> '' AND d.tag <> 'null'
)"""

SQL["dict_profile"] = f"""
WITH {APP_TAGGED}
SELECT userid,
  {_flags()},
  'app' AS source, '{S.AS_OF_TEXT}' AS update_dt
FROM tagged GROUP BY userid
"""

SQL["dict_profile_day"] = f"""
WITH {APP_TAGGED}
SELECT userid, etl_dt,
  {_flags()},
  'app' AS source, '{S.AS_OF_TEXT}' AS update_dt
FROM tagged GROUP BY userid, etl_dt
"""

SQL["flag_pivot"] = """
SELECT user_id,
  max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS click,
  max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS error,
  max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS purchase,
  max(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS signup,
  max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS view
FROM events GROUP BY user_id
"""

DEVICE_RULE = "length(cast(user_id AS VARCHAR)) >= 2"

SQL["extract_payloads"] = f"""
SELECT DISTINCT user_id AS userid, props AS mediadata, strftime(ts, '%Y-%m-%d') AS etl_dt
FROM events
WHERE event_type = '{S.SOCIAL_CHANNEL}' AND {DEVICE_RULE}
  AND cast(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
"""

SQL["trailing_days"] = f"""
SELECT strftime(ts, '%Y-%m-%d') AS etl_dt, count(*) AS n_rows, count(DISTINCT user_id) AS n_users
FROM events
WHERE cast(ts AS DATE) BETWEEN DATE '{S.AS_OF_TEXT}' - 30 AND DATE '{S.AS_OF_TEXT}' - 13
GROUP BY 1
"""


def _score_cols(priority: str) -> str:
    cols = [f"cast(({priority} * {j + 1}) % {S.SCORE_MODULUS} AS DOUBLE) AS {name}"
            for j, name in enumerate(SCORED_INTERESTS)]
    cols += [f"cast(0 AS DOUBLE) AS {name}" for name in ZERO_INTERESTS]
    return ", ".join(cols)


def _avg_cols(alias: str = "") -> str:
    return ",\n  ".join(f"avg({alias}{c}) / 120.0 AS {c}" for c in INTERESTS)


PAYLOAD_SCORES = f"""
code_scores AS (
  SELECT cast(range AS VARCHAR) AS iqytag, {_score_cols('range')} FROM range({S.SCORE_CODES})
),
payload_scores AS (
  SELECT p.yktag, s.* FROM (SELECT DISTINCT props AS yktag, props->>'$.{S.EVENT_JSON_KEY}' AS iqytag FROM events) p
  JOIN code_scores s ON p.iqytag = s.iqytag
)"""

SQL["payload_scores"] = f"""
WITH {PAYLOAD_SCORES}
SELECT yktag, iqytag, {', '.join(INTERESTS)} FROM payload_scores
"""


def _title_match(texts: str, dictionary: str) -> str:
    return f"""
dict AS ({dictionary}),
keys AS (SELECT iqytag AS key, min(priority) AS priority FROM dict
         WHERE iqytag IS NOT NULL AND length(iqytag) > 0 GROUP BY iqytag),
texts AS (SELECT DISTINCT t AS text FROM ({texts}) WHERE t IS NOT NULL),
m AS (SELECT t.text, arg_min(k.key, (k.priority, k.key)) AS key
      FROM texts t JOIN keys k ON contains(t.text, k.key) GROUP BY t.text)
SELECT m.text AS yktag, d.iqytag, {', '.join('d.' + c for c in INTERESTS)}
FROM m JOIN dict d ON d.iqytag = m.key
"""


SQL["match_titles"] = "WITH " + _title_match(
    "SELECT text AS t FROM documents",
    f"SELECT text AS iqytag, item_id AS priority, {_score_cols('item_id')} FROM benchmark")

SQL["match_titles_short"] = "WITH " + _title_match(
    "SELECT p_name AS t FROM part",
    f"""SELECT tok AS iqytag, priority, {_score_cols('priority')} FROM (
      SELECT tok, min(p_partkey * 10 + pos) AS priority FROM (
        SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tok,
               generate_subscripts(string_split(p_name, ' '), 1) - 1 AS pos FROM part)
      GROUP BY tok)""")

SQL["score_profile"] = f"""
WITH {PAYLOAD_SCORES},
pairs AS (
  SELECT DISTINCT user_id AS userid, props AS mediadata FROM events
  WHERE event_type = '{S.VIDEO_CHANNEL}' AND {DEVICE_RULE}
    AND cast(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
)
SELECT userid,
  {_avg_cols('s.')},
  'events' AS source, '{S.AS_OF_TEXT}' AS update_dt
FROM pairs JOIN payload_scores s ON pairs.mediadata = s.yktag GROUP BY userid
"""

SQL["score_profile_day"] = f"""
WITH {PAYLOAD_SCORES},
pairs AS (
  SELECT DISTINCT user_id AS userid, props AS mediadata, strftime(ts, '%Y-%m-%d') AS etl_dt FROM events
  WHERE event_type = '{S.VIDEO_CHANNEL}' AND {DEVICE_RULE}
    AND cast(ts AS DATE) BETWEEN DATE '{S.AS_OF_TEXT}' - 30 AND DATE '{S.AS_OF_TEXT}' - 2
)
SELECT userid, etl_dt,
  {_avg_cols('s.')},
  'events' AS source, '{S.AS_OF_TEXT}' AS update_dt
FROM pairs JOIN payload_scores s ON pairs.mediadata = s.yktag GROUP BY userid, etl_dt
"""


def _matched_sql(nearest: int, width: int, count: int) -> str:
    ago = f"date_diff('day', cast(ts AS DATE), DATE '{S.AS_OF_TEXT}')"
    b = f"floor(({ago} - {nearest}) / {width})"
    end = f"DATE '{S.AS_OF_TEXT}' - cast({nearest} + {b} * {width} AS INTEGER)"
    return f"""
matched AS (
  SELECT cast(c.c_custkey AS VARCHAR) AS imei_match, e.imei, e.mediadata, e.window_start, e.window_end
  FROM customer c JOIN (
    SELECT DISTINCT cast(user_id AS VARCHAR) AS imei, props AS mediadata,
      strftime({end} - {width - 1}, '%Y-%m-%d') AS window_start,
      strftime({end}, '%Y-%m-%d') AS window_end
    FROM events
    WHERE event_type = '{S.VIDEO_CHANNEL}' AND {DEVICE_RULE}
      AND {ago} >= {nearest} AND {ago} < {nearest + width * count}
  ) e ON cast(c.c_custkey AS VARCHAR) = e.imei
)"""


SQL["match_ids_1d"] = f"WITH {_matched_sql(1, 1, 10)} SELECT * FROM matched"
SQL["match_ids_2d"] = f"WITH {_matched_sql(2, 2, 8)} SELECT * FROM matched"

SQL["matched_score_profile"] = f"""
WITH {PAYLOAD_SCORES}, {_matched_sql(1, 1, 10)}
SELECT imei,
  {_avg_cols('s.')},
  'events' AS source, '{S.AS_OF_TEXT}' AS update_dt
FROM matched JOIN payload_scores s ON matched.mediadata = s.yktag GROUP BY imei
"""

ID_MAPPING = """
mapping AS (
  SELECT cast(o_custkey AS VARCHAR) AS idfa_imei, CASE WHEN o_orderstatus = 'F' THEN 'imei' ELSE 'idfa' END AS app_flag
  FROM orders
)"""

SQL["id_coverage"] = f"""
WITH {ID_MAPPING}
SELECT cast(c.c_custkey AS VARCHAR) AS imei_match, m.idfa_imei
FROM customer c LEFT JOIN (SELECT DISTINCT idfa_imei FROM mapping WHERE app_flag = 'imei') m
  ON cast(c.c_custkey AS VARCHAR) = m.idfa_imei
"""

SQL["id_coverage_md5"] = f"""
WITH {ID_MAPPING},
users AS (SELECT DISTINCT md5(cast(user_id AS VARCHAR)) AS userid FROM events),
app AS (SELECT idfa_imei, md5(cast(idfa_imei AS VARCHAR)) AS imeimd5 FROM mapping WHERE app_flag = 'imei')
SELECT u.userid, a.idfa_imei, a.imeimd5 FROM users u LEFT JOIN app a ON u.userid = a.imeimd5
WHERE length(a.imeimd5) = 32
"""


# --- evaluation ---

CLASSES = (("exposure", 0), ("click", 1))


def _ratio(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) = 0 THEN 0.0 ELSE cast({num} AS DOUBLE) / cast({den} AS DOUBLE) END"


def _f1(p: str, r: str) -> str:
    return f"CASE WHEN (({p}) + ({r})) = 0 THEN 0.0 ELSE 2.0 * ({p}) * ({r}) / (({p}) + ({r})) END"


def _report(pred: str, key: str) -> str:
    counts = ", ".join(
        f"sum(CASE WHEN y = {v} AND pred = {v} THEN 1 ELSE 0 END) AS tp_{n}, "
        f"sum(CASE WHEN pred = {v} THEN 1 ELSE 0 END) AS pp_{n}, "
        f"sum(CASE WHEN y = {v} THEN 1 ELSE 0 END) AS sup_{n}"
        for n, v in CLASSES)
    per_cols = []
    for n, _ in CLASSES:
        per_cols += [f"{_ratio(f'tp_{n}', f'pp_{n}')} AS p_{n}", f"{_ratio(f'tp_{n}', f'sup_{n}')} AS r_{n}"]
    names = [n for n, _ in CLASSES]
    rows = [f"SELECT {key}, '{n}' AS label, p_{n} AS precision, r_{n} AS recall, "
            f"{_f1(f'p_{n}', f'r_{n}')} AS f1_score, cast(sup_{n} AS BIGINT) AS support FROM per"
            for n in names]
    micro = _ratio(" + ".join(["0"] + [f"tp_{n}" for n in names]), "n")
    rows.append(f"SELECT {key}, 'microavg', {micro}, {micro}, {micro}, cast(n AS BIGINT) FROM per")

    def mean(kind: str) -> str:
        terms = [f"{kind}_{n}" if kind != "f" else _f1(f"p_{n}", f"r_{n}") for n in names]
        return "(" + " + ".join(["0.0"] + [f"({t})" for t in terms]) + f") / {float(len(names))}"

    def weighted(kind: str) -> str:
        terms = [(f"{kind}_{n}" if kind != "f" else _f1(f"p_{n}", f"r_{n}")) for n in names]
        total = " + ".join(["0.0"] + [f"({t}) * sup_{n}" for t, n in zip(terms, names)])
        return _ratio(total, "n")

    rows.append(f"SELECT {key}, 'macroavg', {mean('p')}, {mean('r')}, {mean('f')}, cast(n AS BIGINT) FROM per")
    rows.append(f"SELECT {key}, 'weightedavg', {weighted('p')}, {weighted('r')}, {weighted('f')}, "
                f"cast(n AS BIGINT) FROM per")
    return f"""
WITH pred AS ({pred}),
g AS (SELECT {key}, count(*) AS n, {counts} FROM pred GROUP BY {key}),
per AS (SELECT *, {', '.join(per_cols)} FROM g)
{' UNION ALL '.join(rows)}
"""


LABELS_PRED = "SELECT doc_id, quality AS y, 1 - toxic AS pred FROM labels"

SQL["class_report"] = _report(f"SELECT 0 AS field, y, pred FROM ({LABELS_PRED})", "field")
SQL["segment_report"] = _report(
    f"SELECT d.lang AS segment, l.y, l.pred FROM ({LABELS_PRED}) l JOIN documents d ON l.doc_id = d.doc_id",
    "segment")

_FEATURES = f"""
SELECT CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS y,
       cast(floor(value / 10.0) AS BIGINT) AS value, cast(hour(ts) AS BIGINT) AS hour,
       cast(props->>'$.{S.EVENT_JSON_KEY}' AS BIGINT) AS code, cast(isodow(ts) - 1 AS BIGINT) AS weekday,
       event_type
FROM events"""


def _scored() -> str:
    runs = []
    for r in range(S.FULL_RUN + 1):
        s = " + ".join(["0"] + [f"coalesce({f}, 0)" for i, f in enumerate(S.FEATURES) if i != r])
        runs.append(f"SELECT {r} AS field, weekday AS segment, y, ({s}) AS s FROM feats")
    return f"""
feats AS ({_FEATURES}),
runs AS ({' UNION ALL '.join(runs)}),
scored AS (
  SELECT field, segment, y, (cast(s AS DOUBLE) + 0.5) / (cast(s AS DOUBLE) + 100.5) AS p,
         CASE WHEN (cast(s AS DOUBLE) + 0.5) / (cast(s AS DOUBLE) + 100.5) >= 0.5 THEN 1 ELSE 0 END AS pred
  FROM runs
)"""


RUN_METRICS = f"""
{_scored()},
g AS (SELECT field, p, sum(y) AS pos, sum(1 - y) AS neg FROM scored
       WHERE p IS NOT NULL AND y IS NOT NULL GROUP BY field, p),
w AS (SELECT field, pos, neg,
        coalesce(sum(neg) OVER (PARTITION BY field ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
          AS below FROM g),
a AS (SELECT field, sum(cast(pos AS DOUBLE) * (cast(below AS DOUBLE) + neg / 2.0)) AS area,
        cast(sum(pos) AS BIGINT) AS n_pos, cast(sum(neg) AS BIGINT) AS n_neg FROM w GROUP BY field),
ll AS (SELECT field, avg(-(cast(y AS DOUBLE) * ln(least(greatest(p, 1e-15), 1.0 - 1e-15))
                        + (1.0 - cast(y AS DOUBLE)) * ln(1.0 - least(greatest(p, 1e-15), 1.0 - 1e-15))))
          AS logloss FROM scored WHERE p IS NOT NULL AND y IS NOT NULL GROUP BY field),
metrics AS (
  SELECT a.field, CASE WHEN n_pos = 0 OR n_neg = 0 THEN NULL
                       ELSE area / (cast(n_pos AS DOUBLE) * cast(n_neg AS DOUBLE)) END AS auc,
         round(ll.logloss, 9) AS logloss, n_pos, n_neg
  FROM a JOIN ll ON a.field = ll.field
)"""

SQL["run_report"] = "WITH " + _scored().strip() + "\n" + _report(
    "SELECT field, y, pred FROM scored", "field").replace("WITH pred", ", pred", 1)
SQL["auc_logloss"] = f"WITH {RUN_METRICS} SELECT * FROM metrics"
SQL["ablation_compare"] = f"""
WITH {RUN_METRICS}
SELECT m.field, m.auc, m.logloss, m.auc - b.auc AS delta_auc, m.logloss - b.logloss AS delta_logloss,
  CASE m.field {' '.join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(S.FEATURES))} ELSE 'none' END AS left_out
FROM metrics m, (SELECT auc, logloss FROM metrics WHERE field = {S.FULL_RUN}) b
"""
SQL["report_reshape"] = SQL["run_report"]

SQL["vocab_count"] = f"""
WITH feats AS ({_FEATURES}),
toks AS (
  SELECT DISTINCT tok FROM (
    SELECT unnest([{', '.join(f"'{f}:' || cast({f} AS VARCHAR)" for f in S.FEATURES)}, 'type:' || event_type]) AS tok
    FROM feats)
  WHERE tok IS NOT NULL AND length(tok) > 0
)
SELECT split_part(tok, ':', 1) AS namespace, count(*) AS n_values FROM toks GROUP BY 1
"""


SQL["month_publish"] = SQL["code_profile"].rstrip().replace(
    "'events' AS source, '" + S.AS_OF_TEXT + "' AS update_dt",
    "'events' AS source, '" + S.AS_OF_TEXT + "' AS update_dt, '2024-01' AS etl_month") + "\n"
SQL["day_publish"] = SQL["code_profile_day"]
SQL["append_publish"] = SQL["extract_payloads"]
SQL["month_from_day_states"] = SQL["code_profile"]
SQL["month_scores_from_day_states"] = SQL["score_profile"]
SQL["stream_day_profile"] = SQL["code_profile_day"]

SQL["stream_closed_days"] = f"""
WITH {EVENT_CODES_TAGGED}
SELECT userid, etl_dt,
  {_flags()},
  'events' AS source, '{S.AS_OF_TEXT}' AS update_dt
FROM tagged
WHERE cast(etl_dt AS DATE) + INTERVAL 2 DAY <= (SELECT date_trunc('second', max(ts)) FROM events)
GROUP BY userid, etl_dt
"""

SQL["id_coverage_counts"] = f"""
WITH cov AS ({SQL["id_coverage"]})
SELECT count(*) AS n_ids, count(idfa_imei) AS n_mapped, count(DISTINCT imei_match) AS n_distinct_ids FROM cov
"""

SQL["matched_payloads"] = f"""
WITH {PAYLOAD_SCORES}, {_matched_sql(1, 1, 10)}
SELECT m.imei AS userid, m.mediadata FROM matched m JOIN payload_scores s ON m.mediadata = s.yktag
"""

SQL["segment_auc"] = f"""
WITH {_scored()},
g AS (SELECT field, segment, p, sum(y) AS pos, sum(1 - y) AS neg FROM scored
       WHERE p IS NOT NULL AND y IS NOT NULL GROUP BY field, segment, p),
w AS (SELECT field, segment, pos, neg,
        coalesce(sum(neg) OVER (PARTITION BY field, segment ORDER BY p
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g),
a AS (SELECT field, segment, sum(cast(pos AS DOUBLE) * (cast(below AS DOUBLE) + neg / 2.0)) AS area,
        cast(sum(pos) AS BIGINT) AS n_pos, cast(sum(neg) AS BIGINT) AS n_neg FROM w GROUP BY field, segment),
ll AS (SELECT field, segment, avg(-(cast(y AS DOUBLE) * ln(least(greatest(p, 1e-15), 1.0 - 1e-15))
                        + (1.0 - cast(y AS DOUBLE)) * ln(1.0 - least(greatest(p, 1e-15), 1.0 - 1e-15))))
          AS logloss FROM scored WHERE p IS NOT NULL AND y IS NOT NULL GROUP BY field, segment)
SELECT a.field, a.segment, CASE WHEN n_pos = 0 OR n_neg = 0 THEN NULL
                       ELSE area / (cast(n_pos AS DOUBLE) * cast(n_neg AS DOUBLE)) END AS auc,
       round(ll.logloss, 9) AS logloss, n_pos, n_neg
FROM a JOIN ll ON a.field = ll.field AND a.segment = ll.segment
"""
SQL["stream_match_ids_1d"] = SQL["match_ids_1d"]

SQL["stream_score_profile_day"] = f"""
WITH {PAYLOAD_SCORES},
pairs AS (
  SELECT DISTINCT user_id AS userid, props AS mediadata, strftime(ts, '%Y-%m-%d') AS etl_dt FROM events
  WHERE event_type = '{S.VIDEO_CHANNEL}' AND {DEVICE_RULE}
)
SELECT userid, etl_dt,
  {_avg_cols('s.')},
  'events' AS source, '{S.AS_OF_TEXT}' AS update_dt
FROM pairs JOIN payload_scores s ON pairs.mediadata = s.yktag GROUP BY userid, etl_dt
"""
SQL["code_profile_exploded"] = SQL["code_profile"]


# --- stored inputs (plans/stored.py) ---

SQL["dict_file_profile"] = SQL["dict_profile"]
SQL["id_file_match"] = SQL["match_ids_1d"]
SQL["partitioned_log_profile"] = (
    f"SELECT * FROM ({SQL['code_profile_day']}) WHERE etl_dt BETWEEN '2024-01-10' AND '2024-01-20'")

_TOKENS = f"""SELECT tok AS iqytag, priority, {_score_cols('priority')} FROM (
  SELECT tok, min(p_partkey * 10 + pos) AS priority FROM (
    SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tok,
           generate_subscripts(string_split(p_name, ' '), 1) - 1 AS pos FROM part) GROUP BY tok)"""
SQL["title_file_match"] = "WITH " + _title_match(
    """SELECT '{"title":"' || p_name || '"}' AS t FROM part WHERE p_partkey % 7 <> 0 AND p_name <> ''""", _TOKENS)

SQL["multi_code_profile"] = f"""
WITH lists AS (SELECT user_id AS userid, cast(props->>'$.{S.EVENT_JSON_KEY}' AS BIGINT) AS k FROM events),
codes AS (
  SELECT userid, unnest([cast(k AS VARCHAR), cast(k * 7 % 100 AS VARCHAR), cast((k + 31) % 100 AS VARCHAR)]) AS code
  FROM lists WHERE k IS NOT NULL
),
tagged AS (
  SELECT userid, coalesce(CASE WHEN cast(code AS INTEGER) < {S.EVENT_MAPPED_CODES}
    THEN {_tag_case(f"cast(code AS INTEGER) % {S.EVENT_TAG_MODULUS}", INTERESTS[:S.EVENT_TAG_MODULUS])} END, '') AS tag
  FROM codes WHERE length(code) = {S.EVENT_CODE_LEN}
)
SELECT userid,
  {_flags()},
  'events' AS source, '{S.AS_OF_TEXT}' AS update_dt
FROM tagged GROUP BY userid
"""

SQL["id_coverage_plain"] = f"""
WITH {ID_MAPPING},
users AS (SELECT DISTINCT cast(user_id AS VARCHAR) AS userid FROM events),
app AS (SELECT idfa_imei, md5(idfa_imei) AS imeimd5 FROM mapping WHERE app_flag = 'imei')
SELECT u.userid, a.idfa_imei, a.imeimd5 FROM users u LEFT JOIN app a ON u.userid = a.idfa_imei
WHERE length(a.idfa_imei) = 3
"""

SQL["report_order"] = (f"SELECT *, row_number() OVER (ORDER BY label, field) AS position "
                       f"FROM ({SQL['run_report']})")

SQL["report_metrics"] = f"""
WITH {_scored()},
gappy AS (
  SELECT field, y, CASE WHEN field = 1 AND segment = 0 THEN NULL ELSE p END AS p FROM scored
  UNION ALL SELECT 9 AS field, y, p FROM scored WHERE field = 0 AND y = 1
),
known AS (SELECT * FROM gappy WHERE p IS NOT NULL AND y IS NOT NULL),
g AS (SELECT field, p, sum(y) AS pos, sum(1 - y) AS neg FROM known GROUP BY field, p),
w AS (SELECT field, pos, neg,
        coalesce(sum(neg) OVER (PARTITION BY field ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
          AS below FROM g),
a AS (SELECT field, sum(cast(pos AS DOUBLE) * (cast(below AS DOUBLE) + neg / 2.0)) AS area,
        sum(pos) AS n_pos, sum(neg) AS n_neg FROM w GROUP BY field),
ll AS (SELECT field, avg(-(cast(y AS DOUBLE) * ln(least(greatest(p, 1e-15), 1.0 - 1e-15))
                        + (1.0 - cast(y AS DOUBLE)) * ln(1.0 - least(greatest(p, 1e-15), 1.0 - 1e-15))))
          AS logloss FROM known GROUP BY field)
SELECT a.field, CASE WHEN n_pos > 0 AND n_neg > 0
                     THEN area / (cast(n_pos AS DOUBLE) * cast(n_neg AS DOUBLE)) END AS auc,
       round(ll.logloss, 9) AS logloss
FROM a JOIN ll ON a.field = ll.field
"""

SQL["month_score_profile"] = f"""
WITH {PAYLOAD_SCORES},
pairs AS (
  SELECT DISTINCT cast(user_id AS VARCHAR) AS userid, props AS mediadata FROM events
  WHERE event_type = '{S.VIDEO_CHANNEL}' AND {DEVICE_RULE}
    AND cast(ts AS DATE) + cast(user_id % 2 * 31 AS INTEGER) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
)
SELECT userid,
  {_avg_cols('s.')},
  'events' AS source, '{S.AS_OF_TEXT}' AS update_dt, '2024-01' AS etl_month
FROM pairs JOIN payload_scores s ON pairs.mediadata = s.yktag GROUP BY userid
"""
