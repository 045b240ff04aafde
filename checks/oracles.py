"""Reference SQL (DuckDB) for the registered queries, over the same tables.

Written independently of the library: the transactions are derived from the tables in SQL, and
every rule is spelled out in SQL. Only the lookup tables and thresholds are shared.
"""

from __future__ import annotations

from cardtide.functions import fixed

from . import rules

_TABLE_CODES = "5812,5541,5411,4784,4900,5942,5814,4829,5311,9999,bad"
_LOCATIONS = "CA,NY,TX,FL,WA,OH,IL,GA,PA,MI,NC,NJ,VA,AZ,MA,TN,CO,MN,OR,DC,Canada,Mexico,Italy,,N/A"

# The 12 transaction columns, plus line number and part remainder for the dirty lines.
_TXN = f"""
j AS (
 SELECT l.*, o.o_custkey, o.o_orderkey, s.s_nationkey,
        cast(round(l.l_extendedprice*100) AS bigint) % 60000 AS c,
        split_part('{_LOCATIONS}', ',', s.s_nationkey+1) AS st
 FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN supplier s ON l.l_suppkey=s.s_suppkey),
txn AS (
SELECT cast(l_orderkey*10+l_linenumber AS string) AS id,
  concat(cast(cast(l_shipdate AS date) AS string),' ',lpad(cast((l_orderkey*7+l_linenumber*5)%24 AS string),2,'0'),':',lpad(cast((l_partkey*13)%60 AS string),2,'0'),':00') AS date,
  cast(o_custkey AS string) AS client_id,
  cast(o_custkey*10+o_orderkey%(1+o_custkey%5) AS string) AS card_id,
  concat('$',CASE WHEN l_returnflag='R' AND l_linenumber%5=0 THEN '-' ELSE '' END,cast(cast(floor(c/100) AS bigint) AS string),'.',lpad(cast(c%100 AS string),2,'0')) AS amount,
  CASE WHEN st='' THEN 'Online Transaction' WHEN l_linestatus='O' THEN 'Chip Transaction' ELSE 'Swipe Transaction' END AS use_chip,
  cast(l_suppkey AS string) AS merchant_id,
  CASE WHEN st='' THEN 'ONLINE' ELSE concat('City ',cast(l_suppkey%7 AS string)) END AS merchant_city,
  st AS merchant_state, cast(l_suppkey%1000 AS string) AS zip,
  split_part('{_TABLE_CODES}', ',', cast(l_partkey%11+1 AS int)) AS mcc,
  CASE WHEN l_returnflag='R' AND l_partkey%4=0 THEN 'Insufficient Balance' WHEN l_returnflag='A' AND l_partkey%29=0 THEN 'Bad PIN,Technical Glitch' ELSE '' END AS errors,
  l_linenumber AS ln, l_partkey % 10 AS pk
FROM j)"""

# The same columns after the dirt of the raw lines; `kind` tells what happened to the line.
_NOISY = _TXN + """,
noisy AS (
SELECT CASE WHEN ln=6 AND pk=0 THEN 'header' WHEN ln=6 AND pk=1 THEN 'short' WHEN ln=6 AND pk=2 THEN 'extra' ELSE 'plain' END AS kind,
  ln, pk, id,
  CASE WHEN ln=4 AND pk=3 THEN '2001-02-30 18:00:00' WHEN ln=4 AND pk=4 THEN 'soon' WHEN ln=4 AND pk=5 THEN concat(date,'.0') WHEN ln=4 AND pk=6 THEN concat(date,'Z') ELSE date END AS date,
  CASE WHEN ln=2 AND pk=0 THEN 'NULL' WHEN ln=2 AND pk=1 THEN ' ' ELSE client_id END AS client_id,
  card_id,
  CASE WHEN ln=1 AND pk=0 THEN 'abc' WHEN ln=1 AND pk=1 THEN '$1,234.56' WHEN ln=1 AND pk=2 THEN '' ELSE amount END AS amount,
  CASE WHEN ln=4 AND pk=0 THEN 'y' WHEN ln=4 AND pk=1 THEN '0' WHEN ln=4 AND pk=2 THEN 'tap' ELSE use_chip END AS use_chip,
  merchant_id,
  CASE WHEN ln=3 AND pk=0 THEN 'n/a' WHEN ln=3 AND pk=1 THEN '' ELSE merchant_city END AS merchant_city,
  CASE WHEN ln=3 AND pk=2 THEN 'pr' WHEN ln=3 AND pk=3 THEN 'online' ELSE merchant_state END AS merchant_state,
  zip, mcc,
  CASE WHEN ln=5 AND pk=0 THEN 'N/A' WHEN ln=5 AND pk=1 THEN 'no_error' ELSE errors END AS errors
FROM txn)"""

_COLUMNS = ", ".join(fixed.COLUMNS)
_US = "(" + ",".join(f"'{s}'" for s in fixed.US_STATES) + ")"
_MISSING = "('','NULL','N/A')"

# What each dialect makes of the dirty lines.
_TOGGLED = _NOISY + f", src AS (SELECT {_COLUMNS} FROM noisy WHERE kind IN ('plain','extra'))"
_EVEN = _NOISY + """, src AS (SELECT id, date, client_id, card_id,
  CASE WHEN amount LIKE '%,%' THEN concat('"',amount,'"') ELSE amount END AS amount,
  use_chip, merchant_id, merchant_city, merchant_state, zip, mcc,
  CASE WHEN errors LIKE '%,%' THEN concat('"',errors,'"') ELSE errors END AS errors
  FROM noisy WHERE kind IN ('plain','extra'))"""
_NAIVE = _NOISY + """, src AS (
  SELECT id, date, client_id, card_id, amount, use_chip, merchant_id, merchant_city, merchant_state, zip, mcc,
    CASE WHEN errors LIKE '%,%' THEN concat('"',split_part(errors,',',1)) ELSE errors END AS errors
  FROM noisy WHERE kind IN ('plain','extra') AND amount NOT LIKE '%,%'
  UNION ALL
  SELECT id, date, client_id, card_id, '"$1', '234.56"', use_chip, merchant_id, merchant_city, merchant_state, zip, mcc
  FROM noisy WHERE kind IN ('plain','extra') AND amount LIKE '%,%')"""
_PLAIN = _TXN + f", src AS (SELECT {_COLUMNS} FROM txn)"


def _cleaned(source: str) -> str:
    """CTE chain ending in `t`: the source columns and every cleaned value."""
    return source + f""",
q AS (SELECT *, trim(replace(client_id,'"','')) AS cl, upper(trim(merchant_city)) AS uc, upper(trim(merchant_state)) AS us,
   trim(mcc) AS um, upper(trim(use_chip)) AS uu, replace(trim(errors),'"','') AS ee,
   try_cast(replace(replace(replace(trim(amount),'"',''),'$',''),',','') AS decimal(18,4)) AS dollars FROM src),
t AS (SELECT *,
   CASE WHEN uc IN {_MISSING} THEN 'UNKNOWN' ELSE uc END AS city,
   CASE WHEN cl IN {_MISSING} THEN NULL ELSE cl END AS client,
   CASE WHEN us IN {_US} OR us='ONLINE' THEN us WHEN us IN {_MISSING} AND uc='ONLINE' THEN 'ONLINE' ELSE 'UNKNOWN' END AS state5,
   CASE WHEN us IN {_US} THEN us END AS state,
   CASE WHEN us NOT IN {_US} AND us NOT IN {_MISSING} THEN us END AS country,
   CASE WHEN us='' THEN 'UNKNOWN' ELSE us END AS state_u,
   CASE WHEN uc='' THEN 'UNKNOWN' ELSE uc END AS city_u,
   CASE WHEN um IN {_MISSING} THEN 'UNKNOWN_MCC' ELSE upper(um) END AS mcc_l,
   CASE WHEN regexp_full_match(um,'[0-9]+') THEN um END AS mcc_s,
   CASE WHEN uu LIKE '%TRANSACTION%' THEN concat(uu[1],lower(uu[2:position(' ' IN uu)]),'Transaction')
        WHEN uu IN ('Y','YES','TRUE','1') THEN 'Chip Transaction' WHEN uu IN ('N','NO','FALSE','0') THEN 'Swipe Transaction'
        WHEN uu='ONLINE' THEN 'Online Transaction' WHEN uu='CONTACTLESS' THEN 'Contactless Transaction'
        WHEN uu IN {_MISSING} THEN 'Unknown Transaction' ELSE concat(uu[1],lower(uu[2:]),' Transaction') END AS txn_type,
   CASE WHEN hh BETWEEN 0 AND 11 THEN 'MORNING' WHEN hh BETWEEN 12 AND 17 THEN 'AFTERNOON' WHEN hh BETWEEN 18 AND 23 THEN 'NIGHT' END AS period,
   cast(round(dollars*100) AS bigint) AS cents,
   CASE WHEN amount LIKE '%"%' THEN NULL ELSE try_cast(replace(trim(amount),'$','') AS double) END AS amt,
   try_cast(CASE WHEN regexp_full_match(date,'[0-9]+-[0-9]+-[0-9]+ [0-9:]+') THEN date END AS timestamp) AS ts,
   make_timestamp(d6[1],1,1,0,0,0.0)+to_months(d6[2]-1)+to_days(d6[3]-1)+to_hours(d6[4])+to_minutes(d6[5])+to_seconds(d6[6]) AS ts_k,
   ee<>'' AND upper(trim(ee))<>'NO_ERROR' AS err_m, trim(errors)<>'' AS err_c,
   upper(trim(ee)) NOT IN ('','NONE','N/A') AS err_r, trim(errors) NOT IN ('','N/A') AND lower(trim(errors))<>'null' AS err_k,
   uu='ONLINE TRANSACTION' AS on_c, uu IN ('ONLINE TRANSACTION','ONLINE') AS on_m, contains(use_chip,'Online') AS on_k
   FROM (SELECT *, try_cast(split_part(split_part(trim(date),' ',2),':',1) AS int) AS hh,
     [try_cast(nullif(part,'') AS int) FOR part IN regexp_extract_all(regexp_extract(date,'^[0-9]+-[0-9]+-[0-9]+ [0-9]+:[0-9]+:[0-9]+'),'[0-9]+')] AS d6 FROM q))"""


_T = _cleaned(_PLAIN)
_TL = _cleaned(_TOGGLED)
_TE = _cleaned(_EVEN)
_TN = _cleaned(_NAIVE)


def _values(rows: list[tuple[str, ...]], names: str) -> str:
    quoted = ("(" + ",".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)
    return f"(VALUES {','.join(quoted)}) AS v({names})"


_MCC_ROWS = fixed.MCC_TABLE
_LONG = _values([(r[0], r[1]) for r in _MCC_ROWS if r[1]], "code,label")
_SHORT = _values([(r[0], r[2]) for r in _MCC_ROWS], "code,label")
_STATES = _values(fixed.STATE_TABLE, "code,name,region")


def _pct(x: str, total: str) -> str:
    return f"(CASE WHEN {total}>0 THEN {x}*100.0::DOUBLE/{total} ELSE 0.0::DOUBLE END)"


def _pct2(x: str, total: str) -> str:
    """Share with two decimals as text, halves up."""
    h = f"((20000*{x}+{total})//(2*{total}))"
    return f"concat({h}//100,'.',lpad(cast({h}%100 AS string),2,'0'),'%')"


def _money(cents: str, thousands: bool = False) -> str:
    whole = f"format('{{:,}}',abs({cents})//100)" if thousands else f"(abs({cents})//100)"
    return f"concat(CASE WHEN {cents}<0 THEN '-' ELSE '' END,{whole},'.',lpad(cast(abs({cents})%100 AS string),2,'0'))"


def _sel(chain: str, body: str) -> str:
    return f"WITH {chain}\n{body}"


# --- totals -----------------------------------------------------------------------------------

def _amount(chain: str, key: str, name: str) -> str:
    return (f"{chain}, agg AS (SELECT {key} AS {name}, count(*) AS tx, cast(sum(cents) AS bigint) AS total_cents, "
            f"cast(sum(cents) AS bigint)/100.0::DOUBLE AS total FROM t WHERE cents IS NOT NULL AND {key} IS NOT NULL GROUP BY 1)")


_BY_CITY = _amount(_T, "city", "city")
_BY_CLIENT = _amount(_T, "client", "client_id")
_BY_TYPE = _T + ", agg AS (SELECT txn_type, count(*) AS tx FROM t GROUP BY 1)"
_BY_MCC = _T + ", agg AS (SELECT mcc_l AS mcc, count(*) AS errors FROM t WHERE err_m GROUP BY 1)"
_BY_STATE = _T + ", agg AS (SELECT state5 AS state, count(*) AS tx FROM t GROUP BY 1)"
_CITY_STATS = _BY_CITY + ", st AS (SELECT city, tx, total_cents, total_cents//tx AS avg_cents FROM agg)"


def _peak(m: str, a: str, n: str) -> str:
    return f"CASE WHEN {m}>={a} AND {m}>={n} THEN 'Manhã' WHEN {a}>={n} THEN 'Tarde' ELSE 'Noite' END"


_PERIODS = _T + f""", pc AS (SELECT city, count(*) FILTER (period='MORNING') AS morning, count(*) FILTER (period='AFTERNOON') AS afternoon,
  count(*) FILTER (period='NIGHT') AS night, count(*) AS total FROM t WHERE period IS NOT NULL GROUP BY 1),
ctp AS (SELECT *, {_pct('morning','total')} AS morning_pct, {_pct('afternoon','total')} AS afternoon_pct, {_pct('night','total')} AS night_pct,
  {_peak('morning','afternoon','night')} AS peak, {_peak('-morning','-afternoon','-night')} AS lowest FROM pc)"""


# --- categories -------------------------------------------------------------------------------

def _cat(by: str) -> str:
    return _T + f", cc AS (SELECT {by}, mcc_s AS mcc, count(*) AS tx FROM t WHERE {by} IS NOT NULL AND mcc_s IS NOT NULL GROUP BY 1,2)"


_CITY_PERIOD = _T + ", cc AS (SELECT city, period, mcc_s AS mcc, count(*) AS tx FROM t WHERE period IS NOT NULL AND mcc_s IS NOT NULL GROUP BY 1,2,3)"


def _top(chain: str, keys: str) -> str:
    return chain + f""", top AS (SELECT {keys}, cast(rank AS int) AS rank, mcc, coalesce(label,'MCC-'||mcc) AS label, tx
  FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY tx DESC, mcc) AS rank FROM cc)
  LEFT JOIN {_SHORT} ON code=mcc WHERE rank<=3)"""


_TOP_TEXT = "string_agg(concat('Top-',rank,': ',mcc,' (',label,') ',tx),' | ' ORDER BY rank)"
_PERIOD_ORDER = "CASE period WHEN 'MORNING' THEN 1 WHEN 'AFTERNOON' THEN 2 ELSE 3 END"
_PERIOD_LABEL = "concat(city,' [',CASE period WHEN 'MORNING' THEN 'Manhã' WHEN 'AFTERNOON' THEN 'Tarde' ELSE 'Noite' END,']')"


def _category(code: str, table: dict[str, str], variant: str) -> str:
    whens = " ".join(f"WHEN {code} LIKE '{d}%' THEN '{label}'" for d, label in table.items())
    return f"CASE {whens} ELSE '{fixed.MCC_CATEGORY_OTHER[variant][0]}' END"


def _cause(code: str) -> str:
    whens = [f"WHEN {code}='{c}' THEN '{text}'" for c, text in fixed.ERROR_CAUSE_BY_CODE.items()]
    whens += [f"WHEN {code} LIKE '{p}%' THEN '{text}'" for p, text in fixed.ERROR_CAUSE_BY_PREFIX.items()]
    return f"CASE {' '.join(whens)} ELSE '{fixed.ERROR_CAUSE_DEFAULT}' END"


# --- profiles ---------------------------------------------------------------------------------

def _mode(owner: str, c: str, out: str) -> str:
    return (f"m_{out} AS (SELECT {owner}, {c} AS {out} FROM (SELECT {owner}, {c}, row_number() OVER "
            f"(PARTITION BY {owner} ORDER BY count(*) DESC, {c}) AS rn FROM v GROUP BY {owner}, {c}) WHERE rn=1)")


def _single(x: float) -> str:
    return f"{x}::FLOAT::DOUBLE"


_CLIENTS = _T + f""", v AS (SELECT *, trim(client_id) AS cid FROM t WHERE cents IS NOT NULL AND trim(client_id)<>''),
{_mode('cid','state_u','state')}, {_mode('cid','city_u','city')},
profile AS (SELECT cid AS client_id, tx, online, errors, sum_cents, greatest(mx,0) AS max_cents, state, city,
   online::DOUBLE/tx AS online_rate, errors::DOUBLE/tx AS error_rate, sum_cents//tx AS avg_cents
 FROM (SELECT cid, count(*) AS tx, count(*) FILTER (on_c) AS online, count(*) FILTER (err_c) AS errors,
   cast(sum(cents) AS bigint) AS sum_cents, max(cents) AS mx FROM v GROUP BY 1) JOIN m_state USING (cid) JOIN m_city USING (cid))"""
_C = rules.CLIENT
_CLIENTS_C = _CLIENTS + f""", classed AS (SELECT *, CASE
  WHEN (error_rate>={_single(_C.error_high)} AND online_rate>={_single(_C.online_med)}) OR online_rate>={_single(_C.online_high)}
    OR avg_cents>={_C.avg_high_cents} OR max_cents>={_C.max_high_cents} THEN 'HIGH'
  WHEN error_rate>={_single(_C.error_med)} OR online_rate>={_single(_C.online_med)} THEN 'MED' ELSE 'LOW' END AS risk FROM profile)"""

_MERCHANTS = _T + f""", v AS (SELECT *, upper(trim(merchant_id)) AS mid FROM t WHERE cents IS NOT NULL AND trim(merchant_id)<>''),
{_mode('mid','us','state')}, {_mode('mid','uc','city')},
profile AS (SELECT mid AS merchant_id, tx, sum_cents, greatest(mx,0) AS max_cents, errors, online, state, city,
   errors::DOUBLE/tx AS error_rate, online::DOUBLE/tx AS online_rate, sum_cents//tx AS avg_cents
 FROM (SELECT mid, count(*) AS tx, cast(sum(cents) AS bigint) AS sum_cents, max(cents) AS mx,
   count(*) FILTER (err_r) AS errors, count(*) FILTER (on_m) AS online FROM v GROUP BY 1)
 JOIN m_state USING (mid) JOIN m_city USING (mid) WHERE state<>'')"""
_M = rules.MERCHANT
_HEALTH = f"""CASE WHEN sum_cents>={_M.revenue_high_cents} THEN 'A' WHEN sum_cents>={_M.revenue_med_cents}
  OR (tx>={_M.tx_min_for_avg} AND avg_cents>={_M.avg_med_cents}) THEN 'B' ELSE 'C' END AS health"""
_MRISK = f"""CASE WHEN error_rate>={_single(_M.error_high)} OR online_rate>={_single(_M.online_high)} OR max_cents>={_M.max_high_cents} THEN 'HIGH'
  WHEN error_rate>={_single(_M.error_med)} OR online_rate>={_single(_M.online_med)} THEN 'MED' ELSE 'LOW' END AS risk"""
_MERCHANTS_C = _MERCHANTS + f", classed AS (SELECT *, {_HEALTH}, {_MRISK} FROM profile)"

_R = rules.RFM
_RFM = _T + f""", v AS (SELECT *, trim(client_id) AS cid FROM t WHERE cents IS NOT NULL AND ts IS NOT NULL AND trim(client_id)<>''),
{_mode('cid','state_u','state')}, {_mode('cid','city_u','city')},
profile AS (SELECT cid AS client_id, strftime(last,'%Y-%m-%d %H:%M:%S') AS last_ts, tx AS frequency, sum_cents//tx AS avg_cents,
   cast(greatest(date_diff('day', cast(last AS date), DATE '{_R.reference_date}'),0) AS int) AS recency_days, state, city
 FROM (SELECT cid, count(*) AS tx, cast(sum(cents) AS bigint) AS sum_cents, max(ts) AS last FROM v GROUP BY 1)
 JOIN m_state USING (cid) JOIN m_city USING (cid))"""
_RFM_C = _RFM + f""", classed AS (SELECT *, CASE
  WHEN recency_days<={_R.recency_high_days} AND (frequency>={_R.frequency_high} OR avg_cents>={_R.monetary_high_cents}) THEN 'HIGH'
  WHEN recency_days<={_R.recency_med_days} OR frequency>={_R.frequency_med} OR avg_cents>={_R.monetary_med_cents} THEN 'MED' ELSE 'LOW' END AS bucket FROM profile)"""


def _spots(chain: str, bucket: str, k: int, out: str) -> str:
    return chain + f""", spots AS (SELECT state, cast(rank AS int) AS rank, city, {out} FROM (
  SELECT state, city, count(*) AS {out}, row_number() OVER (PARTITION BY state ORDER BY count(*) DESC, city) AS rank
  FROM classed WHERE {bucket}='HIGH' AND city<>'' GROUP BY 1,2) WHERE rank<={k})"""


def _buckets(bucket: str) -> str:
    return ", ".join(f"count(*) FILTER ({bucket}='{b}') AS {b.lower()}" for b in ("LOW", "MED", "HIGH"))


def _client_rollup(chain: str, bucket: str, k: int) -> str:
    return _spots(chain, bucket, k, "clients") + f""",
roll AS (SELECT state, count(*) AS total, {_buckets(bucket)} FROM classed GROUP BY 1)"""


def _spot_text(pattern: str) -> str:
    return f"coalesce((SELECT string_agg({pattern},' | ' ORDER BY rank) FROM spots WHERE spots.state=roll.state),'')"


_LMH = ", ".join(f"{_pct(n, 'total')} AS {n}_pct" for n in ("low", "med", "high"))
_CLIENT_STATE = _client_rollup(_CLIENTS_C, "risk", 5)
_RFM_STATE = _client_rollup(_RFM_C, "bucket", _R.top_cities)
_LMH_TEXT = ",".join(
    f"' | {n.title()}: ',{n},' (',{_pct2(n, 'total')},')'" for n in ("low", "med", "high"))

_LEADERS = _MERCHANTS_C + f""", leaders AS (SELECT state, cast(rank AS int) AS rank, merchant_id, sum_cents, health, risk FROM (
  SELECT *, row_number() OVER (PARTITION BY state ORDER BY sum_cents DESC, merchant_id) AS rank FROM classed) WHERE rank<={_M.top_merchants})"""
_MNAMES = ("health_a", "health_b", "health_c", "risk_low", "risk_med", "risk_high")
_MERCHANT_STATE = _spots(_LEADERS, "risk", 5, "merchants") + f""",
roll AS (SELECT state, count(*) AS total, {', '.join(f"count(*) FILTER (health='{h}') AS health_{h.lower()}" for h in 'ABC')},
  {', '.join(f"count(*) FILTER (risk='{r}') AS risk_{r.lower()}" for r in ('LOW', 'MED', 'HIGH'))}
  FROM classed GROUP BY 1 HAVING count(*)>={_M.min_state_merchants})"""


def _leader_text(pattern: str) -> str:
    return f"(SELECT string_agg({pattern},' | ' ORDER BY rank) FROM leaders WHERE leaders.state=roll.state)"


# --- scored risk ------------------------------------------------------------------------------

def _risk(chain: str) -> str:
    """CTEs `rp` (profile, also of blank clients), `scored` (score and factors) and `risks`."""
    rate1 = "((2000*errors+tx)//(2*tx))"
    rate0 = "((200*online+tx)//(2*tx))"
    tenth = f"concat({rate1}//10,'.',{rate1}%10)"
    avg2 = "concat(avg_c//100,'.',lpad(cast(avg_c%100 AS string),2,'0'))"
    factors = [
        ("cities>5", 15, "concat('HIGH_MOBILITY[',cities,'_cities]')", "cities>3", 8, "concat('MEDIUM_MOBILITY[',cities,'_cities]')"),
        ("mccs>10", 12, "concat('DIVERSE_MCC[',mccs,'_categories]')", "mccs>6", 6, "concat('VARIED_MCC[',mccs,'_categories]')"),
        ("cards>3", 20, "concat('MULTIPLE_CARDS[',cards,'_cards]')", "cards>1", 8, "concat('DUAL_CARDS[',cards,'_cards]')"),
        ("tx>0 AND errors*5>tx", 25, f"concat('HIGH_ERROR_RATE[',{tenth},'%]')", "tx>0 AND errors*10>tx", 12, f"concat('MEDIUM_ERROR_RATE[',{tenth},'%]')"),
        ("chargebacks>3", 25, "concat('FREQUENT_CHARGEBACKS[',chargebacks,']')", "chargebacks>0", 10, "concat('CHARGEBACKS[',chargebacks,']')"),
        ("avg_c>50000", 15, f"concat('HIGH_AVG_AMOUNT[',{avg2},']')", "avg_c>20000", 7, f"concat('MEDIUM_AVG_AMOUNT[',{avg2},']')"),
        ("tx>0 AND (online*5>tx*4 OR online*5<tx)", 10, f"concat('UNBALANCED_CHANNELS[',{rate0},'%_online]')", "false", 0, "''"),
    ]
    points = "+".join(f"CASE WHEN {a} THEN {p} WHEN {b} THEN {q} ELSE 0 END" for a, p, _, b, q, _ in factors)
    texts = ",".join(f"CASE WHEN {a} THEN {x} WHEN {b} THEN {y} END" for a, _, x, b, _, y in factors)
    return chain + f""",
ok AS (SELECT trim(client_id) AS cid, ts_k IS NOT NULL AND amt IS NOT NULL AS valid, * FROM t),
rc AS (SELECT cid AS client_id, count(*) AS n, count(*) FILTER (valid) AS tx,
   coalesce(cast(sum(cast(round(abs(amt)*100) AS bigint)) FILTER (valid) AS bigint),0) AS tc,
   count(DISTINCT trim(merchant_city)) FILTER (valid AND trim(merchant_city) NOT IN ('','ONLINE')) AS cities,
   count(DISTINCT um) FILTER (valid AND um<>'') AS mccs, count(DISTINCT trim(card_id)) FILTER (valid) AS cards,
   epoch_ms(min(ts_k) FILTER (valid)) AS first_ts, epoch_ms(max(ts_k) FILTER (valid)) AS last_ts,
   count(*) FILTER (valid AND on_k) AS online, count(*) FILTER (valid AND NOT on_k) AS swipe,
   count(*) FILTER (valid AND err_k) AS errors, count(*) FILTER (valid AND amt<0) AS chargebacks FROM ok GROUP BY 1),
rp AS (SELECT *, CASE WHEN tx>0 THEN (2*tc+tx)//(2*tx) ELSE 0 END AS avg_c, tc/100.0::DOUBLE AS total FROM rc),
scored AS (SELECT *, {points} AS score, concat_ws('; ',{texts}) AS ft FROM rp),
risks AS (SELECT client_id, CASE WHEN score>=86 THEN 'CRITICAL' WHEN score>=61 THEN 'HIGH' WHEN score>=31 THEN 'MEDIUM' ELSE 'LOW' END AS category,
   score, CASE WHEN ft='' THEN 'NORMAL_BEHAVIOR' ELSE ft END AS factors, tx, total, tc, n FROM scored WHERE client_id<>'')"""


_RISK = _risk(_T)
_PROFILE_COLUMNS = "client_id, tx, total, avg_c/100.0::DOUBLE AS avg, cities, mccs, cards, first_ts, last_ts, online, swipe, errors, chargebacks"
_RISK_COLUMNS = "client_id, category, cast(score AS int) AS score, factors, tx, total"
_TOP_RISK = _RISK + """, lead AS (SELECT category, cast(rank AS int) AS rank, client_id, score, tx, total, tc, factors FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY score DESC, client_id) AS rank FROM risks) WHERE rank<=10),
rep AS (SELECT category, count(*) AS clients, cast(sum(score) AS bigint)/count(*) AS avg_score,
  cast(sum(score) AS bigint) AS score_sum, cast(sum(tc) AS bigint) AS cents, cast(sum(tx) AS bigint) AS tx_sum,
  cast(sum(tc) AS bigint)/100.0::DOUBLE AS total_amount, cast(sum(tc) AS bigint)/100.0::DOUBLE/count(*) AS avg_amount,
  cast(sum(tx) AS bigint)/count(*) AS avg_tx FROM risks GROUP BY 1)"""


def _half_up(x: str, n: str, scale: int) -> str:
    """x/n rounded half up, as text with as many decimals as the scale has zeros."""
    h = f"((2*{scale}*{x}+{n})//(2*{n}))"
    places = len(str(scale)) - 1
    return f"concat({h}//{scale},'.',lpad(cast({h}%{scale} AS string),{places},'0'))"


_RISK_ENTRY = ("concat(rank,'. Client ',client_id,' (Score: ',score,'.00, Transactions: ',tx,', Amount: $',"
               f"{_money('tc')},')\n   Factors: ',factors,'\n')")
_RISK_BLOCK = f"""concat('\n========== RISK CATEGORY: ',category,' ==========\nTotal Clients: ',clients,
'\nAverage Risk Score: ',{_half_up('score_sum', 'clients', 100)},'\nTotal Amount: $',{_money('cents')},
'\nAverage Amount per Client: $',{_half_up('cents', '(100*clients)', 100)},'\nAverage Transactions per Client: ',{_half_up('tx_sum', 'clients', 10)},
'\n\n--- TOP 10 HIGHEST RISK CLIENTS ---\n',(SELECT string_agg({_RISK_ENTRY},'' ORDER BY rank) FROM lead WHERE lead.category=rep.category),
'========================================\n')"""


# --- summaries --------------------------------------------------------------------------------

def _hi(key: str, value: str, src: str, test: str = "true", floor: int = 0) -> str:
    return f"(SELECT {key} FROM {src} WHERE {value}>{floor} AND {test} ORDER BY {value} DESC, {key} LIMIT 1)"


def _hiv(value: str, src: str, test: str = "true", floor: int = 0, zero: str = "0") -> str:
    return f"coalesce((SELECT max({value}) FROM {src} WHERE {value}>{floor} AND {test}),{zero})"


def _lo(key: str, value: str, src: str, test: str = "true") -> str:
    return f"(SELECT {key} FROM {src} WHERE {test} ORDER BY {value}, {key} LIMIT 1)"


def _lov(value: str, src: str, test: str = "true") -> str:
    return f"(SELECT min({value}) FROM {src} WHERE {test})"


def _ends(key: str, value: str, high: str, low: str, src: str = "agg") -> str:
    return (f"{_hi(key, value, src)} AS {high}_{key}, {_hiv(value, src)} AS {high}_{value}, "
            f"{_lo(key, value, src)} AS {low}_{key}, {_lov(value, src)} AS {low}_{value}")


def _long(code: str) -> str:
    return f"coalesce((SELECT label FROM {_LONG} WHERE code={code}),'Unknown MCC Code: '||{code})"


def _state_name(code: str) -> str:
    return (f"coalesce((SELECT name FROM {_STATES} WHERE code={code}),"
            f"CASE WHEN length({code})=2 THEN 'Unknown State: '||{code} ELSE 'Unknown State' END)")


def _diversity(by: str) -> str:
    high, mid = (15, 8) if by == "country" else (20, 10)
    chain = _cat(by) + f", g AS (SELECT {by}, count(*) AS categories FROM cc GROUP BY 1)"
    return _sel(chain, f"""SELECT *, CASE WHEN avg_categories>{high} THEN 'high' WHEN avg_categories>{mid} THEN 'moderate' ELSE 'low' END AS diversity FROM (
SELECT count(*) AS places, cast(sum(categories) AS bigint) AS total_categories, {_hi(by, 'categories', 'g', floor=4)} AS most_diverse,
 {_hiv('categories', 'g', floor=4)} AS most_categories, {_lo(by, 'categories', 'g')} AS least_diverse, {_lov('categories', 'g')} AS least_categories,
 cast(sum(categories) AS bigint)::DOUBLE/count(*) AS avg_categories FROM g)""")


_PN = ("morning", "afternoon", "night")
_IMBALANCE = "+".join(f"({n}-total/3.0::DOUBLE)*({n}-total/3.0::DOUBLE)" for n in _PN)


# --- quality ----------------------------------------------------------------------------------

def _quality(chain: str, tests: dict[str, str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS analysis, (SELECT count(*) FROM t WHERE {test}) AS valid" for name, test in tests.items())
    return _sel(chain, f"""SELECT analysis, read, header, valid, read-header-valid AS invalid, {_pct('valid', 'read')} AS success_pct
FROM ({rows}), (SELECT count(*) AS read, count(*) FILTER (kind='header') AS header FROM noisy)""")


def _period_quality(test: str) -> str:
    counts = ", ".join(f"(SELECT count(*) FROM t WHERE period='{n.upper()}' AND {test}) AS {n}" for n in _PN)
    return _sel(_TL, f"""SELECT *, {', '.join(f"{_pct(n, 'valid')} AS {n}_pct" for n in _PN)} FROM (
SELECT (SELECT count(*) FROM noisy) AS read, (SELECT count(*) FROM t WHERE period IS NOT NULL AND {test}) AS valid, {counts})""")


_CATEGORY_COUNTS = ", ".join(
    f"(SELECT count(*) FROM risks WHERE category='{c}') AS category_{c.lower()}" for c, *_ in fixed.RISK_CATEGORIES)

ORACLES: dict[str, str] = {
    "scan_toggle": _sel(_TOGGLED, "SELECT * FROM src"),
    "scan_even_quotes": _sel(_EVEN, "SELECT * FROM src"),
    "scan_naive": _sel(_NAIVE, "SELECT * FROM src"),
    "clean_places": _sel(_TL, """SELECT city, state5 AS state, coalesce(state,'-') AS us_state, coalesce(country,'-') AS country,
 state_u AS state_or_unknown, us AS state_or_empty, count(*) AS n FROM t GROUP BY ALL"""),
    "clean_channels": _sel(_TL, """SELECT txn_type, lower(uu) IN ('1','true','t','y','yes') AS truthy, on_c AS online_phrase, on_m AS online_phrase_or_word, on_k AS online_contains,
 err_m AS error_no_error, err_c AS error_any_text, err_r AS error_none_na, err_k AS error_null_na, mcc_l AS mcc_lenient, coalesce(mcc_s,'-') AS mcc_strict,
 count(*) AS n FROM t GROUP BY ALL"""),
    "clean_values": _sel(_TL, """SELECT coalesce(period,'-') AS period, ts IS NULL AS no_ts, client IS NULL AS no_client, count(*) AS n, count(cents) AS amounts,
 cast(sum(coalesce(cents,0)) AS bigint) AS cents_exact, cast(sum(coalesce(cents,0)) AS bigint) AS cents_double,
 count(CASE WHEN amount NOT LIKE '%,%' THEN amt END) AS amounts_double FROM t GROUP BY ALL"""),
    "amount_by_city_from_lines": _sel(_amount(_TL, "city", "city"), "SELECT * FROM agg"),
    "amount_by_client_from_lines": _sel(_amount(_TE, "client", "client_id"), "SELECT * FROM agg"),
    "client_risk_from_lines": _sel(_risk(_TN), f"SELECT {_RISK_COLUMNS} FROM risks"),
    "mcc_lookup": _sel(_T, f"""SELECT mcc, tx, coalesce(l.label,'Unknown MCC Code: '||mcc) AS label_long, l.code IS NOT NULL AS known_long,
 coalesce(s.label,'MCC-'||mcc) AS label_short, s.code IS NOT NULL AS known_short, {_category('mcc', fixed.MCC_CATEGORY_LONG, 'long')} AS category_long,
 {_category('mcc', fixed.MCC_CATEGORY_SHORT, 'short')} AS category_short, {_cause('mcc')} AS error_cause
 FROM (SELECT mcc_l AS mcc, count(*) AS tx FROM t GROUP BY 1) LEFT JOIN (SELECT * FROM {_LONG}) l ON l.code=mcc LEFT JOIN (SELECT * FROM {_SHORT}) s ON s.code=mcc"""),
    "state_lookup": _sel(_BY_STATE, f"SELECT state, tx, {_state_name('state')} AS state_name, coalesce((SELECT region FROM {_STATES} WHERE code=state),'Unknown') AS region FROM agg"),
    "amount_by_city": _sel(_BY_CITY, "SELECT * FROM agg"),
    "amount_by_client": _sel(_BY_CLIENT, "SELECT * FROM agg"),
    "count_by_txn_type": _sel(_BY_TYPE, "SELECT * FROM agg"),
    "error_count_by_mcc": _sel(_BY_MCC, "SELECT * FROM agg"),
    "count_by_state": _sel(_BY_STATE, "SELECT * FROM agg"),
    "city_statistics": _sel(_CITY_STATS, "SELECT * FROM st"),
    "city_time_period": _sel(_PERIODS, "SELECT * FROM ctp"),
    **{f"category_counts_{by}": _sel(_cat(by), "SELECT * FROM cc") for by in ("city", "state", "country")},
    "city_period_category_counts": _sel(_CITY_PERIOD, "SELECT * FROM cc"),
    **{f"top_categories_by_{by}": _sel(_top(_cat(by), by), "SELECT * FROM top") for by in ("city", "state", "country")},
    "top_categories_by_city_period": _sel(_top(_CITY_PERIOD, "city, period"), f"SELECT *, {_PERIOD_ORDER} AS period_order FROM top"),
    "client_channel_profile": _sel(_CLIENTS, "SELECT * FROM profile"),
    "classify_client_risk": _sel(_CLIENTS_C, "SELECT * FROM classed"),
    "client_risk_by_state": _sel(_CLIENT_STATE, f"SELECT state, total, low, med, high, {_LMH}, {_spot_text('''concat(rank,'. ',city,': ',clients)''')} AS hotspots FROM roll"),
    "client_hotspots": _sel(_spots(_CLIENTS_C, "risk", 5, "clients"), "SELECT * FROM spots"),
    "merchant_profile": _sel(_MERCHANTS, "SELECT * FROM profile"),
    "classify_merchant_health": _sel(_MERCHANTS, f"SELECT *, {_HEALTH} FROM profile"),
    "classify_merchant_risk": _sel(_MERCHANTS, f"SELECT *, {_MRISK} FROM profile"),
    "merchant_health_by_state": _sel(_MERCHANT_STATE, f"""SELECT state, total, {', '.join(_MNAMES)}, {', '.join(f"{_pct(n, 'total')} AS {n}_pct" for n in _MNAMES)},
 {_spot_text("concat(rank,'. ',city,': ',merchants)")} AS hotspots, {_leader_text("concat(rank,'. ',merchant_id,': ',sum_cents,' (',health,', ',risk,')')")} AS top_merchants FROM roll"""),
    "top_merchants_by_state": _sel(_LEADERS, "SELECT * FROM leaders"),
    "merchant_hotspots": _sel(_spots(_MERCHANTS_C, "risk", 5, "merchants"), "SELECT * FROM spots"),
    "rfm_client": _sel(_RFM, "SELECT * FROM profile"),
    "classify_rfm": _sel(_RFM_C, "SELECT * FROM classed"),
    "rfm_by_state": _sel(_RFM_STATE, f"SELECT state, total, low, med, high, {_LMH}, {_spot_text('''concat(rank,'. ',city,': ',clients)''')} AS hotspots FROM roll"),
    "rfm_hotspots": _sel(_spots(_RFM_C, "bucket", _R.top_cities, "clients"), "SELECT * FROM spots"),
    "client_risk_profile": _sel(_RISK, f"SELECT {_PROFILE_COLUMNS} FROM rp"),
    "risk_score": _sel(_RISK, f"SELECT {_RISK_COLUMNS} FROM risks"),
    "top_risk_clients": _sel(_TOP_RISK, "SELECT category, rank, client_id, cast(score AS int) AS score, tx, total, factors FROM lead"),
    "risk_report": _sel(_TOP_RISK, f"""SELECT category, clients, avg_score, total_amount, avg_amount, avg_tx,
 (SELECT string_agg(concat(rank,'. ',client_id,' ',score,' ',tx,' ',{_money('tc')}),' | ' ORDER BY rank) FROM lead WHERE lead.category=rep.category) AS top_clients FROM rep"""),
    "word_count": """SELECT word, count(*) AS n FROM (
 SELECT regexp_replace(lower(w),'[^a-zA-Z0-9]','','g') AS word FROM (SELECT unnest(regexp_split_to_array(text,'\\s+')) AS w FROM documents)) WHERE word<>'' GROUP BY 1""",
    "avg_by_keys": "SELECT p_brand, p_type, count(*) AS n, round(avg(p_retailprice),6) AS avg_price FROM part WHERE p_brand<>'' AND p_type<>'' AND p_retailprice IS NOT NULL GROUP BY 1,2",
    "avg_by_keys_from_lines": """SELECT upper(p_type) AS city, upper(p_brand) AS status, count(*) AS n, round(avg(p_retailprice),6) AS avg_price
 FROM part WHERE p_partkey%40>3 AND p_type<>'' AND p_brand<>'' AND p_retailprice IS NOT NULL GROUP BY 1,2""",
    "summary_amount": _sel(_BY_CITY, f"SELECT count(*) AS keys, cast(sum(total_cents) AS bigint) AS grand_cents, {_ends('city', 'total_cents', 'highest', 'lowest')}, cast(sum(total_cents) AS bigint)//count(*) AS avg_cents FROM agg"),
    "summary_amount_client": _sel(_BY_CLIENT, f"""SELECT *, grand_cents//keys AS avg_cents, tx::DOUBLE/keys AS avg_tx, {_pct('highest_total_cents', 'grand_cents')} AS highest_pct,
 lowest_total_cents<0 AS has_refunds FROM (SELECT count(*) AS keys, cast(sum(total_cents) AS bigint) AS grand_cents, cast(sum(tx) AS bigint) AS tx, {_ends('client_id', 'total_cents', 'highest', 'lowest')} FROM agg)"""),
    "summary_types": _sel(_BY_TYPE, f"""SELECT *, CASE WHEN types<>2 THEN 'other' WHEN most_pct>80 THEN 'strong' WHEN most_pct>60 THEN 'moderate' ELSE 'balanced' END AS balance FROM (
 SELECT *, total::DOUBLE/types AS avg_tx, {_pct('most_tx', 'total')} AS most_pct, {_pct('least_tx', 'total')} AS least_pct FROM (
 SELECT count(*) AS types, cast(sum(tx) AS bigint) AS total, {_ends('txn_type', 'tx', 'most', 'least')} FROM agg))"""),
    "summary_errors": _sel(_BY_MCC, f"""SELECT *, CASE WHEN most_pct>30 THEN 'concentrated' WHEN most_pct<5 THEN 'spread' ELSE 'moderate' END AS concentration,
 {_cause('most_mcc')} AS most_cause, {_category('most_mcc', fixed.MCC_CATEGORY_LONG, 'long')} AS most_category, {_long('most_mcc')} AS most_label, {_long('least_mcc')} AS least_label FROM (
 SELECT *, total::DOUBLE/mccs AS avg_errors, {_pct('most_errors', 'total')} AS most_pct, {_pct('least_errors', 'total')} AS least_pct FROM (
 SELECT count(*) AS mccs, cast(sum(errors) AS bigint) AS total, {_ends('mcc', 'errors', 'most', 'least')} FROM agg))"""),
    "summary_states": _sel(_BY_STATE, f"""SELECT *, (total-online-unknown)::DOUBLE/(states-(online>0)::int-(unknown>0)::int) AS avg_per_state,
 {_pct('online', 'total')} AS online_pct, {_pct('unknown', 'total')} AS unknown_pct, {_pct('most_tx', 'total')} AS most_pct, {_pct('least_tx', 'total')} AS least_pct,
 {_state_name('most_state')} AS most_name, {_state_name('least_state')} AS least_name FROM (
 SELECT count(*) AS states, cast(sum(tx) AS bigint) AS total, coalesce((SELECT tx FROM agg WHERE state='ONLINE'),0) AS online, coalesce((SELECT tx FROM agg WHERE state='UNKNOWN'),0) AS unknown,
 {_hi('state', 'tx', 'agg', "state NOT IN ('ONLINE','UNKNOWN')")} AS most_state, {_hiv('tx', 'agg', "state NOT IN ('ONLINE','UNKNOWN')")} AS most_tx,
 {_lo('state', 'tx', 'agg', f'state IN {_US}')} AS least_state, {_lov('tx', 'agg', f'state IN {_US}')} AS least_tx FROM agg)"""),
    "region_totals": _sel(_BY_STATE + f", r AS (SELECT region, cast(sum(tx) AS bigint) AS tx FROM agg JOIN {_STATES} ON code=state GROUP BY 1)",
                          f"SELECT region, tx, {_pct('tx', '(SELECT cast(sum(tx) AS bigint) FROM agg)')} AS pct, region=(SELECT region FROM r ORDER BY tx DESC, region LIMIT 1) AS dominant, (SELECT count(*) FROM r)>=4 AS well_spread FROM r"),
    "summary_city_stats": _sel(_CITY_STATS, f"""SELECT *, grand_cents//tx AS avg_ticket_cents, tx//cities AS tx_per_city, grand_cents//cities AS cents_per_city FROM (
 SELECT count(*) AS cities, cast(sum(tx) AS bigint) AS tx, cast(sum(total_cents) AS bigint) AS grand_cents, {_hi('city', 'tx', 'st')} AS most_tx_city, {_hiv('tx', 'st')} AS most_tx,
 {_hi('city', 'total_cents', 'st')} AS highest_total_city, {_hiv('total_cents', 'st')} AS highest_total_cents, {_hi('city', 'avg_cents', 'st', 'tx>=10')} AS highest_avg_city,
 {_hiv('avg_cents', 'st', 'tx>=10')} AS highest_avg_cents, {_lo('city', 'avg_cents', 'st', 'tx>=10')} AS lowest_avg_city, {_lov('avg_cents', 'st', 'tx>=10')} AS lowest_avg_cents FROM st)"""),
    "summary_periods": _sel(_PERIODS + f", cb AS (SELECT *, {_IMBALANCE} AS imbalance FROM ctp)", f"""SELECT *, {', '.join(f"{_pct(f'{n}_tx', 'tx')} AS {n}_share" for n in _PN)},
 {', '.join(f"{n}_tx//cities AS {n}_per_city" for n in _PN)}, {_peak('morning_tx', 'afternoon_tx', 'night_tx')} AS peak FROM (
 SELECT count(*) AS cities, cast(sum(total) AS bigint) AS tx, {', '.join(f"cast(sum({n}) AS bigint) AS {n}_tx" for n in _PN)},
 {', '.join(f"{_hi('city', f'{n}_pct', 'cb', 'total>=50')} AS most_{n}_city" for n in _PN)},
 {', '.join(f"{_hiv(f'{n}_pct', 'cb', 'total>=50', zero='0.0::DOUBLE')} AS most_{n}_pct" for n in _PN)}, {_lo('city', 'imbalance', 'cb', 'total>=50')} AS most_balanced_city FROM cb)"""),
    **{f"summary_diversity_{by}": _diversity(by) for by in ("city", "state", "country")},
    "summary_country": _sel(_cat("country") + ", g AS (SELECT country, cast(sum(tx) AS bigint) AS tx FROM cc GROUP BY 1)", f"""SELECT *, CASE WHEN avg_tx<50 THEN 'low' WHEN avg_tx>200 THEN 'high' ELSE 'normal' END AS volume FROM (
 SELECT count(*) AS countries, cast(sum(tx) AS bigint) AS total, {_hi('country', 'tx', 'g')} AS busiest, {_hiv('tx', 'g')} AS busiest_tx, cast(sum(tx) AS bigint)::DOUBLE/count(*) AS avg_tx FROM g)"""),
    "summary_city_period": _sel(_CITY_PERIOD + ", g AS (SELECT city, period, count(*) AS categories FROM cc GROUP BY 1,2)", f"""SELECT count(*) AS city_periods, cast(sum(categories) AS bigint) AS records,
 (SELECT {_PERIOD_LABEL} FROM g ORDER BY categories DESC, city, {_PERIOD_ORDER} LIMIT 1) AS most_diverse, max(categories) AS most_categories, cast(sum(categories) AS bigint)::DOUBLE/count(*) AS avg_categories FROM g"""),
    "period_totals": _sel(_CITY_PERIOD, f"SELECT period, tx, {_pct('tx', '(SELECT cast(sum(tx) AS bigint) FROM cc)')} AS pct, cities FROM (SELECT period, cast(sum(tx) AS bigint) AS tx, count(DISTINCT city) AS cities FROM cc GROUP BY 1)"),
    "ranked_city_statistics": _sel(_CITY_STATS, "SELECT * FROM st ORDER BY tx DESC, total_cents DESC"),
    "ranked_city_time_period": _sel(_PERIODS, "SELECT * FROM ctp ORDER BY total DESC, greatest(morning,afternoon,night) DESC"),
    "ranked_top_categories": _sel(_top(_cat("city"), "city"), f"SELECT city AS key, city, {_TOP_TEXT} AS text, cast(sum(tx) AS bigint) AS total FROM top GROUP BY city ORDER BY total DESC"),
    "ranked_client_risk_by_state": _sel(_CLIENT_STATE, f"SELECT state, total, low, med, high, {_LMH} FROM roll ORDER BY high::DOUBLE/total DESC"),
    "ranked_client_risk_profile": _sel(_RISK, f"SELECT {_PROFILE_COLUMNS} FROM rp ORDER BY total DESC, tx DESC, client_id"),
    "ranked_client_risk": _sel(_RISK, f"SELECT {_RISK_COLUMNS} FROM risks ORDER BY score DESC, client_id"),
    "quality_toggle": _quality(_TL, {
        "amount_by_city": "cents IS NOT NULL", "chip_usage_count": "true", "city_statistics": "cents IS NOT NULL",
        "city_time_period": "period IS NOT NULL", "top_categories_by_city": "mcc_s IS NOT NULL",
        "top_categories_by_state": "mcc_s IS NOT NULL AND state IS NOT NULL",
        "top_categories_by_country": "mcc_s IS NOT NULL AND country IS NOT NULL",
        "category_by_time_period": "mcc_s IS NOT NULL AND period IS NOT NULL",
        "client_behavior": "trim(client_id)<>'' AND cents IS NOT NULL"}),
    "quality_even_quotes": _quality(_TE, {
        "amount_by_client": "client IS NOT NULL AND cents IS NOT NULL", "error_count_by_mcc": "true", "transaction_count_by_state": "true"}),
    "quality_errors": _sel(_TE, f"""SELECT *, valid-with_error AS without_error, {_pct('with_error', 'valid')} AS error_pct, {_pct('valid', 'read')} AS success_pct FROM (
 SELECT (SELECT count(*) FROM noisy) AS read, count(*) AS valid, count(*) FILTER (err_m) AS with_error FROM t)"""),
    "quality_states": _sel(_TE, f"""SELECT *, {_pct('online', 'valid')} AS online_pct, {_pct('unknown', 'valid')} AS unknown_pct FROM (
 SELECT (SELECT count(*) FROM noisy) AS read, count(*) AS valid, count(*) FILTER (state5='ONLINE') AS online, count(*) FILTER (state5='UNKNOWN') AS unknown, count(DISTINCT state5) AS distinct_states FROM t)"""),
    "quality_periods": _period_quality("true"),
    "quality_periods_numeric": _period_quality("mcc_s IS NOT NULL"),
    "quality_location": _sel(_TL, f"""SELECT *, read-header-us_accepted AS us_rejected, read-header-foreign_accepted AS foreign_rejected,
 {_pct('us_accepted', 'read')} AS us_pct, {_pct('foreign_accepted', 'read')} AS foreign_pct FROM (
 SELECT (SELECT count(*) FROM noisy) AS read, (SELECT count(*) FROM noisy WHERE kind='header') AS header,
 count(*) FILTER (mcc_s IS NOT NULL AND state IS NOT NULL) AS us_accepted, count(*) FILTER (mcc_s IS NOT NULL AND country IS NOT NULL) AS foreign_accepted FROM t)"""),
    "quality_risk": _sel(_risk(_TN), f"""SELECT *, (category_critical>0)::int+(category_high>0)::int+(category_medium>0)::int+(category_low>0)::int AS reports FROM (
 SELECT (SELECT count(*) FROM noisy WHERE kind='short') AS invalid_records, cast(sum(n) AS bigint) AS valid_records, cast(sum(n-tx) AS bigint) AS parse_errors, count(*) AS profiles,
 count(*) FILTER (client_id='') AS blank_clients, count(*) FILTER (client_id<>'') AS classified, {_CATEGORY_COUNTS} FROM rp)"""),
    "report_amount_by_city": _sel(_BY_CITY, f"SELECT city AS key, {_money('total_cents')} AS text FROM agg"),
    "report_amount_by_client": _sel(_BY_CLIENT, f"SELECT client_id AS key, {_money('total_cents')} AS text FROM agg"),
    "report_type_counts": _sel(_BY_TYPE, "SELECT txn_type AS key, cast(tx AS string) AS text FROM agg"),
    "report_error_counts": _sel(_BY_MCC, "SELECT mcc AS key, cast(errors AS string) AS text FROM agg"),
    "report_state_counts": _sel(_BY_STATE, "SELECT state AS key, cast(tx AS string) AS text FROM agg"),
    **{f"report_top_categories_by_{by}": _sel(_top(_cat(by), by), f"SELECT {by} AS key, {_TOP_TEXT} AS text FROM top GROUP BY {by}")
       for by in ("city", "state", "country")},
    "report_city_statistics": _sel(_CITY_STATS, f"SELECT city AS key, concat('Transações: ',tx,' | Total: $',{_money('total_cents')},' | Média: $',{_money('avg_cents')}) AS text FROM st"),
    "report_city_time_period": _sel(_PERIODS, f"SELECT city AS key, concat('Manhã: ',morning,' (',{_pct2('morning', 'total')},') | Tarde: ',afternoon,' (',{_pct2('afternoon', 'total')},') | Noite: ',night,' (',{_pct2('night', 'total')},') | Total: ',total,' | Pico: ',peak) AS text FROM ctp"),
    "report_top_categories_by_city_period": _sel(_top(_CITY_PERIOD, "city, period"), f"SELECT {_PERIOD_LABEL} AS key, {_TOP_TEXT} AS text FROM top GROUP BY city, period"),
    "report_client_risk": _sel(_CLIENT_STATE, f"""SELECT state AS key, concat('Clients: ',total,{_LMH_TEXT},CASE WHEN high_spots='' THEN '' ELSE concat(' | Top Cities (High Risk): ',high_spots) END) AS text
 FROM (SELECT *, {_spot_text("concat(city,': ',clients)")} AS high_spots FROM roll)"""),
    "report_merchant_health": _sel(_MERCHANT_STATE, f"""SELECT state AS key, concat('Merchants: ',total,' | Health A:',health_a,' (',{_pct2('health_a', 'total')},') | B:',health_b,' (',{_pct2('health_b', 'total')},') | C:',health_c,' (',{_pct2('health_c', 'total')},
 ') | Risk Low:',risk_low,' (',{_pct2('risk_low', 'total')},') | Med:',risk_med,' (',{_pct2('risk_med', 'total')},') | High:',risk_high,' (',{_pct2('risk_high', 'total')},') | Top Merchants: ',
 {_leader_text(f"concat(merchant_id,':$',{_money('sum_cents', True)})")},' | High-Risk Hotspots: ',{_spot_text("concat(city,': ',merchants)")}) AS text FROM roll"""),
    "report_rfm": _sel(_RFM_STATE, f"""SELECT state AS key, concat('Clients: ',total,{_LMH_TEXT},' | Top Cities (High): ',{_spot_text("concat(city,': ',clients)")}) AS text FROM roll"""),
    "report_client_risk_profile": _sel(_RISK, f"""SELECT client_id AS key, concat_ws('\t',tx,{_money('tc')},{_money('avg_c')},cities,mccs,cards,coalesce(first_ts,9223372036854775807),coalesce(last_ts,-9223372036854775808),online,swipe,errors,chargebacks) AS text FROM rp"""),
    "report_risk_score": _sel(_RISK, f"SELECT category AS key, concat_ws('\t',client_id,concat(score,'.00'),factors,tx,{_money('tc')}) AS text FROM risks"),
    "report_risk": _sel(_TOP_RISK, f"SELECT category AS key, {_RISK_BLOCK} AS text FROM rep"),
}


def _placed(sql: str, order: str) -> str:
    """The statement's rows with their position in an order."""
    chain, _, body = sql.rpartition("\nSELECT")
    return f"{chain}\nSELECT *, row_number() OVER (ORDER BY {order}) AS position FROM (SELECT{body})"


_RANKED = {
    "city_statistics": "tx DESC, total_cents DESC, city", "city_time_period": "total DESC, greatest(morning,afternoon,night) DESC, city",
    "top_categories": "total DESC, city", "client_risk_by_state": "high::DOUBLE/total DESC, state",
    "client_risk_profile": "total DESC, tx DESC, client_id", "client_risk": "score DESC, client_id",
}
_SEVERITY = "CASE key WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END"
_OWN_ORDER = {"report_risk": f"{_SEVERITY}, text"}
ORACLES |= {f"ranked_{name}": _placed(ORACLES[f"ranked_{name}"], order) for name, order in _RANKED.items()}
ORACLES |= {name: _placed(sql, _OWN_ORDER.get(name, "key, text")) for name, sql in ORACLES.items() if name.startswith("report_")}
ORACLES["report_top_categories_by_city_period"] = _sel(
    _top(_CITY_PERIOD, "city, period"), f"""SELECT key, text, row_number() OVER (ORDER BY city, {_PERIOD_ORDER}) AS position
 FROM (SELECT city, period, {_PERIOD_LABEL} AS key, {_TOP_TEXT} AS text FROM top GROUP BY city, period)""")


def _in_files(chain: str, key: str, text: str) -> str:
    return _sel(chain, f"SELECT row_number() OVER (ORDER BY {key}) AS position, concat({key},'\t',{text}) AS text FROM agg")


ORACLES |= {f"{name}_from_files": ORACLES[f"{name}_from_lines"] for name in ("amount_by_city", "amount_by_client", "client_risk")}
ORACLES |= {
    f"{name}_staged": ORACLES[name] for name in ("client_risk_by_state", "merchant_health_by_state", "rfm_by_state")}
ORACLES |= {
    "top_categories_by_city_period_staged": _sel(_top(_CITY_PERIOD, "city, period"), "SELECT * FROM top"),
    "report_in_one_file": _sel(_BY_CITY, f"SELECT 0 AS part, row_number() OVER (ORDER BY city) AS line, concat(city,'\t',{_money('total_cents')}) AS text FROM agg"),
    "report_in_three_files": _in_files(_BY_CLIENT, "client_id", _money("total_cents")),
    "report_in_any_files": _in_files(_BY_MCC, "mcc", "cast(errors AS string)"),
    "report_written_over": _in_files(_BY_STATE, "state", "cast(tx AS string)"),
}
