"""DuckDB SQL for the registered queries, over the same test tables."""

from __future__ import annotations

MS = "epoch_us(ts)//1000"
DAY = f"({MS})//86400000*86400000"
HOUR = f"({MS})//3600000*3600000"

TANK = f"select cast(user_id as varchar) as tankId, {MS} as ts, {DAY} as window_start, value as level from events"
BLOCK = f"select cast(user_id as varchar) as id, {MS} as ts, value as pos from events"
RPM = f"select cast(user_id as varchar) as id, {MS} as ts, {HOUR} as window_start, value as x from events"
TORQUE = f"select cast(user_id as varchar) as id, {MS} as ts, {HOUR} as window_start, value + event_id % 7 as x from events"

RIG = """
select cast(l_suppkey as varchar) as id, epoch_us(l_shipdate)//1000 as ts, l_orderkey, l_linenumber, l_partkey, l_quantity,
  case when l_linenumber=6 and l_returnflag='A' then -999.25::double when l_linenumber=6 and l_returnflag='R' then 0::double else 25+l_quantity/10 end as bit,
  case when l_linenumber=6 and l_returnflag='A' then -999.25::double when l_linenumber<=2 then 25+l_quantity/10+0.1::double else 60::double end as hole,
  case when l_tax<0.04 then 0::double else l_tax end as pump, l_discount*50 as rpm,
  case when l_linenumber=5 then 1 else 0 end as slip, case when l_tax>=0.05 then 3447380::double else 0::double end as pressure
from lineitem"""
RIG_ORDER = "partition by id order by ts, l_orderkey, l_linenumber, l_partkey, l_quantity"
RIG_COLUMNS = "id, ts, l_orderkey, l_linenumber, l_partkey, l_quantity"

STATUS = """
s as (select *,
  case when abs(bit-anchor)<=0.1 then 0 when bit-anchor>0 then -1 when bit-anchor<0 then 1 else 2147483647 end as pd,
  case when pump<=0.00630902 then -1 when pressure>=3447380 then 1 else 2147483647 end as ps,
  case when rpm<=1.05 then -1 when rpm>3.15 then 1 else 0 end as td,
  case when hole-bit<-0.3048 then -1 when hole-bit<0.33 then 0 else 1 end as bob
  from p)"""

# written from the slip test down, in another order than the operator's rules, to check them by a second form
LABEL = """case when bit=-999.25 and hole=-999.25 then 'Depth Data Issue'
  when bit<=0 and bit<>-999.25 and hole>0 then 'Out of Hole'
  when pd=0 and ps=1 and td=-1 and bob=1 then 'Pumping'
  when slip=1 and bob=1 then 'In Slips'
  when slip<>0 then 'Unknown'
  when pd=0 and bob=1 and ps=-1 and td=-1 then 'Stationary'
  when pd=0 and bob=1 and ps=-1 and td=1 then 'Rotating'
  when pd=0 and bob=1 and ps=1 and td=1 then 'Rotating Pumping'
  when pd=-1 and bob=0 and ps=1 and td=1 then 'Rotary Drilling'
  when pd=-1 and bob=0 and ps=1 and td=-1 then 'Slide Drilling'
  when pd=1 and bob=1 and ps=1 and td=-1 then 'Tripping Out Pumping'
  when pd=1 and bob=1 and ps=-1 and td=-1 then 'Tripping Out'
  when pd=1 and bob=1 and ps=-1 and td=1 then 'Tripping Out Rotating'
  when pd=1 and bob=1 and ps=1 and td=1 then 'Back Ream'
  when pd=-1 and bob=1 and ps=1 and td=-1 then 'Tripping In Pumping'
  when pd=-1 and bob=1 and ps=-1 and td=-1 then 'Tripping In'
  when pd=-1 and bob=1 and ps=-1 and td=1 then 'Tripping In Rotating'
  when pd=-1 and bob=1 and ps=1 and td=1 then 'Ream In'
  else 'Unknown' end"""

RIG_FIRST = f"""with r as ({RIG}),
p as (select *, first_value(bit) over w as anchor, row_number() over w as rn from r window w as ({RIG_ORDER})
  qualify rn > 1), {STATUS}"""
RIG_PREVIOUS = f"""with r as ({RIG}),
p as (select *, lag(bit) over w as anchor, row_number() over w as rn from r window w as ({RIG_ORDER})
  qualify rn > 1), {STATUS}"""

BLOCK_PAIRS = f"""with recursive b as ({BLOCK}),
a as (select id, min(ts) as anchor_ts, arg_min(pos, ts) as anchor_value from b group by id
  union all
  select a.id, min(b.ts), arg_min(b.pos, b.ts) from a join b on b.id = a.id and b.ts > a.anchor_ts + 14400000 group by a.id),
p as (select b.id, b.ts, b.pos, a.anchor_ts, a.anchor_value from b asof join a on b.id = a.id and b.ts >= a.anchor_ts
  where b.ts - a.anchor_ts between 1000 and 14400000)"""

RATES = f"""with t as ({TANK}),
l as (select *, lag(ts) over w as pts, lag(level) over w as plevel from t window w as (partition by tankId, window_start order by ts, level)),
u as (select *, (level - plevel) * 1000 / (ts - pts) as r from l where ts <> pts),
k as (select *, row_number() over (partition by tankId, window_start order by ts) as k, count(*) over (partition by tankId, window_start) as n from u),
f as (select tankId, window_start, max(ts) as ts, arg_max(level, ts) as level,
  sum(r * case when k = 1 then pow(2, -(n - 1)) else pow(2, -(n - k + 1)) end) as rate from k group by all),
o as (select tankId, window_start, min(ts) as ts, arg_min(level, (ts, level)) as level from t group by all),
rates as (select o.tankId, o.window_start, coalesce(f.ts, o.ts) as ts, coalesce(f.rate, 0) as rate, coalesce(f.level, o.level) as level
  from o left join f using (tankId, window_start))"""


def _overlapping(view: str, columns: str, length: int, step: int) -> str:
    """Each reading once for every window of ``length`` ms that it lies in, windows beginning every ``step`` ms."""
    return f"select {columns}, unnest(range((ts - {length}) // {step} + 1, ts // {step} + 1)) * {step} as window_start from ({view})"


TANK_OVERLAPPING = _overlapping(TANK, "tankId, ts, level", 129600000, 86400000)
ETA = """case when rate > 0 and 60 > level then cast(floor((60 - level) / rate) as bigint)
  when rate >= 0 and level >= 60 then 0 else -1 end"""


def _running(view: str, prefix: str, per_device: bool) -> str:
    part = "partition by id" if per_device else ""
    group = "window_start, id" if per_device else "window_start"
    first = "id, min(ts) as ts" if per_device else "arg_min(id, (ts, id)) as id, min(ts) as ts"
    return f"""with v as ({view}),
g as (select window_start, {first}, max(x) as hi, min(x) as lo from v group by {group}),
c as (select window_start, id, ts, max(hi) over w as hi, min(lo) over w as lo from g
  window w as ({part} order by window_start rows unbounded preceding))
select window_start, id, ts, hi - lo as {prefix}, hi as {prefix}MAX, lo as {prefix}MIN from c"""


MSE = """with m as (select l_orderkey, l_linenumber, 'W'||l_suppkey as well, 'Log '||l_returnflag as lg, cast(l_orderkey as varchar) as ds,
  cast(cast(l_quantity as bigint) as double) as tor, case when l_partkey%11<>0 then 60.0+l_linenumber end as rpm,
  case when l_partkey%13=0 then 0.0 when l_partkey%17=0 then null else 10.0+l_linenumber end as rop,
  case when l_partkey%19<>0 then l_linenumber*100.0 end as wob,
  case when l_returnflag='A' then 6.0 when l_partkey%23<>0 then 8.0 end as dia from lineitem),
e as (select l_orderkey, l_linenumber, well, ds, 'CALC_MSE@'||lg as mse_key, rop, tor,
  case when rop <> 0 then (480.0::double * tor * rpm) / (dia::double * dia * rop) + (4.0::double * wob) / (dia::double * dia * pi()) end as mse
  from m where rpm is not null and rop is not null and wob is not null and dia is not null)"""


def _unpivot(base: str, channels: dict[str, str], columns: str) -> str:
    parts = [
        f"select {columns}, '{name}' as mnemonic, coalesce(try_cast({expr} as double), 0) as value, {expr} as value_str from b"
        for name, expr in channels.items()
    ]
    return f"with b as ({base})\n" + "\nunion all\n".join(parts)


DEPTH = """select 'W'||l_suppkey as namewell, 'WB'||(l_partkey%3) as namewellbore, 'Log '||l_returnflag as namelog,
  case when length(cast(l_orderkey as varchar)) < 10 then lpad(cast(l_orderkey as varchar), 10, '0') else cast(l_orderkey as varchar) end as depthstring,
  cast(l_orderkey as double) as depth, l_partkey as seq, cast(cast(l_quantity as bigint) as varchar) as rop,
  cast(l_linenumber as varchar) as wob, l_linestatus as gr from lineitem"""
DEPTH_CHANNELS = {"ROP": "rop", "WOB": "wob", "GR": "gr"}
DEPTH_COLUMNS = "namewell, namewellbore, namelog, depthstring, depth"
STAMP = "strftime(make_timestamp(({0})*1000), '%Y-%m-%dT%H:%M:%SZ')"

ATTR = """select c_name as w, case when c_custkey%4=0 then '' else 'WB'||(c_custkey%3) end as wb,
  case when c_custkey%5=0 then '' else c_mktsegment end as rig, case when c_custkey%6=0 then '' else 'UTC' end as tz,
  case when c_custkey%7=0 then '' else 'active' end as st, cast(c_nationkey as varchar) as country from customer"""

TAGS = f"""select event_id, user_id, {MS} as ts, (event_id % 1000) / 2 as ds, event_type, cast(value as varchar) as v,
  case event_id%4 when 0 then 'POST_TELEMETRY' when 1 then 'POST_TELEMETRY_DEPTH' when 2 then 'POST_ATTRIBUTES' else 'GET_ATTRIBUTES' end as msg,
  cast(event_id % 50 as varchar) as wob, cast(event_id % 30 as varchar) as tor,
  case user_id%3 when 0 then 'waterTankLevel' when 1 then 'currentRpm' else 'blockPosition' end as channel,
  case event_type when 'error' then 'Message' when 'signup' then 'Traj1' when 'purchase' then 'ROP' else event_type end as own,
  case event_type when 'error' then 'Log #err' when 'signup' then '' when 'purchase' then 'Log A' else 'Log B' end as own_log,
  case when (event_id % 1000) % 2 = 0 then cast((event_id % 1000) // 2 as varchar) else cast((event_id % 1000) / 2 as varchar) end as dstext
from events"""
SHARED = """'"LogName":"'||{log}||'","tsds":"'||{at}||'","nameWell":"W'||user_id||'","nameWellbore":"WB1"'"""


def _pair(name: str, value: str) -> str:
    return f"""'"'||{name}||'":"'||{value}||'",'"""


def _record(kind: str, hint: str, at: str, own_test: str, log: str, channels: list[str], where: str) -> str:
    shared = SHARED.format(log=f"'{log}'", at=at)
    body = " || ".join(channels)
    return f"""select event_id, '{{' || {body} || {shared} || ',"hint":"{hint}"}}' as value from t
where msg = '{kind}' and ({where}) and ({own_test})"""


def _logs(kind: str, hint: str, at: str, skipped: str) -> str:
    """Log A holds ROP when sent, WOB and TOR; click and view go to Log B; names without a log share the empty one."""
    wob, tor = _pair("'WOB'", "wob"), _pair("'TOR'", "tor")
    rop = f"case when own = 'ROP' then {_pair('own', 'v')} else '' end"
    plain = f"case when own_log = '' and own <> '{skipped}' then {_pair('own', 'v')} else '' end"
    rows = [
        _record(kind, hint, at, "true", "Log A", [rop, wob, tor], "true"),
        _record(kind, hint, at, "own_log = 'Log B'", "Log B", [_pair("own", "v")], "true"),
        _record(kind, hint, at, "true", "", [plain, _pair("channel", "v")], "true"),
    ]
    if kind == "POST_TELEMETRY_DEPTH":
        rows.append(_record(kind, hint, at, "own_log = 'Log #err'", "Log #err", [_pair("own", "v")], "true"))
    return f"with t as ({TAGS})\n" + "\nunion all\n".join(rows)


def _least_squares(name: str, source: str, features: list[str], target: str) -> str:
    """CTEs that solve normal equations per tank by elimination; ``name`` holds n and the coefficients b0, b1, ..."""
    width = len(features)
    columns = [*features, target]
    pairs = [(i, j) for i in range(width) for j in range(i, width + 1)]
    known = " and ".join(f"{c} is not null" for c in columns)
    sums = ", ".join(f"sum({columns[i]} * {columns[j]}) as a{i}_{j}" for i, j in pairs)
    steps = [f"{name}_0 as (select tankId, count(*) as n, {sums} from {source} where {known} group by tankId having count(*) > {width})"]
    for m in range(width - 1):
        cells = [
            f"a{i}_{j} - a{m}_{i} * a{m}_{j} / a{m}_{m} as a{i}_{j}" if i > m else f"a{i}_{j}" for i, j in pairs
        ]
        steps.append(f"{name}_{m + 1} as (select tankId, n, {', '.join(cells)} from {name}_{m})")
    solved = []
    for i in reversed(range(width)):
        known_part = "".join(f" - a{i}_{j} * b{j}" for j in range(i + 1, width))
        solved.append(f"(a{i}_{width}{known_part}) / a{i}_{i} as b{i}")
    steps.append(f"{name} as (select tankId, n, {', '.join(solved)} from {name}_{width - 1})")
    return ",\n".join(steps)


def _arima(prefix: str, readings: str) -> str:
    """CTEs of the models with one lag and two errors, fitted on ``readings``; the table ``<prefix>_m`` holds them."""
    long, errors = _least_squares(f"{prefix}_long", readings, ["1", *[f"y{k}" for k in range(1, 6)]], "y0"), []
    for k in range(3):
        guess = " + ".join(f"b{i} * y{k + i}" for i in range(1, 6))
        errors.append(f"y{k} - (b0 + {guess}) as e{k}")
    own = _least_squares(f"{prefix}_own", f"{prefix}_e", ["1", "y1", "e1", "e2"], "y0")
    return f"""{long},
{prefix}_e as (select r.*, {', '.join(errors)} from {readings} r join {prefix}_long using (tankId)),
{own},
{prefix}_m as (select tankId, case when b0 is null then steps else n end as n, coalesce(b0, mean, 0) as c, coalesce(b1, 0) as phi,
  coalesce(b2, 0) as t1, coalesce(b3, 0) as t2, case when b0 is not null then 'fitted' when steps > 0 then 'mean' else 'level' end as status
  from (select tankId, avg(y0) as mean, count(y0) as steps from {readings} group by tankId) left join {prefix}_own using (tankId))"""


LAGS = ", ".join(f"lag(y0, {k}) over w as y{k}" for k in range(1, 8))
SERIES = f"""with recursive t as ({TANK}),
d as (select tankId, ts, level, level - lag(level) over (partition by tankId order by ts) as y0 from t),
l as (select *, {LAGS} from d window w as (partition by tankId order by ts))"""
STATIONARY, INVERTIBLE = "abs(phi) < 1", "(abs(t2) < 1 and t1 + t2 > -1 and t2 - t1 > -1)"


def _path(models: str, long: str) -> str:
    """The CTE ``f`` that carries the five steps on from each tank's last reading."""
    errors = []
    for k in range(2):
        guess = " + ".join(f"b{i} * y{k + i}" for i in range(1, 6))
        errors.append(f"coalesce(y{k} - (b0 + {guess}), 0) as e{k}")
    return f"""z as (select * from l qualify row_number() over (partition by tankId order by ts desc) = 1),
f as (select tankId, 0 as step, level as x, y0 as y, {', '.join(errors)}, c, phi, t1, t2, status
    from z join {models} using (tankId) left join {long} using (tankId)
  union all select tankId, step + 1, x + s, s, 0, e0, c, phi, t1, t2, status
    from (select *, c + phi * y + t1 * e0 + t2 * e1 as s from f where step < 5))
select tankId, cast(step as bigint) as step, round(x, 6) as forecast, status from f where step > 0"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["rig_state"] = f"{RIG_FIRST} select {RIG_COLUMNS}, {LABEL} as RIGSTATE from s"
    sql["rig_state_counts"] = f"{RIG_FIRST} select {LABEL} as RIGSTATE, count(*) as n from s group by 1"
    sql["rig_state_previous"] = f"{RIG_PREVIOUS} select {RIG_COLUMNS}, {LABEL} as RIGSTATE from s"
    sql["rig_substatus"] = (
        f"{RIG_FIRST} select {RIG_COLUMNS}, pd as pipe_direction, ps as pump_status, td as top_drive_status, bob as bit_on_bottom from s"
    )
    sql["payload_rig"] = f"""{RIG_FIRST} select id as device, ts, '{{"RIGSTATE":"'||{LABEL}||'"}}' as payload from s"""

    sql["block_anchor"] = f"{BLOCK_PAIRS} select id, ts, pos as blockPosition, anchor_ts, anchor_value from p"
    move = "case when pos - anchor_value > 0 then {0} when pos - anchor_value = 0 then {1} else {2} end"
    turn, name = move.format(1, 0, -1), move.format("'up'", "'stopped'", "'down'")
    sql["block_dir_vel"] = (
        f"{BLOCK_PAIRS} select id, ts, {turn} as BDIR, {name} as BDIRTEXT, "
        "abs((pos - anchor_value) / cast((ts - anchor_ts) // 1000 as double)) as BVEL from p"
    )
    sql["payload_block"] = (
        f"""{BLOCK_PAIRS} select id as device, ts, '{{"BDIR":'||{turn}||',"BDIRTEXT":"'||{name}||'"}}' as payload from p"""
    )

    sql["tank_avg"] = f"select tankId, window_start, round(avg(level), 8) as average from ({TANK}) group by all"
    wind = f"select event_type as geoZone, {DAY} as window_start, value as speed from events"
    sql["wind_avg"] = f"select geoZone, window_start, round(avg(speed), 8) as average, count(*) as n from ({wind}) group by all"
    sql["avg_rollup"] = (
        f"select tankId, round(sum(level), 8) as total, count(*) as n, round(avg(level), 8) as average from ({TANK}) group by all"
    )

    sql["rpm_p2p_running"] = _running(RPM, "RPMP2P", False)
    sql["torque_p2p_running"] = _running(TORQUE, "TRQP2P", False)
    sql["torque_p2p_by_device"] = _running(TORQUE, "TRQP2P", True)
    sql["rpm_p2p_window"] = f"""with v as ({RPM}) select window_start, arg_min(id, (ts, id)) as id, min(ts) as ts,
max(x) - min(x) as RPMP2P, max(x) as RPMP2PMAX, min(x) as RPMP2PMIN from v group by window_start"""
    sql["payload_kpi"] = f"""select id as device, ts, '{{"RPMP2PMAX":'||RPMP2PMAX||',"RPMP2PMIN":'||RPMP2PMIN||'}}' as payload
from ({_running(RPM, "RPMP2P", False)})"""
    spread = "max(x) - min(x) as {0}P2P, max(x) as {0}P2PMAX, min(x) as {0}P2PMIN"
    sql["rpm_p2p_sliding"] = f"""with v as ({_overlapping(RPM, "id, ts, x", 10800000, 7200000)})
select window_start, arg_min(id, (ts, id)) as id, min(ts) as ts, {spread.format("RPM")} from v group by window_start"""
    sql["torque_p2p_sliding_by_device"] = f"""with v as ({_overlapping(TORQUE, "id, ts, x", 129600000, 86400000)})
select window_start, id, min(ts) as ts, {spread.format("TRQ")} from v group by window_start, id"""
    sql["tank_rate_sliding"] = f"{RATES.replace(TANK, TANK_OVERLAPPING)} select tankId, window_start, ts, round(rate, 9) as rate, level from rates"
    sql["tank_series_sliding"] = f"""select tankId, window_start, row_number() over (partition by tankId, window_start order by ts, level) as position,
ts, level as waterTankLevel from ({TANK_OVERLAPPING})"""
    sql["rpm_extreme_rows"] = f"""with v as (select id, cast(ts as varchar) as ts, x from ({RPM}))
select arg_max(id, (x, ts, id)) as max_id, arg_max(ts, (x, ts, id)) as max_ts, max(x) as max_rpm,
arg_min(id, (x, ts, id)) as min_id, arg_min(ts, (x, ts, id)) as min_ts, min(x) as min_rpm from v"""
    sql["first_rows"] = f"select id, cast(min(ts) as varchar) as ts, arg_min(x, ts) as currentRpm from ({RPM}) group by id"
    sql["record_count"] = f"select count(*) as n from ({TANK}) where tankId = '8'"

    sql["tank_rate"] = f"{RATES} select tankId, window_start, ts, round(rate, 9) as rate, level from rates"
    sql["tank_eta"] = f"{RATES} select tankId, window_start, ts, {ETA} as eta from rates"
    sql["payload_eta"] = (
        f"""{RATES} select '{{"Tank '||tankId||'":[{{"ts":'||ts||',"values":{{"timeToFill":'||({ETA})||'}}}}]}}' as payload from rates"""
    )
    series = f"""select tankId, window_start, row_number() over (partition by tankId, window_start order by ts, level) as position,
ts, level as waterTankLevel from ({TANK})"""
    sql["tank_series"] = series
    sql["tank_vector"] = f"""select tankId, window_start, (position - 1) // 2 as part,
string_agg(cast(waterTankLevel as varchar), ',' order by position) as vector from ({series}) group by all"""
    sql["tank_lines"] = f"select tankId||','||ts||','||level as rec from ({TANK})"

    sql["mse"] = f"""{MSE} select l_orderkey, l_linenumber, mse_key, round(mse, 6) as mse, mse is null as unbounded from e"""
    sql["mse_payload"] = f"""{MSE} select '{{"'||well||'":[{{"ds":"'||ds||'","values":{{"'||mse_key||'":'||
case when rop = 0 and tor = 0 then '"NaN"' when rop = 0 then '"Infinity"' else cast(round(mse, 3) as varchar) end||'}}}}]}}' as payload from e"""

    depth_rows = _unpivot(DEPTH, DEPTH_CHANNELS, DEPTH_COLUMNS)
    sql["depth_log"] = depth_rows
    sql["upsert_latest"] = f"""select namewell, namewellbore, namelog, mnemonic, depthstring, arg_max(depth, (seq, value, value_str)) as depth,
arg_max(value, (seq, value, value_str)) as value, arg_max(value_str, (seq, value, value_str)) as value_str, max(seq) as seq
from ({_unpivot(DEPTH, DEPTH_CHANNELS, DEPTH_COLUMNS + ", seq")}) group by 1, 2, 3, 4, 5"""
    # rows of the second checkpoint outrank those of the first, as their batches are later
    sql["upsert_replayed"] = f"""select namewell, namewellbore, namelog, mnemonic, depthstring,
arg_max(depth, (seq % 2, seq, value, value_str)) as depth, arg_max(value, (seq % 2, seq, value, value_str)) as value,
arg_max(value_str, (seq % 2, seq, value, value_str)) as value_str, arg_max(seq, (seq % 2, seq, value, value_str)) as seq
from ({_unpivot(DEPTH, DEPTH_CHANNELS, DEPTH_COLUMNS + ", seq")}) group by 1, 2, 3, 4, 5"""
    time_base = f"""select 'W'||user_id as namewell, 'WB1' as namewellbore, 'Log 1' as namelog, {STAMP.format(MS)} as ts,
event_type, cast(value as varchar) as cv, json_extract_string(props, '$.k') as kv from events"""
    sql["time_log"] = f"""with b as ({time_base})
select namewell, namewellbore, namelog, ts, event_type as mnemonic, coalesce(try_cast(cv as double), 0) as value, cv as value_str from b
union all
select namewell, namewellbore, namelog, ts, 'K', coalesce(try_cast(kv as double), 0), kv from b where kv is not null"""
    sql["message_log"] = f"""select 'W'||conv_id as namewell, 'WB1' as namewellbore,
case when turn%2=0 then 'Log #messages_time' else 'Log #'||role end as namelog, 'Message' as mnemonic,
{STAMP.format("turn*1000")} as ts, 0::double as value, text as value_str from conversations"""
    sql["trajectory"] = """select p_brand as namewell, 'WB'||(p_size%3) as namewellbore, p_type as nametrajectory, 'Stn'||p_partkey as nametrajectorystn,
0::double as azivertsectvalue, '' as azivertsectuom, cast(p_partkey as double) as dispnsvertsecorigvalue, '' as dispnsvertsecoriguom,
cast(p_partkey+1 as double) as dispewvertsecorigvalue, '' as dispewvertsecoriguom, '' as aziref, '' as cmndatadtimcreation,
'' as cmndatadtimlstchange, '' as typetrajstation, cast(p_size as double) as mdvalue, 'm' as mduom,
case when p_size%5=0 then 0::double else p_size*2 end as tvdvalue, '' as tvduom,
case when p_size%7=0 then 0::double else p_size+1 end as inclvalue, '' as incluom, 0::double as azivalue, '' as aziuom,
0::double as dispnsvalue, '' as dispnsuom, 0::double as dispewvalue, '' as dispewuom, 0::double as vertsectvalue, '' as vertsectuom,
0::double as dlsvalue, '' as dlsuom, '' as dtimstn, '2024-02-01T00:00:00' as loadtime from part"""
    loaded = "'2024-02-01T00:00:00' as loadtime"
    sql["attr_well"] = f"""select w as namewell, '' as operator, '' as state, '' as county, country, tz as timezone, '' as numapi, st as statuswell,
'' as dtimspud, '' as ekey, '' as well_government_id, '' as surface_latitude, '' as surface_longitude, {loaded}
from ({ATTR}) where w <> '' and tz <> '' and st <> ''"""
    sql["attr_wellbore"] = f"select w as namewell, wb as namewellbore, '' as statuswellbore, {loaded} from ({ATTR}) where wb <> ''"
    sql["attr_rig"] = (
        f"select w as namewell, wb as namewellbore, rig as namerig, '' as ownerrig, '' as dtimstartop, {loaded} from ({ATTR}) where rig <> ''"
    )
    sql["offset_ledger"] = """select event_type as topic_name, 'TIMELOG' as group_id, cast(user_id % 4 as integer) as partition,
max(event_id) + 1 as offsetid from events group by event_type, user_id % 4"""

    tank_mean = f"select tankId, window_start, round(avg(level), 8) as a from ({TANK}) group by all"
    tank_text = """'{"Tank '||tankId||'":[{"ts":'||window_start||',"values":{"averageWaterLevel":'||a||'}}]}'"""
    sql["payload_tank"] = f"select {tank_text} as payload from ({tank_mean})"
    sql["payload_announce"] = f"""select 0 as seq, '{{"device":"Tank '||tankId||'"}}' as payload from (select distinct tankId from ({TANK}))
union all select 1, {tank_text} from ({tank_mean})"""
    sql["payload_wind"] = f"""select window_start, '{{'||string_agg('"'||geoZone||'":[{{"ts":'||window_start||',"values":{{"windSpeed":'||a||'}}}}]', ',' order by geoZone)||'}}' as payload
from (select geoZone, window_start, round(avg(speed), 8) as a from ({wind}) group by all) group by window_start"""

    keys = """(select event_id, msg, case when own = 'Traj1' then own else own||'@'||own_log end as key from t
union all select event_id, msg, 'WOB@Log A' from t union all select event_id, msg, 'TOR@Log A' from t
union all select event_id, msg, channel from t)"""
    sql["route_tags"] = f"""with t as ({TAGS}) select event_id, key, split_part(key, '@', 1) as mnemonic,
case when contains(key, '@') then substr(key, instr(key, '@') + 1) end as log_name,
case msg when 'POST_TELEMETRY' then case when contains(key, 'Message') then 'message' else 'time' end
when 'POST_TELEMETRY_DEPTH' then case when contains(key, 'Traj') then 'trajectory' else 'depth' end
when 'POST_ATTRIBUTES' then 'attribute' end as route from {keys}"""
    sql["route_time_logs"] = _logs("POST_TELEMETRY", "TIMELOG", "ts", "")
    sql["route_depth_logs"] = _logs("POST_TELEMETRY_DEPTH", "DEPTHLOG", "dstext", "Traj1")
    sql["route_message_logs"] = f"with t as ({TAGS})\n" + _record(
        "POST_TELEMETRY", "MESSAGELOG", "ts", "own = 'Message'", "Log #err", [_pair("own", "v")], "true"
    )
    mse_shared = SHARED.format(log="'Log A'", at="dstext")
    mse_body = " || ".join([f"case when own = 'ROP' then {_pair('own', 'v')} else '' end", _pair("'WOB'", "wob"), _pair("'TOR'", "tor")])
    sql["route_mse"] = f"""with t as ({TAGS}) select event_id, '{{' || {mse_body} || {mse_shared} || ',"diameter":"8"}}' as value
from t where msg = 'POST_TELEMETRY_DEPTH' and user_id % 5 <> 0"""
    own_key = "case when own = 'Traj1' then own else own||'@'||own_log end"
    attributes = " || ".join([_pair(own_key, "v"), _pair("'WOB@Log A'", "wob"), _pair("'TOR@Log A'", "tor"), _pair("channel", "v")])
    sql["route_attributes"] = f"""with t as ({TAGS}) select event_id,
'{{"hint":"ATTRIBUTES",' || {attributes} || '"nameWell":"W'||user_id||'"}}' as value from t where msg = 'POST_ATTRIBUTES'"""
    sql["route_trajectory"] = f"with t as ({TAGS}) select event_id, v as value from t where msg = 'POST_TELEMETRY_DEPTH' and own = 'Traj1'"
    sql["route_device"] = f"""with t as (select * from ({TAGS}) where msg = 'POST_TELEMETRY')
select 'tank' as topic, event_id, '{{"tankId":"'||user_id||'","ts":"'||ts||'","waterTankLevel":"'||v||'"}}' as value from t
where user_id % 3 = 0 and user_id % 2 = 0
union all select 'rpm', event_id, '{{"id":"bit'||user_id||'","ts":"'||ts||'","currentRpm":'||v||'}}' from t where user_id % 3 = 1
union all select 'block', event_id, '{{"id":"dev'||user_id||'","ts":"'||ts||'","blockPosition":'||v||'}}' from t where user_id % 3 = 2"""
    sql["route_rig"] = f"""select id, ts, bit as bitDepth, hole as holeDepth, pump as totalPumpOutput, rpm as rotaryRpm,
slip as inSlipStatus, pressure as standpipePressure from ({RIG}) where pump > 0"""
    sql["retention"] = (
        f"select tankId, ts, level as waterTankLevel from ({TANK}) where ts >= 1737331200000 - 365 * 86400000::bigint"
    )
    sql["offsets_unread"] = """with m as (select event_type as topic, cast(user_id % 4 as integer) as partition, event_id as at_offset from events),
r as (select topic, partition, max(at_offset) + 1 as reached from m where at_offset % 1000 < 500 and topic <> 'error' group by all)
select topic, partition, m.at_offset as "offset" from m left join r using (topic, partition) where m.at_offset >= coalesce(reached, m.at_offset)"""
    sql["retention_stored"] = sql["retention"]
    dirty = f"""select event_id, {MS} as ms, user_id, value as v, event_id % 6 as kind from events"""
    sql["decode_block"] = f"""select event_id, case when kind = 5 then cast(user_id as varchar) end as id,
case when kind = 5 then ms else 0 end as ts, case when kind = 5 then v else 0 end as blockPosition from ({dirty}) where kind in (4, 5)"""
    sql["decode_quarantine"] = f"""select case kind when 2 then '{{"id":1,' else '[1]' end as value, 'not a JSON object' as decode_error,
count(*) as n from ({dirty}) where kind in (2, 3) group by kind"""
    sql["decode_maps"] = f"""select event_id, case when kind = 5 then 3 else 0 end as n_fields,
case when kind = 5 then cast(ms as varchar) end as ts_text from ({dirty}) where kind <> 0"""
    # blank messages and values that are no numbers are left out; a missing value is 0
    sent = f"""select event_id, cast(user_id as varchar) as user, {MS} as ms, {HOUR} as window_start, event_type,
case when event_id % 17 = 0 then 0 else value end as x from events where event_id % 23 <> 0 and event_id % 13 <> 0"""
    sql["decode_tank"] = f"select event_id, user as tankId, ms as ts, x as waterTankLevel from ({sent})"
    sql["decode_wind"] = f"select event_id, event_type as geoZone, x as windSpeed from ({sent})"
    sql["decode_rpm"] = f"select event_id, user as id, cast(ms as varchar) as ts, x as currentRpm from ({sent}) where event_id % 19 <> 0"
    sql["decode_torque"] = f"select event_id, user as id, cast(ms as varchar) as ts, x as currentTorque from ({sent}) where event_id % 7 <> 0"
    sql["well_present"] = """select event_id, case when event_id % 5 = 0 then 'W'||user_id else '' end as well from events
where event_id % 5 in (0, 1)"""
    torques = f"select user as id, ms as ts, window_start, x from ({sent}) where event_id % 7 <> 0"
    sql["torque_job"] = f"""select id as device, ts, '{{"TRQP2P":'||TRQP2P||',"TRQP2PMAX":'||TRQP2PMAX||',"TRQP2PMIN":'||TRQP2PMIN||'}}' as payload
from ({_running(torques, "TRQP2P", False)})"""
    sql["payload_kpi_spread"] = f"""with v as ({RPM}) select id as device, min(ts) as ts,
'{{"RPMP2P":'||round(max(x) - min(x), 4)||',"RPMP2PMAX":'||max(x)||',"RPMP2PMIN":'||min(x)||'}}' as payload from v group by id, window_start"""
    sql["payload_velocity"] = f"""{BLOCK_PAIRS},
m as (select *, round(abs((pos - anchor_value) / ((ts - anchor_ts) // 1000)), 6) as vel from p)
select id as device, ts, '{{"BDIR":'||{turn}||',"BDIRTEXT":"'||{name}||'","BVEL":'||vel||'}}' as payload from m where vel between 0.001 and 9999"""
    sql["flat_payload"] = f"""select id, '{{"ts":'||ts||',"blockPosition":'||pos||'}}' as payload from ({BLOCK})"""

    sql["ar1_forecast"] = f"""with recursive t as ({TANK}),
d as (select tankId, ts, level, level - lag(level) over w as y from t window w as (partition by tankId order by ts)),
l as (select *, lag(y) over (partition by tankId order by ts) as y1 from d),
m as (select tankId, regr_slope(y, y1) as phi, regr_intercept(y, y1) as c, arg_max(level, ts) as x, arg_max(y, ts) as y
  from l group by tankId having count(y1) >= 3),
f as (select tankId, 0 as step, x, y, phi, c from m
  union all select tankId, step + 1, x + c + phi * y, c + phi * y, phi, c from f where step < 5)
select tankId, cast(step as bigint) as step, round(x, 6) as forecast, 'fitted' as status from f where step > 0"""
    sql["arima_forecast"] = f"{SERIES},\n{_arima('a', 'l')},\n{_path('a_m', 'a_long')}"
    sql["arima_models"] = f"""{SERIES},
{_arima('a', 'l')}
select tankId, n, round(c, 8) as intercept, round(phi, 8) as ar1, round(t1, 8) as ma1, round(t2, 8) as ma2, status,
{STATIONARY} as stationary, {INVERTIBLE} as invertible from a_m"""
    sql["arima_models_kept"] = f"""{SERIES},
{_arima('a', 'l')}
select tankId, n, round(c, 5) as intercept, round(phi, 5) as ar1, round(t1, 5) as ma1, round(t2, 5) as ma2, status from a_m"""
    chosen = f"status = 'fitted' and {STATIONARY} and {INVERTIBLE}"
    sql["arima_reuse"] = f"""{SERIES},
early as (select * from l where ts < 1705795200000),
{_arima('o', 'early')},
{_arima('a', 'l')},
m as (select *, {chosen} as kept from o_m where {chosen} union all select *, false from a_m where tankId not in (select tankId from o_m where {chosen})),
g as (select tankId, coalesce(o.b0, a.b0) as b0, {', '.join(f"coalesce(o.b{i}, a.b{i}) as b{i}" for i in range(1, 6))}
  from (select * from o_long where tankId in (select tankId from m where kept)) o full join
  (select * from a_long where tankId not in (select tankId from m where kept)) a using (tankId)),
{_path('m', 'g')}"""
    return sql
