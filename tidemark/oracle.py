"""Reference SQL for the registered queries (DuckDB dialect, ANSI where possible).

Each statement recomputes its query from the supplied tables with plain SQL
(window functions, joins, range joins), independently of the DataFrame code.
The fixture mappings are shared text fragments below.
"""

from __future__ import annotations

from tidemark.plans.fixtures import SNAPSHOT_RUNS

# --- domain mapping (FIXTURES.md section 3) --------------------------------
BRONZE_USERS = """
select c.c_custkey as user_id, concat('  ', c.c_name, '@Example.com ') as email,
  chr(cast(97 + n.n_regionkey % 26 as int)) || chr(cast(97 + n.n_nationkey % 26 as int)) as country_code,
  case c.c_custkey % 3 when 0 then 'organic' when 1 then 'referral' else 'paid_ad' end as signup_channel,
  case c.c_custkey % 5 when 0 then 'pending' when 4 then 'rejected' else 'verified' end as kyc_status,
  coalesce(o.first_at, timestamp '1995-01-01 00:00:00') as created_at,
  coalesce(o.last_at,  timestamp '1995-01-01 00:00:00') as updated_at
from customer c left join (select o_custkey, min(o_orderdate) first_at, max(o_orderdate) last_at
                           from orders group by o_custkey) o on o.o_custkey = c.c_custkey
  left join nation n on n.n_nationkey = c.c_nationkey
"""

BRONZE_WALLETS = """
select o_custkey*5 + cast(substr(o_orderpriority,1,1) as int)-1 as wallet_id, o_custkey as user_id,
  case substr(o_orderpriority,1,1) when '1' then 'Ethereum' when '2' then 'BSC' when '3' then 'Polygon'
       when '4' then 'Arbitrum' else 'Base' end as chain,
  concat('0X', upper(md5(concat(cast(o_custkey as varchar), '-', o_orderpriority)))) as address,
  'non_custodial' as wallet_type,
  row_number() over (partition by o_custkey order by o_orderpriority) = 1 as is_primary,
  min(o_orderdate) as created_at, max(o_orderdate) as updated_at
from orders group by o_custkey, o_orderpriority
"""

BRONZE_TRANSACTIONS = """
select o_orderkey as transaction_id, o_custkey*5 + cast(substr(o_orderpriority,1,1) as int)-1 as wallet_id,
  case when o_orderstatus='O' then ' ' else md5(cast(o_orderkey as varchar)) end as tx_hash,
  case o_orderkey % 3 when 0 then 'send' when 1 then 'receive' else 'swap' end as direction,
  case substr(o_orderpriority,1,1) when '2' then 'bnb' when '3' then 'matic' else 'eth' end as asset_symbol,
  cast(cast(o_totalprice as decimal(18,2)) as decimal(38,18)) as amount,
  cast(o_totalprice as decimal(18,2)) as usd_value_at_tx,
  cast(cast((o_orderkey % 100) as decimal(18,0)) / 10000 as decimal(18,4)) as fee_native,
  case o_orderstatus when 'F' then 'confirmed' when 'O' then 'pending' else 'failed' end as status,
  o_orderdate + to_seconds(o_orderkey % 86400) as submitted_at,
  case when o_orderstatus='F' then o_orderdate + to_seconds(o_orderkey % 86400 + 5 + o_orderkey % 596) end
    as confirmed_at,
  o_orderdate as updated_at
from orders
"""

def _newest(relation: str, key: str) -> str:
    """The rows of ``relation`` that no other row of their key is newer than."""
    return (f"select a.* from ({relation}) a where not exists "
            f"(select 1 from ({relation}) b where b.{key} = a.{key} and b.updated_at > a.updated_at)")


STG_USERS = f"""
select user_id, trim(lower(email)) as email, upper(country_code) as country_code, signup_channel, kyc_status,
       created_at, updated_at
from ({_newest(BRONZE_USERS, 'user_id')})
"""

STG_WALLETS = f"""
select * replace (lower(chain) as chain, lower(address) as address)
from ({_newest(BRONZE_WALLETS, 'wallet_id')})
"""

STG_TRANSACTIONS = f"""
select transaction_id, wallet_id, if(trim(tx_hash) = '', null, trim(tx_hash)) as tx_hash, direction,
       upper(asset_symbol) as asset_symbol, amount, usd_value_at_tx,
       cast(fee_native as decimal(38,18)) as fee_native, status, submitted_at, confirmed_at, updated_at,
       cast(epoch(date_trunc('second', confirmed_at)) - epoch(date_trunc('second', submitted_at)) as bigint)
         as confirmation_seconds
from ({_newest(BRONZE_TRANSACTIONS, 'transaction_id')})
"""

DIM_WALLETS = f"""
select * exclude (created_at, updated_at), created_at as wallet_created_at, updated_at as wallet_updated_at
from ({STG_WALLETS})
"""

DIM_USERS = f"""
select s.user_id, any_value(s.email) as email, any_value(s.country_code) as country_code,
       any_value(s.signup_channel) as signup_channel, any_value(s.kyc_status) as kyc_status,
       count(p.wallet_id) as wallet_count, sum(if(p.chain = 'ethereum', 1, 0))::bigint as ethereum_wallet_count,
       any_value(s.created_at) as user_created_at, any_value(s.updated_at) as user_updated_at
from ({STG_USERS}) s left join ({STG_WALLETS}) p using (user_id) group by s.user_id
"""

FACT = f"""
select t.* exclude (updated_at), owner.user_id, owner.chain,
       cast(cast(t.submitted_at as date) as timestamp) as submitted_date
from ({STG_TRANSACTIONS}) t left join ({STG_WALLETS}) owner using (wallet_id)
"""

M_VOLUME = "cast(sum(usd_value_at_tx) as decimal(38,2)) as transaction_volume_usd"
M_COUNT = "count(transaction_id) as transaction_count"
M_CONFIRMED = "count(case when status = 'confirmed' then transaction_id end) as confirmed_transaction_count"
M_RATE = ("cast(count(case when status = 'confirmed' then transaction_id end) as double)"
          " / cast(nullif(count(transaction_id), 0) as double) as confirmed_transaction_rate")
M_AVG = "round(avg(confirmation_seconds), 6) as avg_confirmation_seconds"
ALL_M = ", ".join([M_VOLUME, M_COUNT, M_CONFIRMED, M_RATE, M_AVG])


def _metric_time(grain: str) -> str:
    return f"date_trunc('{grain}', submitted_at)"


def _by_time(grain: str) -> str:
    return (f"select {_metric_time(grain)} as metric_time__{grain}, {M_VOLUME} "
            f"from ({FACT}) f group by 1")


# --- change log of users from events ----------------------------------------
OP_CASE = "case event_type when 'error' then 'd' when 'signup' then 'c' else 'u' end"
TS_MS = "(epoch_us(ts) // 1000)"
CHANGES = f"""
select user_id, case when event_type = 'error' then null else event_type end as event_type,
       case when event_type = 'error' then null else value + 0.0 end as value,
       case when event_type = 'error' then null else cast(json_extract_string(props, '$.k') as bigint) end as k,
       {OP_CASE} as _cdc_op, {TS_MS} as _cdc_ts_ms, event_id as _cdc_lsn
from events
"""

COMPACT_PUBLISHED = f"""
select user_id, event_type, value, k, _cdc_op, _cdc_ts_ms, _cdc_lsn
from (select *, row_number() over (partition by user_id order by _cdc_ts_ms desc, _cdc_lsn desc) as _rn
      from ({CHANGES}) c) x
where _rn = 1 and _cdc_op <> 'd'
"""

ONCHAIN = """
select concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) as hash,
       l_returnflag as _chain, l_shipdate as _ingested_at, l_partkey as block_number,
       l_suppkey as nonce, l_extendedprice as value, l_quantity as gas
from lineitem
"""

INSERT_ONLY = f"""
with feed as ({ONCHAIN}),
l1 as (select *, timestamp '1998-01-01 00:00:00' as _loaded_at,
              row_number() over (partition by hash, _chain
                                 order by _ingested_at, block_number, nonce, value) as _rn
       from feed where _ingested_at < timestamp '1998-01-01 00:00:00'),
t1 as (select * exclude (_rn) from l1 where _rn = 1),
l2 as (select *, timestamp '2100-01-01 00:00:00' as _loaded_at,
              row_number() over (partition by hash, _chain
                                 order by _ingested_at, block_number, nonce, value) as _rn
       from feed where _ingested_at >= timestamp '1998-01-01 00:00:00'),
n2 as (select * exclude (_rn) from l2
       where _rn = 1 and not exists (select 1 from t1 where t1.hash = l2.hash and t1._chain = l2._chain))
select * from t1 union all select * from n2
"""

UNION_SOURCES = """
select cast(o_orderkey as varchar) as hash, o_custkey as from_id, o_totalprice as value,
       case substr(o_orderpriority,1,1) when '1' then 'ethereum' when '2' then 'bsc' when '3' then 'polygon'
            when '4' then 'arbitrum' else 'base' end as _chain,
       case when substr(o_orderpriority,1,1) in ('1', '5') then o_orderstatus end as status
from orders where substr(o_orderpriority,1,1) in ('1','2','3','4','5')
"""

USER_STATES = "select user_id, event_type as state, ts as updated_at, event_id from events"

SCD2_APPLY = f"""
with s as ({USER_STATES}),
r1 as (select user_id, state, updated_at from
        (select *, row_number() over (partition by user_id order by updated_at desc) as _rn
         from s where updated_at < timestamp '2024-01-15 00:00:00') x where _rn = 1),
r2 as (select user_id, state, updated_at from
        (select *, row_number() over (partition by user_id order by updated_at desc) as _rn from s) x
       where _rn = 1)
select r1.user_id, r1.state, r1.updated_at, r1.updated_at as valid_from,
       case when r2.updated_at > r1.updated_at then r2.updated_at end as valid_to
from r1 left join r2 on r1.user_id = r2.user_id
union all
select r2.user_id, r2.state, r2.updated_at, r2.updated_at as valid_from, cast(null as timestamp) as valid_to
from r2 left join r1 on r1.user_id = r2.user_id
where r1.user_id is null or r2.updated_at > r1.updated_at
"""

def _history(states: str) -> str:
    return f"""
select s.user_id, s.state, s.updated_at, s.updated_at as valid_from,
       lead(s.updated_at) over (partition by s.user_id order by s.updated_at, s.event_id) as valid_to
from ({states}) s
"""


HISTORY = _history(USER_STATES)

AS_OF = f"""
with h as ({_history(USER_STATES + " where event_type <> 'purchase'")}),
f as (select event_id, user_id, ts, value + 0.0 as value from events where event_type = 'purchase')
select f.event_id, f.user_id, f.ts, f.value, h.state, h.valid_from, h.valid_to
from f left join h on f.user_id = h.user_id and f.ts >= h.valid_from
                  and f.ts < coalesce(h.valid_to, timestamp '9999-12-31 00:00:00')
"""

ORACLE: dict[str, str] = {
    "stg_users": STG_USERS,
    "stg_wallets": STG_WALLETS,
    "stg_transactions": STG_TRANSACTIONS,
    "latest_per_key": """
select * exclude (_rn) from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
                               order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) as _rn
  from lineitem) x where _rn = 1
""",
    "dim_users": DIM_USERS,
    "dim_wallets": DIM_WALLETS,
    "fact_transactions": FACT,
    "time_spine": f"""
with recursive bounds as (select min(submitted_date)::date as first, max(submitted_date)::date as last from ({FACT})),
days(date_day) as (select first from bounds union all select date_day + 1 from days, bounds where date_day < last)
select date_day from days
""",
    "metric_volume_by_day": _by_time("day"),
    "metric_volume_by_week": _by_time("week"),
    "metric_volume_by_month": _by_time("month"),
    "metric_all_by_chain": f"select chain, {ALL_M} from ({FACT}) f group by chain",
    "metric_rate_by_status_direction": f"""
select status, direction, {M_COUNT}, {M_CONFIRMED}, {M_RATE} from ({FACT}) f group by status, direction
""",
    "metric_by_user_dimension": f"""
select u.country_code as user_id__country_code, u.kyc_status as user_id__kyc_status,
       u.signup_channel as user_id__signup_channel, {M_VOLUME}, {M_COUNT}, {M_RATE}
from ({FACT}) f left join ({DIM_USERS}) u on f.user_id = u.user_id
group by 1, 2, 3
""",
    "metric_wallet_count": f"""
select country_code, cast(sum(wallet_count) as bigint) as wallet_count from ({DIM_USERS}) u group by country_code
""",
    "metric_wallets_by_signup_month": f"""
select date_trunc('month', user_created_at)::timestamp as metric_time__month, signup_channel,
       cast(sum(wallet_count) as bigint) as wallet_count
from ({DIM_USERS}) group by all
""",
    "metric_by_user_created_day": f"""
select u.user_created_at::date::timestamp as user_id__user_created_at, {M_VOLUME}, {M_COUNT}
from ({FACT}) f left join ({DIM_USERS}) u on f.user_id = u.user_id group by 1
""",
    "metric_filled_by_day": f"""
with f as ({FACT}),
spine as (select (first + cast(i as integer))::timestamp as metric_time__day
          from (select min(submitted_date)::date as first, max(submitted_date)::date as last from f),
               range(100000) as r(i) where first + cast(i as integer) <= last),
agg as (select date_trunc('day', submitted_at) as metric_time__day, {M_VOLUME}, {M_COUNT}, {M_AVG}
        from f group by 1)
select s.metric_time__day, coalesce(a.transaction_volume_usd, cast(0 as decimal(38,2))) as transaction_volume_usd,
       coalesce(a.transaction_count, 0) as transaction_count, a.avg_confirmation_seconds
from spine s left join agg a on s.metric_time__day = a.metric_time__day
""",
    "cdc_flatten": f"""
select 'users' as "table", user_id,
       case when event_type = 'error' then null else event_type end as event_type,
       case when event_type = 'error' then null else cast(value + 0.0 as decimal(18,2)) end as value,
       case when event_type = 'error' then null else cast(json_extract_string(props, '$.k') as bigint) end as k,
       {OP_CASE} as _cdc_op, {TS_MS} as _cdc_ts_ms, event_id as _cdc_lsn
from events where event_type <> 'click'
""",
    "cdc_quarantine": """
select 'app.public.users' as topic, event_id * 2 as "offset", 'm' as op, 'unsupported_op' as reason
from events where event_type = 'click'
""",
    "cdc_compact": COMPACT_PUBLISHED,
    "cdc_merge": COMPACT_PUBLISHED,
    "cdc_insert_only_merge": INSERT_ONLY,
    "union_sources": UNION_SOURCES,
    "top_n_per_key": """
select o_custkey, o_orderkey, o_orderdate, o_totalprice, rank from (
  select o_custkey, o_orderkey, o_orderdate, o_totalprice,
         row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rank
  from orders) x where rank <= 3
""",
    "scd2_apply": SCD2_APPLY,
    "scd2_from_log": HISTORY,
    "dim_users_history": f"""
select user_id, state, valid_from, valid_to, valid_to is null as is_current from ({HISTORY}) h
""",
    "as_of_join": AS_OF,
}


# --- data quality ------------------------------------------------------------
DOMAIN_HISTORY = f"""
select user_id, email, country_code, signup_channel, kyc_status, updated_at as valid_from,
       null::timestamp as valid_to, true as is_current
from ({STG_USERS})
"""

MODEL_SQL = {
    "stg_users": STG_USERS,
    "stg_wallets": STG_WALLETS,
    "stg_transactions": STG_TRANSACTIONS,
    "dim_users": DIM_USERS,
    "dim_users_history": DOMAIN_HISTORY,
    "dim_wallets": DIM_WALLETS,
    "fact_transactions": FACT,
    "bronze_wallets": BRONZE_WALLETS,
    "customer": "select * from customer",
    "lineitem": "select * from lineitem",
    "events_history": f"select *, valid_to is null as is_current from ({SCD2_APPLY}) h",
}


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def check_sql(c) -> str:
    """Failures of one declared check, as plain SQL over the model's SQL."""
    base = f"({MODEL_SQL[c.model]}) m"
    col = f"m.{c.column}"
    if c.kind == "not_null":
        fails = f"select count(*) filter (where {col} is null) as failures from {base}"
    elif c.kind == "accepted_values":
        vals = ", ".join(_lit(v) for v in c.values)
        fails = f"select count(*) filter (where {col} is not null and {col} not in ({vals})) as failures from {base}"
    elif c.kind == "range":
        fails = f"select count(*) filter (where {col} is not null and {col} < {_lit(c.min_value)}) as failures from {base}"
    elif c.kind in ("unique", "at_most_one"):
        extra = f" and m.{c.where}" if c.where else ""
        fails = (f"select count(*) as failures from (select {col} from {base} where {col} is not null{extra} "
                 f"group by {col} having count(*) > 1) x")
    elif c.kind == "relationships":
        fails = (f"select count(*) as failures from {base} where {col} is not null and not exists "
                 f"(select 1 from ({MODEL_SQL[c.to]}) p where p.{c.field} = {col})")
    else:
        raise ValueError(c.kind)
    return (f"select '{c.unique_id}' as unique_id, '{c.kind}' as kind, '{c.model}' as model, "
            f"'{c.column}' as column_name, cast(failures as bigint) as failures, "
            f"case when failures > 0 then 'fail' else 'pass' end as status, "
            f"case when failures > 0 then printf('Got %d results, configured to fail if != 0', failures) end "
            f"as message from ({fails}) f")


def checks_sql(checks) -> str:
    return "\nunion all\n".join(check_sql(c) for c in checks)


FAILURE_SET = "('fail', 'error', 'runtime error')"


def summary_sql(checks) -> str:
    return (f"select lower(coalesce(status, '')) as status, count(*) as n from ({checks_sql(checks)}) r "
            f"group by 1")


def failures_sql(checks) -> str:
    return (f"select unique_id, lower(coalesce(status, '')) as status, "
            f"trim(coalesce(message, '')) as message, cast(0.0 as double) as execution_time, "
            f"substr(trim(coalesce(message, '')), 1, 500) as alert_message "
            f"from ({checks_sql(checks)}) r where lower(coalesce(status, '')) in {FAILURE_SET}")


def alert_sql(checks, invocation_id: str = "suite", top_n: int = 10) -> str:
    return f"""
with norm as (select unique_id, lower(coalesce(status, '')) as status,
                     substr(trim(coalesce(message, '')), 1, 500) as message from ({checks_sql(checks)}) r),
hist as (select status, count(*) as n from norm group by status),
f as (select * from norm where status in {FAILURE_SET}),
top as (select rk, printf('%d) [%s] %s: %s', rk, upper(status), unique_id, message) as line
        from (select *, row_number() over (order by unique_id) as rk from f) x where rk <= {top_n}),
agg as (select (select count(*) from f) as failed,
               (select string_agg(printf('%s=%d', status, n), ', ' order by status) from hist) as counts,
               (select string_agg(line, chr(10) order by rk) from top) as lines)
select failed,
       case when failed > 0 then concat(failed, ' checks need attention in run {invocation_id}; by status: ',
            counts, chr(10), lines,
            case when failed > {top_n} then concat(chr(10), 'not listed: ', failed - {top_n}) else '' end)
       end as text
from agg
"""


def freshness_sql(as_of: str) -> str:
    parts = [("events", "ts", "select * from events"), ("users", "updated_at", BRONZE_USERS),
             ("wallets", "updated_at", BRONZE_WALLETS), ("transactions", "updated_at", BRONZE_TRANSACTIONS)]
    maxes = "\nunion all\n".join(f"select '{n}' as source, max({c}) as max_loaded_at from ({q}) s"
                                 for n, c, q in parts)
    age = f"cast((epoch_us(timestamp '{as_of}') - epoch_us(max_loaded_at)) as double) / 1000000"
    return f"""
select source, max_loaded_at, {age} as age_seconds,
       case when max_loaded_at is null then 'error' when {age} > 86400 then 'error'
            when {age} > 21600 then 'warn' else 'pass' end as status
from ({maxes}) x
"""


def _quality_oracles() -> dict[str, str]:
    from tidemark.operators.quality import Check
    from tidemark.plans import suite
    one_open = [Check("at_most_one", "dim_users_history", "user_id", where="is_current",
                      name="assert_one_current_row_per_user"),
                Check("at_most_one", "events_history", "user_id", where="is_current",
                      name="assert_one_current_row_per_events_user")]
    return {
        "dq_not_null": checks_sql(suite.NOT_NULL),
        "dq_unique": checks_sql(suite.UNIQUE + [c for c in suite.FAILING if c.kind == "unique"]),
        "dq_accepted_values": checks_sql(suite.ACCEPTED + [c for c in suite.FAILING if c.kind == "accepted_values"]),
        "dq_relationships": checks_sql(suite.RELATIONSHIPS),
        "dq_one_open_version": checks_sql(one_open),
        "dq_non_negative": checks_sql([c for c in suite.SINGULAR if c.kind == "range"]
                                      + [c for c in suite.FAILING if c.kind == "range"]),
        "dq_freshness": freshness_sql("2024-01-31 08:00:00"),
        "dq_summary": summary_sql(suite.ALL),
        "dq_failures": failures_sql(suite.ALL),
        "dq_alert_top": alert_sql(suite.ALL),
    }


ORACLE.update(_quality_oracles())


# --- scenarios, API bodies, landing and streams -------------------------------
ORACLE.update({
    "scd2_reconcile": f"""
with u as (select * from (select *, row_number() over (partition by user_id order by updated_at desc) as _rn
                          from ({BRONZE_USERS}) b) x where _rn = 1),
chosen as (select user_id from u where kyc_status = 'pending' order by user_id limit 25),
m as (select u.user_id, case when c.user_id is not null then timestamp '2030-01-01 00:00:00'
                             else u.updated_at end as updated_at
      from u left join chosen c on u.user_id = c.user_id),
v as (select user_id from u
      union all
      select m.user_id from m join u on m.user_id = u.user_id where m.updated_at > u.updated_at),
per_key as (select user_id, count(*) as versions from v group by user_id)
select versions, count(*) as users from per_key group by versions
""",
    "api_flatten": """
select cast(o_custkey as varchar) as address, 'ethereum' as chain, cast(o_orderkey as varchar) as hash,
       cast(o_custkey as varchar) as from_address, o_orderpriority as to_address,
       cast(o_totalprice as decimal(18,2)) as value, o_orderdate as time_stamp
from orders where o_custkey % 10 <> 0
""",
    "api_quarantine": """
with n as (select o_custkey, cast(ceil(count(*) / 200.0) as bigint) as pages from orders group by o_custkey)
select distinct cast(o.o_custkey as varchar) as address, o.o_orderkey % n.pages as page, '0' as status,
       'NOTOK' as message, 'api_error' as reason
from orders o join n on o.o_custkey = n.o_custkey where o.o_custkey % 10 = 0
""",
    "cdc_land_and_scan": CHANGES,
    "stream_append": f"select * from ({CHANGES}) c where _cdc_op <> 'd'",
    "stream_upsert": COMPACT_PUBLISHED,
})

ORACLE["onchain_land_and_scan"] = ONCHAIN
ORACLE["stream_land_topics"] = ORACLE["cdc_flatten"]
ORACLE["bronze_cdc_job"] = COMPACT_PUBLISHED
ORACLE["bronze_onchain_job"] = INSERT_ONLY
SNAPSHOTS = " union all ".join(
    f"""select {n} as run, user_id, any_value(state) as state, any_value(updated_at) as updated_at
from (select s.*, max(updated_at) over (partition by user_id) as newest from ({USER_STATES}) s
      where updated_at < timestamp '{until}') x where updated_at = newest group by user_id"""
    for n, until in enumerate(SNAPSHOT_RUNS, 1))
ORACLE["scd2_stored_runs"] = f"""
with seen as (select user_id, arg_min(state, run) as state, updated_at from ({SNAPSHOTS}) s group by user_id, updated_at)
select *, updated_at as valid_from, lead(updated_at) over (partition by user_id order by updated_at) as valid_to from seen
"""
# Users who are gone by the second run are closed at its instant.
ORACLE["scd2_hard_deletes"] = f"""
with seen as (select user_id, arg_min(state, run) as state, updated_at from ({SNAPSHOTS}) s
              where run = 1 or user_id % 7 <> 0 group by user_id, updated_at)
select *, updated_at as valid_from,
       case when user_id % 7 = 0 then timestamp '{SNAPSHOT_RUNS[1]}'
            else lead(updated_at) over (partition by user_id order by updated_at) end as valid_to from seen
"""
ORACLE["scd2_from_log_split"] = HISTORY
ORACLE["as_of_join_split"] = f"""
with h as ({HISTORY}), f as (select event_id, user_id, date_trunc('day', ts)::timestamp as ts from events)
select f.event_id, f.user_id, f.ts, h.state, h.valid_from, h.valid_to
from f left join h on f.user_id = h.user_id and f.ts >= h.valid_from
                  and f.ts < coalesce(h.valid_to, timestamp '9999-12-31 00:00:00')
"""
ORACLE["state_merge_on_read"] = COMPACT_PUBLISHED
ORACLE["state_rebucket"] = COMPACT_PUBLISHED
ORACLE["metric_filled_by_day_chain"] = f"""
with a as (select date_trunc('day', submitted_at) as metric_time__day, chain, {M_VOLUME}, {M_COUNT}, {M_AVG}
           from ({FACT}) f group by all),
days as (select chain, unnest(generate_series(min(metric_time__day)::timestamp, max(metric_time__day)::timestamp,
                                              interval 1 day)) as metric_time__day from a group by chain)
select d.metric_time__day, d.chain, coalesce(a.transaction_volume_usd, cast(0 as decimal(38,2))) as transaction_volume_usd,
       coalesce(a.transaction_count, 0) as transaction_count, a.avg_confirmation_seconds
from days d left join a on a.metric_time__day = d.metric_time__day and a.chain is not distinct from d.chain
"""
ORACLE["metric_filled_by_month"] = f"""
with a as (select date_trunc('month', submitted_at) as metric_time__month, status, direction, {M_COUNT}, {M_RATE}
           from ({FACT}) f group by all),
months as (select unnest(generate_series((select min(metric_time__month)::timestamp from a),
                                         (select max(metric_time__month)::timestamp from a), interval 1 month)) as metric_time__month),
kinds as (select distinct status, direction from a)
select m.metric_time__month, k.status, k.direction, coalesce(a.transaction_count, 0) as transaction_count, a.confirmed_transaction_rate
from months m cross join kinds k left join a on a.metric_time__month = m.metric_time__month
     and a.status is not distinct from k.status and a.direction is not distinct from k.direction
"""
ORACLE["metric_across_models"] = f"""
with u as (select * from ({DIM_USERS}) d),
t as (select signup_channel as c, date_trunc('month', submitted_at)::timestamp as m, {M_COUNT}
      from ({FACT}) f left join u on f.user_id = u.user_id group by all),
w as (select signup_channel as c, date_trunc('month', user_created_at)::timestamp as m,
             cast(sum(wallet_count) as bigint) as wallet_count from u group by all)
select coalesce(t.c, w.c) as user_id__signup_channel, coalesce(t.m, w.m) as metric_time__month,
       t.transaction_count, w.wallet_count
from t full outer join w on t.c is not distinct from w.c and t.m is not distinct from w.m
"""
ORACLE["bronze_cdc_job_bucketed"] = COMPACT_PUBLISHED
ORACLE["stream_upsert_bucketed"] = COMPACT_PUBLISHED
ORACLE["seed_build"] = FACT
ORACLE["dq_run_results_scan"] = ORACLE["dq_summary"]

# --- the three entities through change capture: what is left of the documented changes -----------
ENTITIES = {"users": (BRONZE_USERS, "user_id", "kyc_status", "updated_at"),
            "wallets": (BRONZE_WALLETS, "wallet_id", "wallet_type", "updated_at"),
            "transactions": (BRONZE_TRANSACTIONS, "transaction_id", "status", "amount")}


def _left(entity: str) -> str:
    bronze, key, marked, _ = ENTITIES[entity]
    return (f"select * replace (if({key} % 5 = 1, 'second', {marked}) as {marked}) from ({bronze}) "
            f"where {key} % 11 <> 3")


ORACLE["bronze_entities"] = " union all ".join(
    f"""select '{e}' as "table", {key} as "key", 'u' as op, epoch_ms(updated_at) as ts_ms,
               {key} * 10 + if({key} % 5 = 1, 2, 1) as lsn from ({_left(e)})"""
    for e, (_, key, _, _) in ENTITIES.items())
ORACLE["bronze_quarantine"] = " union all ".join(
    f"""select '{e}' as "table", '{reason}' as reason, count(*) as changes from ({bronze})
        where {key} % {divisor} = {rest} having count(*) > 0"""
    for e, (bronze, key, _, spoiled) in ENTITIES.items()
    for reason, divisor, rest in [(f"bad_{spoiled}", 17, 5), ("unsupported_op", 19, 6), ("missing_key", 23, 7),
                                  ("unparsable", 29, 8)])
ORACLE["stream_evolving_schema"] = f"""
select user_id, if(event_type = 'error', null, event_type) as event_type,
       if(event_type = 'error' or (later and event_type = 'click'), null, value + 0.0) as value,
       if(event_type <> 'error' and later, cast(json_extract_string(props, '$.k') as bigint), null) as k,
       if(event_type = 'click' and later, concat('about ', user_id), null) as value_text,
       {OP_CASE} as _cdc_op, {TS_MS} as _cdc_ts_ms, event_id as _cdc_lsn
from (select *, ts >= timestamp '2024-01-15 00:00:00' as later from events)
"""
ORACLE["stream_entities_fanout"] = ORACLE["bronze_entities"]
ORACLE["stream_append_rejects"] = ORACLE["bronze_quarantine"]
_REJECTED = [(17, 5), (19, 6), (23, 7), (29, 8)]
_APPLIED = [(7, 0), (5, 1), (11, 3), (13, 4)]
_PER_KEY = "select " + ", ".join(
    f"{base} + " + " + ".join(f"cast(sum(if({{key}} % {d} = {r}, 1, 0)) as bigint)" for d, r in kinds) + f" as {name}"
    for name, base, kinds in [("accepted", "2 * count(*)", _APPLIED), ("rejected", "0", _REJECTED)]) + " from ({bronze})"
ORACLE["stream_progress"] = "select cast(sum(accepted + rejected) as bigint) as total, cast(sum(accepted) as bigint) as accepted, " \
    "cast(sum(rejected) as bigint) as rejected from (" + " union all ".join(
        _PER_KEY.format(key=key, bronze=bronze) for bronze, key, _, _ in ENTITIES.values()) + ")"
ORACLE["stg_users_from_bronze"] = f"""
select user_id, trim(lower(email)) as email, upper(country_code) as country_code, signup_channel, kyc_status,
       created_at, updated_at from ({_left("users")})
"""
ORACLE["stg_wallets_from_bronze"] = f"""
select * replace (lower(chain) as chain, lower(address) as address) from ({_left("wallets")})
"""
ORACLE["stg_transactions_from_bronze"] = STG_TRANSACTIONS.replace(
    _newest(BRONZE_TRANSACTIONS, "transaction_id"), _left("transactions"))
ORACLE["fact_from_bronze"] = FACT.replace(STG_TRANSACTIONS, ORACLE["stg_transactions_from_bronze"]).replace(
    STG_WALLETS, ORACLE["stg_wallets_from_bronze"])

# --- users after two snapshot runs ------------------------------------------------
RECONCILED = "timestamp '2030-01-01 00:00:00'"
ORACLE["dim_users_history_two_runs"] = f"""
with u as ({STG_USERS})
select user_id, email, country_code, signup_channel, kyc_status, updated_at as valid_from,
       case when kyc_status = 'pending' then {RECONCILED} end as valid_to, kyc_status <> 'pending' as is_current
from u where user_id % 41 <> 0 or kyc_status <> 'pending'
union all
select user_id, email, country_code, signup_channel, 'verified', {RECONCILED}, null, true
from u where kyc_status = 'pending'
"""
ORACLE["dim_users_two_runs"] = f"""
select * replace (if(kyc_status = 'pending', 'verified', kyc_status) as kyc_status,
                  if(kyc_status = 'pending', {RECONCILED}, user_updated_at) as user_updated_at)
from ({DIM_USERS})
"""
