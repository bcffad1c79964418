"""DuckDB SQL for the registered queries. Tables and the SQL of the feeds are shared with them; what is tested is done anew."""

from __future__ import annotations

from changeflow.functions.columns import LAST_MILLIS
from changeflow.plans.feeds import CHANGES, CUTS, ENVELOPE, ERAS, FULL_CHANGES, MARKS, VERSIONED

_ENV = f"with e as ({ENVELOPE}), r as (select *, case dbz_op when 'u' then 'u' when 'd' then 'd' else 'i' end as op from e)"
_GOOD = _ENV + ", g as (select * from r where case when json_valid(body) then json_type(body) = 'OBJECT' else false end)"
_CH = f"with c as ({CHANGES}), o as (select * from c where tbl = 'public.orders' and kind in ('insert', 'copy', 'update', 'delete') and not (kind = 'delete' and old_kind is null))"
_IMAGES = (
    _CH
    + """, n as (
  select case kind when 'update' then 'u' when 'delete' then 'd' else 'i' end as op, lsn, k,
    case when kind = 'delete' then null else custkey end as custkey,
    case when kind <> 'delete' then status when old_kind = 'full' then old_status end as status,
    case when kind <> 'delete' then price when old_kind = 'full' then old_price end as price
  from o)"""
)
_TARGET = "t as (select o_orderkey as k, o_custkey as custkey, 'OLD' as status, cast(o_totalprice as decimal(18,2)) as price from orders where o_orderkey % 2 = 0)"


def _encoded(column: str) -> str:
    return f"url_encode({column})"


_VERSIONS = "v as (select 'public.orders' as tbl, min(o_orderkey) * 10 as snapshot_id from orders group by o_custkey)"

ORACLE_SQL = {
    "envelope_raw": _ENV + """ select op, stream, seq_num, ts as "timestamp", case when dbz_op is not null then '{"dbz.op":"' || dbz_op || '"}' end as headers, body from r""",
    "restore_op": _ENV + " select op, count(*) as n_rows from r group by op",
    "stream_exact": _ENV + " select stream, seq_num, event_id from r where stream in ('events/click', 'events/view')",
    "stream_prefix": _ENV + " select stream, seq_num, event_id from r where starts_with(stream, 'events/p')",
    "resume_positions": _ENV + ", s as (select stream, count(*) // 2 as n from r where stream <> 'events/click' group by stream) select stream, seq_num from r left join s using (stream) where seq_num >= coalesce(n, 0)",
    "resume_latest": _ENV + ", s as (select stream, case when stream = 'events/click' then count(*) // 2 else max(seq_num) + 1 end as n from r group by stream) select stream, seq_num from r join s using (stream) where seq_num >= n",
    "decode_skip": _GOOD + " select op, cast(body->>'$.event_id' as bigint) as event_id, cast(body->>'$.user_id' as bigint) as user_id, body->>'$.event_type' as event_type from g",
    "decode_metadata": _GOOD + " select op, cast(body->>'$.event_id' as bigint) as event_id, body->>'$.user_id' as user_id, stream, seq_num, ts as \"at\" from g",
    "malformed_report": _GOOD + " select stream, count(*) as n_rows, min(seq_num) as first_seq from r where event_id not in (select event_id from g) group by stream",
    "headers_json": _ENV + """ select stream, seq_num, '{"a":"' || event_type || '",' || case when dbz_op is not null then '"dbz.op":"' || dbz_op || '",' else '' end || '"k":"2"}' as headers from r""",
    "table_demux": _CH + " select k, lsn, kind from c where tbl = 'public.customer'",
    "unclaimed": _CH + " select tbl, count(*) as events from c where tbl <> 'public.orders' group by tbl",
    "normalized": _IMAGES + " select op, lsn, k, custkey, status, price from n",
    "update_before": _IMAGES + """ select op, lsn, case when op = 'u' and exists (select 1 from o where o.lsn = n.lsn and kind = 'update' and old_kind = 'full') then 1 else 0 end::int as seq, k, custkey, status, price from n
      union all select 'd', lsn, 0, k, null, old_status, old_price from o where kind = 'update' and old_kind = 'full'""",
    "key_only_delete": _IMAGES + " select k, status, price from n where op = 'd'",
    "partial_update": _IMAGES + " select op, lsn, k, custkey, case when k % 3 <> 0 then status end as status, price from n where op <> 'd'",
    "aligned": "select o_orderstatus, cast(null as int) as o_missing, o_orderkey from orders",
    "coerced_cells": "select cast(null as varchar) as o_orderkey, try_cast(o_orderstatus as bigint) as status, o_custkey as custkey, o_orderkey as key_text from orders",
    "cell_texts": """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as ts, strftime(ts, '%Y-%m-%d') as day, cast(cast(value as decimal(18,2)) as varchar) as amount,
      to_base64(encode(event_type)) as raw, '[' || event_id || ',null]' as list from events""",
    "snapshot_plus_changes": _IMAGES + " select 'i' as op, 0::bigint as lsn, 0::bigint as ord, o_orderkey as k, o_orderstatus as status from orders union all select op, lsn, 0, k, status from n where op <> 'i'",
    "current_state": _IMAGES + " select op, lsn, k, custkey, status, price from n where op <> 'd' qualify row_number() over (partition by k order by lsn desc) = 1 and not exists (select 1 from n d where d.k = n.k and d.op = 'd' and d.lsn > n.lsn)",
    "first_write_wins": _IMAGES + """, a as (select * from n union all select op, lsn + 5, k, custkey, 'A', price from n where op = 'i' and k % 10 = 0),
      x as (select *, (select max(lsn) from a d where d.k = a.k and d.op = 'd') as gone from a)
      select op, lsn, k, custkey, status, price from x where op <> 'd' and lsn > coalesce(gone, -1) qualify row_number() over (partition by k order by lsn) = 1""",
    "retraction_totals": f"""with c as ({FULL_CHANGES}), x as (select status, price, 1 as s from c where kind <> 'delete' union all select old_status, old_price, -1 from c where old_kind = 'full')
      select status, sum(s)::bigint as n_rows, sum(price * s) as sum_price from x group by status""",
    "op_counts": _IMAGES + """ select k % 8 as part, count(*) as n_rows, count(*) filter (op = 'i') as n_inserts, count(*) filter (op = 'u') as n_updates, count(*) filter (op = 'd') as n_deletes from n group by 1""",
    "apply_upsert": _IMAGES + f", {_TARGET}, l as (select * from n qualify row_number() over (partition by k order by lsn desc) = 1) select k, custkey, status, price from l where op <> 'd' union all select * from t where k not in (select k from n)",
    "apply_ignore": _IMAGES + f", {_TARGET}, l as (select * from n where op <> 'd' qualify row_number() over (partition by k order by lsn) = 1) select * from t union all select k, custkey, status, price from l where k not in (select k from t)",
    "apply_delete": _IMAGES + f", {_TARGET} select * from t where k not in (select k from n where op = 'd')",
    "append_without_keys": _IMAGES + f", {_TARGET} select * from t union all select k, custkey, status, price from n where op = 'u'",
    "hive_segment": "select p_partkey, 'odd=' || " + _encoded("'foo/bar=baz*~ +é' || p_partkey") + " || '/name=' || coalesce(" + _encoded("case when p_partkey % 10 <> 0 then p_name end") + ", '__HIVE_DEFAULT_PARTITION__') as segment from part",
    "layout_counts": "select 'event_type=' || coalesce(case when event_id % 10 <> 0 then event_type end, '__HIVE_DEFAULT_PARTITION__') || '/day=' || strftime(ts, '%Y-%m-%d') as segment, count(*) as n_rows from events group by 1",
    "sql_filter": _GOOD + " select op, cast(body->>'$.event_id' as bigint) as event_id, cast(body->>'$.user_id' as bigint) as user_id, body->>'$.event_type' as event_type from g where event_id % 2 = 0",
    "row_json": """select '{"event_id":' || event_id || case when event_id % 3 <> 0 then ',"event_type":"' || event_type || '"' else '' end || ',"user_id":' || user_id || '}' as body from events""",
    "relational_cells": """select event_id, case when event_id % 2 = 0 or microsecond(ts) % 1000000 = 0 then strftime(ts, '%Y-%m-%d %H:%M:%S') else strftime(ts, '%Y-%m-%d %H:%M:%S.%f') end as "at",
      strftime(ts, '%Y-%m-%d') as day, cast(cast(value as decimal(18,2)) as varchar) as amount from events""",
    "log_records": _IMAGES + """ select 'orders' as stream, 'dbz.op' as header, case op when 'i' then 'c' else op end as code,
      '{"k":' || k || case when status is not null then ',"status":"' || status || '"' else '' end || ',"lsn":' || lsn || '}' as body from n""",
    "routed": "select event_id, event_type, user_id, 'events/' || event_type || '/by-' || user_id as stream from events",
    "stream_runs": _ENV + """, s as (select event_id % 997 as source, stream, event_id, row_number() over (partition by event_id % 997 order by event_id) - row_number() over (partition by event_id % 997, stream order by event_id) as run from r)
      select source, stream, min(event_id) as first, max(event_id) as last, count(*) as n_rows from s group by source, stream, run""",
    "batched_messages": """with n as (select user_id, event_id, row_number() over (partition by user_id order by event_id) - 1 as i from events)
      select user_id, i // 10 as batch, count(*) as n_messages, string_agg('{"user_id":' || user_id || ',"event_id":' || event_id || '}', '|' order by i) as bodies from n group by user_id, i // 10""",
    "u256_text": "select event_id, cast(event_id as varchar) as small, '115792089237316195423570985008687907852929702298719625575994' || cast(209400481361428480 + event_id as varchar) as large from events",
    "u256_round_trip": """with t as (select event_id, '115792089237316195423570985008687907853269984665640564039457' || lpad(cast(584007913129639935 - event_id as varchar), 18, '0') as text from events)
      select event_id, text, repeat('f', 48) || lower(hex(18446744073709551615::ubigint - event_id::ubigint)) as raw, text as back from t""",
    "hashed_names": "select p_partkey, cast(('0x' || substr(sha256(p_name), 1, 16))::ubigint as varchar) as id from part",
    "next_positions": _ENV + " select stream, max(seq_num) + 1 as next_seq from r group by stream",
    "progress_merge": _ENV + """, old as (select stream, max(seq_num + case when stream = 'events/view' then 100000 else -3 end) + 1 as n from r where event_id % 2 = 0 and stream <> 'events/click' group by stream),
      new as (select stream, max(seq_num) + 1 as m from r group by stream) select stream, greatest(n, m) as next_seq from old left join new using (stream)""",
    "stream_catalog_diff": _ENV + """, l as (select distinct stream from r where stream <> 'events/view'), k as (select distinct unnest([stream, stream || '-gone', 'events/pinned']) as stream from r where stream in ('events/click', 'events/view'))
      select stream, 'new' as change from l where stream not in (select stream from k) union all select stream, 'removed' from k where stream not in (select stream from l) and stream <> 'events/pinned'""",
    "versions_asof": _CH + f", {_VERSIONS} select c.tbl, c.k, c.lsn, c.kind, v.snapshot_id from c asof left join v on c.tbl = v.tbl and c.lsn >= v.snapshot_id",
    "versions_pruned": f"with {_VERSIONS} select tbl, snapshot_id from v where snapshot_id >= coalesce((select max(snapshot_id) from v where snapshot_id <= 5000), 0) union all select 'public.customer', snapshot_id from v",
    "lossy_bodies": "select event_id, case when event_id % 3 = 0 then event_type || chr(65533) || 'A' || chr(65533) else event_type end as body from events",
    "clamped_timestamps": f"select event_id, case when event_id % 4 = 0 then {LAST_MILLIS} else epoch_us(ts) // 1000 end as millis from events",
    "split_operations": _IMAGES + " select case op when 'd' then 'gone' else 'put' end as part, k, lsn from n",
    "body_sizes": _IMAGES + """, b as (select '{"k":' || k || ',"lsn":' || lsn || '}' as body from n) select 'orders' as stream, strlen(body) as n_bytes, body from b""",
    "staged_ignores": _IMAGES + """, x as (select *, max(lsn) filter (op = 'd') over (partition by k) as gone from n),
      live as (select * from x where op <> 'd' and lsn > coalesce(gone, -1) qualify row_number() over (partition by k order by lsn) = 1)
      select k, op, gone is not null as cleared, status from live union all select distinct k, 'd', true, null from n where k not in (select k from live)""",
    "deduped_replay": _ENV + " select stream, seq_num, event_id from r",
}

ORACLE_SQL["folded_log"] = ORACLE_SQL["current_state"]

_LEFT = f"""with c as ({FULL_CHANGES}), l as (select * from c where kind in ('insert', 'update', 'delete') qualify row_number() over (partition by k order by lsn desc) = 1),
  s as (select status, price from l where kind <> 'delete' and price is not null)"""
ORACLE_SQL["extremes_under_retraction"] = _LEFT + """ select status, count(*) as n_values, count(distinct price) as n_distinct, min(price) as min_price, max(price) as max_price,
  (select string_agg(cast(price as varchar), ',' order by price desc) from (select price from s x where x.status = s.status order by price desc limit 3)) as top_price from s group by status"""
ORACLE_SQL["null_operation_counts"] = _CH + " select tbl, count(*) as n_rows, count(*) filter (k % 11 = 0) as n_rejected from c group by tbl"
ORACLE_SQL["log_runs"] = _ENV + """, s as (select case when event_id % 40 < 25 then 'events/most' else stream end as stream, event_id from r),
  n as (select *, row_number() over (order by event_id) - row_number() over (partition by stream order by event_id) as run from s)
  select stream, min(event_id) as first, max(event_id) as last, count(*) as n_rows from n group by stream, run"""
ORACLE_SQL["batches_of_one_user"] = """with n as (select event_id, row_number() over (order by event_id) - 1 as i from events)
  select i // 10 as batch, count(*) as n_messages, string_agg('{"user":1,"event_id":' || event_id || '}', '|' order by i) as bodies from n group by i // 10"""
ORACLE_SQL["nested_bytes"] = """select '{"event_id":' || event_id || ',"s":{"b":"' || lower(hex(event_type)) || '","l":["' || lower(hex(event_type)) || '",null]},"n":"' || event_id || '"}' as body from events"""
_RANGE = "case " + " ".join(f"when k < {c} then {r}" for r, c in enumerate(CUTS)) + f" else {len(CUTS)} end"
_MARKS = "m as (select * from (values " + ", ".join(map(str, MARKS)) + ") as t(range, low, high))"
ORACLE_SQL["snapshot_ranges"] = _IMAGES + f""", {_MARKS}, old as (select o_orderkey as k from orders where o_orderkey % 9 <> 0),
  copied as (select k, low, high from (select k, {_RANGE} as range from old) join m using (range)),
  a as (select 'i' as op, low as lsn, k, 'COPY' as status, 1 as late from copied p where not exists (select 1 from n where n.k = p.k and n.lsn > p.low and n.lsn <= p.high)
        union all select op, lsn, k, status, 0 from n),
  l as (select * from a qualify row_number() over (partition by k order by lsn desc, late desc) = 1) select k, op, lsn, status from l where op <> 'd'"""
_ERA = "case " + " ".join(f"when lsn >= {at} then {at}" for at, _ in reversed(ERAS)) + " end"
ORACLE_SQL["decoded_by_version"] = f"""with v as ({VERSIONED}), e as (select *, {_ERA} as snapshot_id from v)
  select lsn, snapshot_id, case when snapshot_id is not null then try_cast(body->>'$.k' as bigint) end as k, case when snapshot_id >= 20000 then cast(body->>'$.cust' as bigint) end as cust,
    case when snapshot_id < 90000 then body->>'$.status' end as status,
    case when snapshot_id is null or k % 83 = 0 then true else false end as malformed from e"""
ORACLE_SQL["log_source"] = _ENV + """ select op, stream, seq_num, epoch_us(ts) // 1000 as "timestamp", case when dbz_op is not null then '{"dbz.op":"' || dbz_op || '"}' end as headers, body from r"""
ORACLE_SQL["log_sink"] = _IMAGES + """ select 'orders' as stream, case op when 'i' then 'c' else op end as code, '{"k":' || k || ',"lsn":' || lsn || '}' as body from n"""
