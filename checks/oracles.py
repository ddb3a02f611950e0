"""The same queries in SQL over the same tables, for DuckDB."""

from __future__ import annotations

from checks.inputs import AVRO_LOGICAL, AVRO_NESTED, AVRO_PLAIN, CHANGES_READ_AT, CONSUMES, FIRST_CONSUME, SECOND_CONSUME, SNAPSHOT_AT
from checks.queries import KNOWN, PAGE, UNKNOWN

ORACLES: dict[str, str] = {}


def _micros(at) -> int:
    return round(at.timestamp() * 1_000_000)


T0, T1, T2 = _micros(SNAPSHOT_AT), _micros(FIRST_CONSUME), _micros(SECOND_CONSUME)
_RFC = "'%Y-%m-%dT%H:%M:%SZ'"

# Snapshots

ORACLES["snapshot_high_watermark"] = "select max(l_orderkey) high_watermark from lineitem"

ORACLES["snapshot_bounded"] = """
select * replace (epoch_us(l_shipdate) as l_shipdate) from lineitem
where l_shipdate <= (select max(l_shipdate) from lineitem)"""

ORACLES["snapshot_resume"] = """
select * from customer
where c_custkey > (select floor(avg(c_custkey)) from customer) and c_custkey <= (select max(c_custkey) from customer)"""

ORACLES["snapshot_page"] = """
select * from customer
where c_custkey > 49 and c_custkey <= (select max(c_custkey) from customer) order by c_custkey limit 100"""

ORACLES["snapshot_projection"] = "select p_partkey, p_brand, p_retailprice from part"

ORACLES["snapshot_records"] = f"""
select 0::bigint seq, 'snapshot' operation, 'supplier' table_name, {T0} read_at, null::varchar "before",
  '{{"IteratorType":"s","SnapshotLastProcessedVal":' || s_suppkey || ',"SnapshotMaxValue":'
    || (select max(s_suppkey) from supplier) || ',"IndexInBatch":0,"BatchID":0,"Time":"2024-02-01T00:00:00Z"}}' "position",
  json_object('s_suppkey', s_suppkey)::varchar "key",
  json_object('s_acctbal', s_acctbal, 's_name', s_name, 's_nationkey', s_nationkey, 's_suppkey', s_suppkey)::varchar "after"
from supplier"""

ORACLES["snapshot_records_resume"] = (
    ORACLES["snapshot_records"] + " where s_suppkey > (select floor(avg(s_suppkey)) from supplier)"
)

# Change feed and change log

_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _changes(old: str, new: str, name: str) -> str:
    """CTEs with the changes from one version to another: the columns, action and is_update."""

    def half(side: str, action: str, is_update: str) -> str:
        columns = ", ".join(f"{side}.{c} {c}" for c in _COLUMNS)
        return f"select {columns}, '{action}' \"action\", {is_update} is_update from {name}_pairs"

    return f"""
{name}_pairs as (
  select o, n, o.o_orderkey is not null had, n.o_orderkey is not null has
  from {old} o full join {new} n on o.o_orderkey = n.o_orderkey
  where row(o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority)
    is distinct from row(n.o_orderkey, n.o_custkey, n.o_orderstatus, n.o_totalprice, n.o_orderdate, n.o_orderpriority)),
{name} as (
  {half('o', 'DELETE', 'had and has')} where had
  union all
  {half('n', 'INSERT', 'had and has')} where has)"""


_VERSIONS = """
v1 as (select * from orders),
v2 as (
  select * replace (case when o_orderstatus = 'P' then o_totalprice + 1 else o_totalprice end as o_totalprice)
  from orders where o_orderpriority <> '5-LOW'
  union all
  select * replace (-1 - o_orderkey as o_orderkey) from orders where o_orderpriority = '1-URGENT')"""
_ROW_ID = "sha256('{\"o_orderkey\":' || o_orderkey || '}')"
_FORWARD = f"with {_VERSIONS}, {_changes('v1', 'v2', 'forward')}"

ORACLES["table_net_changes"] = f"""
{_FORWARD} select * replace (epoch_us(o_orderdate) as o_orderdate), {_ROW_ID} row_id from forward"""

ORACLES["table_net_change_counts"] = f"""
{_FORWARD} select "action", is_update, count(*) n from forward group by all"""

ORACLES["change_log_consume"] = f"""
{_FORWARD} select * replace (epoch_us(o_orderdate) as o_orderdate), {_ROW_ID} row_id, {T1} consumed_at,
  row_number() over (order by md5(row_id), row_id, is_update, "action") - 1 "row_number" from forward"""

_LOG = f"""{_FORWARD}, {_changes('v2', 'v1', 'backward')},
log as (
  select *, {_ROW_ID} row_id, {T1} consumed_at from forward
  union all
  select *, {_ROW_ID} row_id, {T2} consumed_at from backward),
numbered as (
  select *, row_number() over (order by consumed_at, md5(row_id), row_id, is_update, "action") - 1 "row_number",
    "row_number" - "row_number" % {PAGE} batch_id, "row_number" % {PAGE} index_in_batch
  from log)"""
_LOG_ROW = 'o_orderkey, o_totalprice, "action", is_update, consumed_at'

ORACLES["change_log_page"] = f"""
{_LOG} select {_LOG_ROW}, "row_number" from numbered order by "row_number" limit {PAGE} offset 2500"""

ORACLES["change_log_batches"] = f"{_LOG} select {_LOG_ROW}, batch_id, index_in_batch from numbered"

ORACLES["change_log_resume"] = f"""
{_LOG} select {_LOG_ROW}, batch_id, index_in_batch from numbered where "row_number" > 1249"""

_COLLAPSED = "numbered where not (\"action\" = 'DELETE' and is_update)"
_OPERATION = "case when \"action\" = 'DELETE' then 'delete' when is_update then 'update' else 'create' end"

ORACLES["cdc_collapse_pairs"] = f"{_LOG} select {_LOG_ROW} from {_COLLAPSED}"
ORACLES["cdc_classify"] = f"{_LOG} select o_orderkey, consumed_at, {_OPERATION} operation from {_COLLAPSED}"
ORACLES["stream_change_log"] = ORACLES["cdc_classify"]
ORACLES["stream_resume"] = ORACLES["change_log_resume"]

ORACLES["stream_consume"] = f"""
{_FORWARD}, parts as (
  select *, {_ROW_ID} row_id, {T1} + ((o_orderkey % {CONSUMES} + {CONSUMES}) % {CONSUMES}) * 3600000000 consumed_at from forward)
select * replace (epoch_us(o_orderdate) as o_orderdate),
  row_number() over (order by consumed_at, md5(row_id), row_id, is_update, "action") - 1 "row_number" from parts"""

ORACLES["number_any_log"] = f"""
with n as (select event_id, row_number() over (order by event_type, ts, event_id) - 1 "row_number" from events)
select *, "row_number" - "row_number" % {PAGE} batch_id, "row_number" % {PAGE} index_in_batch from n"""

_ORDER_JSON = f"""json_object('o_custkey', o_custkey, 'o_orderdate', strftime(o_orderdate, {_RFC}), 'o_orderkey', o_orderkey,
  'o_orderpriority', o_orderpriority, 'o_orderstatus', o_orderstatus, 'o_totalprice', o_totalprice)::varchar"""

ORACLES["cdc_payload_json"] = f"select o_orderkey, {_ORDER_JSON} payload from orders"

ORACLES["cdc_record_key"] = """
select json_object('conv_id', conv_id, 'turn', turn)::varchar "key", role from conversations"""

_TIME = f"case consumed_at when {T1} then '2024-03-01T12:00:00Z' else '2024-03-02T12:00:00.25Z' end"
_POSITION = f"""'{{"IteratorType":"c","SnapshotLastProcessedVal":null,"SnapshotMaxValue":null,"IndexInBatch":' || index_in_batch
  || ',"BatchID":' || batch_id || ',"Time":"' || {_TIME} || '"}}'"""

ORACLES["record_position"] = f'{_LOG} select o_orderkey, "action", {_POSITION} "position" from numbered'

ORACLES["cdc_records"] = f"""
{_LOG} select "row_number" seq, {_POSITION} "position", {_OPERATION} operation, 'orders' table_name, consumed_at read_at,
  json_object('o_orderkey', o_orderkey)::varchar "key", null::varchar "before",
  case when "action" = 'INSERT' then {_ORDER_JSON} end "after"
from {_COLLAPSED}"""

ORACLES["snapshot_then_cdc"] = f"""
{_LOG} select 0 phase, 0::bigint seq, 'snapshot' operation, o_orderkey, {_ORDER_JSON} "after" from orders
union all
select 1, "row_number", {_OPERATION}, o_orderkey, case when "action" = 'INSERT' then {_ORDER_JSON} end from {_COLLAPSED}"""

# Batches

_EVENT_OPERATION = """case event_type when 'signup' then 'create' when 'view' then 'snapshot' when 'error' then 'delete'
  else 'update' end"""
_EVENT_JSON = """json_object('event_id', event_id, 'event_type', event_type, 'props', props, 'user_id', user_id,
  'value', value)::varchar"""

ORACLES["payload_side"] = f"""
select event_id seq, {_EVENT_OPERATION} operation, {_EVENT_JSON} payload from events"""

ORACLES["decode_payload"] = """
select event_id, event_type, user_id, value, (props->>'$.k')::bigint k from events"""

_MIXED = """
mixed as (
  select event_id, json_object(
    'whole', user_id,
    'number', value,
    'whole_or_number', case when event_type = 'purchase' then to_json(value) else to_json(user_id) end,
    'whole_or_text', case when event_type = 'view' then to_json(user_id) else to_json(props) end,
    'sometimes', case when event_type <> 'error' then user_id end,
    'never', null,
    'flag', event_type = 'click',
    'nested', props::json,
    'text', event_type) payload
  from events)"""
_FIELD_TYPES = """
kinds as (
  select distinct e.key field, case when e.type in ('BIGINT', 'UBIGINT') then 'integer' when e.type = 'DOUBLE' then 'float'
    when e.type = 'BOOLEAN' then 'boolean' when e.type <> 'NULL' then 'varchar' end kind
  from {source}, json_each(payload) e),
types as (
  select field, case when count(kind) = 0 then 'variant' when count(kind) = 1 then max(kind)
    when bool_and(kind in ('integer', 'float')) then 'float' else 'varchar' end logical_type
  from kinds group by field)"""

ORACLES["payload_field_types"] = f"with {_MIXED}, {_FIELD_TYPES.format(source='mixed')} select * from types"

ORACLES["infer_schema_first"] = f"""
with {_MIXED}, head as (select * from mixed where event_id = (select min(event_id) from events)),
{_FIELD_TYPES.format(source='head')} select * from types"""

ORACLES["infer_schema_nested"] = """
select event_id id, (props->>'$.k')::bigint k, event_type = 'click' flag,
  case when event_type = 'view' then value::decimal(18,2)::double else 7::double end "second",
  case when event_type = 'error' then 0 else 2 end::bigint objects, case when event_type <> 'error' then user_id end a,
  case when event_type = 'view' then value end b, case when event_type = 'signup' then user_id::varchar else event_type end mixed
from events"""

ORACLES["avro_schema_nested"] = """
select event_id id, case when event_type <> 'error' then props end maybe, user_id "first", value a, user_id x,
  case when event_type <> 'click' then value end y, event_type kind, case when event_type <> 'view' then epoch_us(ts) end maybe_at
from events"""

# The logical types of the three schemas of the input, field by field.
_AVRO = {
    AVRO_PLAIN: "flag boolean, small integer, big integer, single float, twice float, raw varchar, text varchar",
    AVRO_LOGICAL: "price float, cents float, uid varchar, day date, clock timestamp_tz, at timestamp_tz, plainlong integer",
    AVRO_NESTED: "maybe varchar, maybe_at timestamp_tz, list array, lookup object, inner object, kind varchar",
}
_AVRO_ROWS = ", ".join(
    f"('{text}', '{pair.split()[0]}', '{pair.split()[1]}')" for text, pairs in _AVRO.items() for pair in pairs.split(", ")
)
ORACLES["avro_field_types"] = f"""
with carried as (
  select case when event_type in ('signup', 'view') then '{AVRO_PLAIN}' when event_type = 'error' then '{AVRO_LOGICAL}'
    else '{AVRO_NESTED}' end text, count(*) records
  from events group by 1),
expected(text, field, logical_type) as (values {_AVRO_ROWS})
select sha256(text) schema_id, records, field, logical_type from carried join expected using (text)"""

ORACLES["bookkeeping_layout"] = """
select null::varchar operation, null::bigint created_at, null::bigint updated_at, null::bigint deleted_at, * from part"""

_BATCH = f"""
batch as (
  select event_id seq, {_EVENT_OPERATION} operation, epoch_us(ts) - (event_id * 7919 % 1009) * 600000000 read_at,
    user_id id, value, props
  from events)"""


def _winners(part: str = "0") -> str:
    """CTEs with the latest record per key (and part), found by going through each key in order."""
    return f"""{_BATCH},
seen as (
  select *, {part} part, max(case when operation = 'update' then read_at end) over (
    partition by {part}, id order by seq rows between unbounded preceding and 1 preceding) earlier
  from batch),
winners as (
  select * from seen where operation <> 'update' or earlier is null or read_at > earlier
  qualify row_number() over (partition by part, id order by seq desc) = 1),
rendered as (
  select part, id, operation,
    case when operation in ('create', 'snapshot') then read_at end created_at,
    case when operation = 'update' then read_at end updated_at,
    case when operation = 'delete' then read_at end deleted_at,
    case when operation <> 'delete' then value end value,
    case when operation <> 'delete' then props end props
  from winners)"""


ORACLES["compact_latest"] = f"with {_winners()} select id, seq, operation, read_at, value, props from winners"

ORACLES["compact_carry_created"] = f"""
with {_winners()}, made as (select id, seq, read_at from batch where operation in ('create', 'snapshot'))
select id, w.seq, operation, w.read_at, value, props,
  (select arg_max(m.read_at, m.seq) from made m where m.id = w.id and m.seq <= w.seq) created_at
from winners w"""

ORACLES["compact_dropped_updates"] = f"""
with {_winners()} select id, seq, operation, read_at, value, props from seen
where operation = 'update' and read_at <= earlier"""

ORACLES["render_rows"] = f"with {_winners()} select * exclude (part) from rendered"
ORACLES["route_inserts"] = ORACLES["render_rows"] + " where operation in ('create', 'snapshot')"
ORACLES["route_updates"] = ORACLES["render_rows"] + " where operation in ('update', 'delete')"

_TARGET = """
target as (
  select case o_orderstatus when 'O' then 'update' when 'P' then 'delete' else 'snapshot' end operation,
    epoch_us(o_orderdate) created_at,
    case when o_orderstatus = 'O' then epoch_us(o_orderdate) + 86400000000 end updated_at,
    case when o_orderstatus = 'P' then epoch_us(o_orderdate) + 172800000000 end deleted_at,
    o_custkey, o_orderkey, o_orderpriority, o_totalprice
  from orders)"""

ORACLES["encode_text"] = f"""
with {_TARGET} select operation cdc_operation, created_at::varchar cdc_created_at,
  coalesce(updated_at::varchar, '') cdc_updated_at, coalesce(deleted_at::varchar, '') cdc_deleted_at,
  o_custkey::varchar o_custkey, o_orderkey::varchar o_orderkey, o_orderpriority, o_totalprice::varchar o_totalprice,
  strftime(make_timestamp(created_at), '%Y-%m-%d') o_day
from target"""

# Staging

ORACLES["stage_roundtrip_csv"] = """
with d as (select *, doc_id * 1000003 read_at, case lang when 'en' then 'create' when 'fr' then 'snapshot' else 'update' end op
  from documents)
select op operation, case when op <> 'update' then read_at end created_at, case when op = 'update' then read_at end updated_at,
  null::bigint deleted_at, doc_id, lang, n_chars, nullif(source, '') source, nullif(text, '') text
from d"""

ORACLES["stage_roundtrip_parquet"] = """
select 'create' operation, page_id * 1000003 created_at, null::bigint updated_at, null::bigint deleted_at, html, page_id, url
from pages"""

ORACLES["schema_check_report"] = f"""
with j as (select {_ORDER_JSON} payload from orders),
{_FIELD_TYPES.format(source='j')},
theirs(name, target_type) as (values ('o_orderkey', 'integer'), ('o_custkey', 'integer'), ('o_orderstatus', 'varchar'),
  ('o_totalprice', 'float'), ('o_orderdate', 'timestamp_ntz'), ('o_comment', 'varchar'))
select coalesce(lower(field), name) "column", logical_type batch_type, target_type,
  case when target_type is null then 'missing in target' when logical_type is null then 'missing in batch'
    when logical_type <> target_type then 'type differs' else 'ok' end verdict
from types full join theirs on lower(field) = name"""

# Merging


def _cases(operations: dict[str, str]) -> str:
    return "case o_orderpriority " + " ".join(f"when '{p}' then '{op}'" for p, op in operations.items()) + " end"


def _merge(known: list[str], unknown: list[str]) -> str:
    """CTEs with the target, the changes, and the two joined by key."""
    parts = []
    for operations, key in (({p: KNOWN[p] for p in known}, "o_orderkey"), ({p: UNKNOWN[p] for p in unknown}, "-1 - o_orderkey")):
        if operations:
            names = ", ".join(f"'{p}'" for p in operations)
            parts.append(f"""
  select {_cases(operations)} operation, {CHANGES_READ_AT} + o_orderkey read_at, {key} o_orderkey, o_custkey, o_orderpriority,
    o_totalprice + 1 o_totalprice from orders where o_orderpriority in ({names})""")
    return f"""{_TARGET},
raw as ({' union all '.join(parts)}),
changes as (
  select operation, case when operation in ('create', 'snapshot') then read_at end created_at,
    case when operation = 'update' then read_at end updated_at, case when operation = 'delete' then read_at end deleted_at,
    case when operation <> 'delete' then o_custkey end o_custkey, o_orderkey,
    case when operation <> 'delete' then o_orderpriority end o_orderpriority,
    case when operation <> 'delete' then o_totalprice end o_totalprice
  from raw)"""


def _merged(key: str, columns: list[str], old: str, new: str, ignored: str = "false") -> str:
    """The merged rows of two CTEs with the bookkeeping columns, written as one CASE per column."""

    def kept(condition: str, name: str) -> str:
        return f"case when {condition} then o.{name} else n.{name} end {name}"

    gone = f"n.{key} is null or ({ignored})"
    both = f"o.{key} is not null"
    after_delete = f"{gone} or ({both} and n.operation = 'delete')"
    return f"""
select coalesce(o.{key}, n.{key}) {key}, {kept(gone, 'operation')}, {kept(gone, 'deleted_at')},
  {kept(f"{gone} or ({both} and n.operation in ('update', 'delete'))", 'created_at')},
  {', '.join(kept(after_delete, name) for name in ['updated_at', *columns])}
from {old} o full join {new} n on o.{key} = n.{key}"""


_ORDER_PAYLOAD = ["o_custkey", "o_orderpriority", "o_totalprice"]
for _name, _known, _unknown in (
    ("merge_inserts", ["1-URGENT"], ["2-HIGH"]),
    ("merge_updates", ["2-HIGH"], ["3-MEDIUM"]),
    ("merge_soft_delete", ["5-LOW"], []),
    ("merge_tombstones", [], ["4-NOT SPECIFIED"]),
):
    ORACLES[_name] = f"with {_merge(_known, _unknown)} {_merged('o_orderkey', _ORDER_PAYLOAD, 'target', 'changes')}"

ORACLES["merge_stats"] = f"""
with {_merge(list(KNOWN), list(UNKNOWN))}
select n.operation, o.o_orderkey is not null matched, count(*) rows_affected
from changes n left join target o on o.o_orderkey = n.o_orderkey group by all"""

# Whole destinations

ORACLES["apply_change_log"] = ORACLES["render_rows"]


def _cut(parts: int) -> str:
    """The number of the range of the sequence that a record lies in."""
    end = "(select max(event_id) + 1 from events)"
    return " + ".join(f"(seq >= {end} * {n} // {parts})::int" for n in range(1, parts))


def _applied(parts: int, part: str | None = None) -> str:
    """The batch cut into parts, ranges of its sequence unless told otherwise, applied one after the other."""
    part = part or _cut(parts)
    steps, last = [], "part0"
    for n in range(parts):
        steps.append(f"part{n} as (select * exclude (part) from rendered where part = {n})")
    for n in range(1, parts):
        steps.append(f"after{n} as ({_merged('id', ['value', 'props'], last, f'part{n}')})")
        last = f"after{n}"
    return f"with {_winners(f'({part})')}, {', '.join(steps)} select * from {last}"


ORACLES["apply_two_batches"] = _applied(2)
ORACLES["stream_apply"] = _applied(3)
ORACLES["apply_late_ignore"] = f"""
with {_winners(f'({_cut(2)})')}, part0 as (select * exclude (part) from rendered where part = 0),
part1 as (select * exclude (part) from rendered where part = 1)
{_merged('id', ['value', 'props'], 'part0', 'part1', "n.operation = 'update' and o.id is not null and n.updated_at <= o.updated_at")}"""

# Batches of a fixed number of records, one after the other: what is left of each key's winners at the end.
ORACLES["stream_apply_by_count"] = f"""
with {_winners(f'((seq - (select min(event_id) from events)) // {PAGE})')},
last as (
  select id, arg_max(operation, part) operation, arg_max(struct_pack(v := deleted_at), part).v deleted_at,
    arg_max(created_at, part) filter (operation in ('create', 'snapshot')) created_at,
    arg_max(struct_pack(u := updated_at, v := value, p := props), part) filter (operation <> 'delete') payload
  from rendered group by id)
select id, operation, created_at, payload.u updated_at, deleted_at, payload.v value, payload.p props from last"""

ORACLES["apply_json_records"] = _applied(2, "(operation = 'delete')::int")
ORACLES["apply_affected"] = f"""
with {_winners(f'({_cut(2)})')}
select part batch, operation, part = 1 and id in (select id from rendered where part = 0) matched, count(*) rows_affected
from rendered group by all"""

_REST = [c for c in _COLUMNS if c != "o_orderkey"]


def _later(changes: str, at: int) -> str:
    """The rendered rows of net changes consumed at a time."""
    return f"""
  select {_OPERATION} operation, case when "action" = 'INSERT' and not is_update then {at} end created_at,
    case when is_update then {at} end updated_at, case when "action" = 'DELETE' then {at} end deleted_at, o_orderkey,
    {', '.join(f"""case when "action" = 'INSERT' then {c} end {c}""" for c in _REST)}
  from {changes} where not ("action" = 'DELETE' and is_update)"""


ORACLES["stream_handover"] = f"""
{_FORWARD}, {_changes('v2', 'v1', 'backward')},
first as (select 'snapshot' operation, {T0} created_at, null::bigint updated_at, null::bigint deleted_at, * from v2),
again as ({_later('backward', T2)}),
merged as ({_merged('o_orderkey', _REST, 'first', 'again')})
select * replace (epoch_us(o_orderdate) as o_orderdate) from merged"""

_REPLICATED = f"""
first as (select 'snapshot' operation, {T0} created_at, null::bigint updated_at, null::bigint deleted_at, * from v1),
later as ({_later('forward', T1)}),
merged as ({_merged('o_orderkey', _REST, 'first', 'later')})"""

ORACLES["replicate_table"] = f"""
{_FORWARD}, {_REPLICATED}
select * replace (epoch_us(o_orderdate) as o_orderdate) from merged"""

ORACLES["replicate_twice"] = f"""
{_FORWARD}, {_changes('v2', 'v1', 'backward')}, {_REPLICATED},
again as ({_later('backward', T2)}),
twice as ({_merged('o_orderkey', _REST, 'merged', 'again')})
select * replace (epoch_us(o_orderdate) as o_orderdate) from twice"""

ORACLES["replicate_null_ordering"] = f"""
select case o_orderstatus when 'P' then 'update' else 'snapshot' end operation, {T0} created_at,
  case o_orderstatus when 'P' then {T1} end updated_at, null::bigint deleted_at, o_orderkey,
  case when o_orderpriority <> '1-URGENT' then o_custkey end o_custkey, o_orderstatus,
  case o_orderstatus when 'P' then o_totalprice + 1 else o_totalprice end o_totalprice,
  epoch_us(o_orderdate) o_orderdate, o_orderpriority
from orders"""
