"""The same results in DuckDB SQL over the test tables."""

_LOG = """
with log as (
  select event_id + 1 as id, cast(floor(epoch(ts)) as bigint) as created,
         case when event_type in ('signup', 'purchase') then 1 when event_type in ('view', 'click') then 2 else 3 end as operation,
         user_id * 20 as c_custkey, value as c_acctbal, event_type as c_mktsegment,
         cast(regexp_extract(props, '[0-9]+') as integer) as n,
         case when (event_id + 1) * 2 > (select max(event_id) + 1 from events)
              then cast(regexp_extract(props, '[0-9]+') as integer) end as k,
         case event_id % 3 when 0 then 'customer' when 1 then 'supplier' else 'orders' end as route,
         'cdc-db1.example-3306-crm-' as stem
  from events)
"""

_LATEST = _LOG + """,
latest as (select * from (select *, row_number() over (partition by c_custkey order by id desc) as rn from log) where rn = 1),
upserts as (select c_custkey, c_acctbal, c_mktsegment, k from latest where operation <> 3)
"""

_APPLIED = _LATEST + """,
applied as (
  select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, cast(null as integer) as k from customer
  where c_custkey not in (select c_custkey from latest)
  union all
  select c_custkey, null, null, c_acctbal, c_mktsegment, k from upserts)
select * from applied
"""

_COMPACT = _LOG + """,
a as (select * from (select *, max(id) filter (where operation = 3) over (partition by c_custkey) as ld from log)
      where ld is null or id >= ld),
b as (select * from (select *, max(id) filter (where operation = 2) over (partition by c_custkey) as lu from a)
      where operation <> 1 or lu is null or id > lu),
compacted as (select * from (select *, max(id) over (partition by c_custkey, operation) as m from b) where id = m)
"""

_PARTY = """
party as (
  select coalesce(s_suppkey, c_custkey) as party_key, coalesce(s_name, c_name) as name,
         coalesce(s_nationkey, c_nationkey) as nation, c_acctbal as c_acctbal_customer_crm,
         c_mktsegment as c_mktsegment_customer_crm, s_acctbal as s_acctbal_supplier_erp
  from customer full join supplier on c_custkey = s_suppkey)
"""

_PROPAGATED = _LATEST + "," + _PARTY + """
select party_key, name, nation, c_acctbal_customer_crm, c_mktsegment_customer_crm, s_acctbal_supplier_erp,
       cast(null as integer) as k_customer_crm
from party where party_key not in (select c_custkey from latest)
union all
select c_custkey, null, null, c_acctbal, c_mktsegment, null, k from upserts
"""

_MOVED = """
with party as (
  select coalesce(s_suppkey, c_custkey) as party_key, c_custkey as c_custkey_customer_crm, c_acctbal as c_acctbal_customer_crm,
         s_name as name, s_acctbal as s_acctbal_supplier_erp
  from customer full join supplier on c_custkey = s_suppkey),
changed as (select c_custkey from customer where c_custkey % 3 = 0 or c_custkey % 5 = 0),
written as (select c_custkey + 1000000, c_custkey, c_acctbal + 1, null, null from customer where c_custkey % 3 = 0)
"""

_CATALOG = """
with cat as (
  select 'crm' as db_type, 't_' || o_custkey as table_name, 'Col_' || o_orderkey as column_name,
         cast(o_orderkey as integer) as n, o_orderstatus as status,
         case left(o_orderpriority, 1)
           when '1' then 'varchar(' || (o_orderkey % 90 + 10) || ')'
           when '2' then 'int(11) unsigned'
           when '3' then 'decimal(12,2)'
           when '4' then 'enum(''b'',''a'',''c' || (o_orderkey % 3) || ''')'
           else 'datetime' end as data_type,
         case when o_orderkey % 4 = 0 then o_orderstatus end as dflt
  from orders),
old_cols as (select db_type, table_name, column_name, n, data_type, dflt from cat where status <> 'P'),
new_cols as (
  select db_type, table_name,
         case when n % 5 = 0 then upper(column_name) else column_name end as column_name, n,
         case when n % 5 = 1 and data_type like 'varchar%' then 'varchar(255)'
              when n % 5 = 2 and data_type = 'datetime' then 'timestamp'
              when n % 5 = 3 and data_type = 'datetime' then 'datetime(6)'
              when n % 5 = 3 and data_type like 'decimal%' then 'decimal(12,4)'
              when n % 5 = 1 and data_type like 'enum%' then 'enum(''a'',''b'',''new one'')'
              when n % 5 = 2 and data_type like 'enum%' then 'enum(''c' || (n % 3) || ''',''a'',''b'')'
              when n % 5 = 4 and data_type like 'int%' then 'int(11) signed'
              else data_type end as data_type,
         case when n % 7 = 0 then '0' else dflt end as dflt
  from cat where status <> 'F'),
parsed_old as (
  select db_type, table_name, column_name as field, n,
         case when contains(data_type, '(') then split_part(data_type, '(', 1) else data_type end as type,
         cast(nullif(regexp_extract(data_type, '^decimal.[0-9]+,([0-9]+).', 1), '') as integer) as "typeScale",
         case when data_type not like 'enum%' and contains(data_type, '(') and regexp_extract(data_type, '[0-9]+') <> ''
              then cast(regexp_extract(data_type, '[0-9]+') as integer) else -1 end as "typeSize",
         case when data_type like '% signed' then true when data_type like '% unsigned' then false end as "isSigned",
         coalesce(dflt, 'NULL') as "defaultValue",
         case when data_type like 'enum%' then list_sort(string_split(replace(data_type[6:-2], '''', ''), ',')) else [] end as vals
  from old_cols),
parsed_new as (
  select db_type, table_name, column_name as field, n,
         case when contains(data_type, '(') then split_part(data_type, '(', 1) else data_type end as type,
         cast(nullif(regexp_extract(data_type, '^decimal.[0-9]+,([0-9]+).', 1), '') as integer) as "typeScale",
         case when data_type not like 'enum%' and contains(data_type, '(') and regexp_extract(data_type, '[0-9]+') <> ''
              then cast(regexp_extract(data_type, '[0-9]+') as integer) else -1 end as "typeSize",
         case when data_type like '% signed' then true when data_type like '% unsigned' then false end as "isSigned",
         coalesce(dflt, 'NULL') as "defaultValue",
         case when data_type like 'enum%' then list_sort(string_split(replace(data_type[6:-2], '''', ''), ',')) else [] end as vals
  from new_cols)
"""

_DRIFT = _CATALOG + """,
pairs as (
  select coalesce(o.db_type, c.db_type) as "dbType", coalesce(o.table_name, c.table_name) as "dbTable",
         coalesce(c.field, o.field) as "fieldChanged", o.field as of, c.field as cf, o.type as ot, c.type as ct,
         o."typeSize" as os, c."typeSize" as cs, o."typeScale" as osc, c."typeScale" as csc, o."defaultValue" as od, c."defaultValue" as cd, o.vals as ov, c.vals as cv
  from parsed_old o full join parsed_new c
    on o.db_type = c.db_type and o.table_name = c.table_name and lower(o.field) = lower(c.field)),
drift as (
  select "dbType", "dbTable", "fieldChanged", 'FIELD_CHANGED' as "changeType", of as "oldValue", cf as "newValue"
  from pairs where of is null or cf is null
  union all
  select "dbType", "dbTable", "fieldChanged", 'TYPE_CHANGED', ot, ct from pairs where ot <> ct
  union all
  select "dbType", "dbTable", "fieldChanged", 'TYPE_SIZE_CHANGED', concat_ws(',', os, osc), concat_ws(',', cs, csc)
  from pairs where of is not null and cf is not null and (os <> cs or osc is distinct from csc)
  union all
  select "dbType", "dbTable", "fieldChanged", 'DEFAULT_VALUE_CHANGED', od, cd from pairs where od <> cd
  union all
  select "dbType", "dbTable", "fieldChanged", 'POSSIBLE_VALUE_CHANGE',
         '[' || array_to_string(ov, ', ') || ']', '[' || array_to_string(cv, ', ') || ']'
  from pairs where of is not null and cf is not null and ov <> cv)
"""

_VERSIONS = _CATALOG + """,
texts as (
  select 1 as id, db_type, table_name,
         string_agg(concat_ws('|', field, type, "typeSize", "typeScale", "isSigned", "defaultValue", array_to_string(vals, ',')), ';' order by lower(field)) as t
  from parsed_old group by all
  union all
  select 2, db_type, table_name,
         string_agg(concat_ws('|', field, type, "typeSize", "typeScale", "isSigned", "defaultValue", array_to_string(vals, ',')), ';' order by lower(field)) as t
  from parsed_new group by all),
versions as (
  select cast(id as bigint) as id, db_type, table_name from texts a
  where id = 1 or not exists (select 1 from texts b where b.id = 1 and b.table_name = a.table_name and b.t = a.t))
"""

_RUNS = """
select l_orderkey as job_id, l_suppkey as request_id, l_linenumber as step,
       case l_returnflag when 'A' then 'success' when 'R' then 'fail' else 'processing' end as status,
       case l_returnflag when 'A' then 3 when 'R' then 2 else 1 end as "statusOrder",
       strftime(l_shipdate, '%Y/%m/%d %H:%M:%S') as create_time, 12 as number_step
from lineitem
"""

ORACLES = {
    "read_changes": _LOG + """
        select id, 'customer' as table_name, operation, created from log
        where id > (select max(id) // 4 from log) and id <= (select max(id) // 2 from log)""",
    "union_changes": _LOG + """
        select id, route as table_name, operation, created from log where id <= (select max(id) * 3 // 5 from log)
        union
        select id, route, operation, created from log where id > (select max(id) * 2 // 5 from log)""",
    "encode_changes": """
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
               1 as operation, o_orderkey + 1 as seq from orders""",
    "decode_envelope": _LOG + "select stem || route as table_key, id, route as table_name, operation, created from log",
    "decode_requests": """
        select distinct 'h' as server_host, cast(l_linenumber as varchar) as port, 'T_' || l_partkey as table_name,
               l_suppkey as latest_offset, 'cdc-h-' || l_linenumber || '-shop-t_' || l_partkey as topic_cdc
        from lineitem where l_returnflag <> 'N'""",
    "decode_changes": _LOG + """
        select c_custkey, c_acctbal, c_mktsegment, k, operation, id as seq, '2024-02-01 00:00:00.000' as modified from log""",
    "decode_quarantine": _LOG + """
        select id, case when n >= 20 then 9 else operation end as operation,
               case when n < 10 then 'no row image' when n < 20 then 'broken row image' else 'unknown operation' end as reason
        from log where n < 30""",
    "changes_schema": """
        select name, source_type, position, (select max(event_id) + 1 from events) as last_id, spark_type, true as known
        from (values ('c_custkey', 'bigint', 0, 'bigint'), ('c_acctbal', 'double', 1, 'double'),
                     ('c_mktsegment', 'varchar(10)', 2, 'string'), ('k', 'int', 3, 'int')) as t(name, source_type, position, spark_type)""",
    "decode_typed_images": """
        select o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') as o_day, '{"c":' || o_custkey || '}' as customer,
               case when o_orderkey % 2 = 0 then true end as even, 2 as operation, o_orderkey + 1 as seq from orders""",
    "route_changes": _LOG + "select stem || route as table_key, id, operation, created from log",
    "compact_per_operation": _COMPACT + "select c_custkey, c_acctbal, c_mktsegment, k, operation, id as seq from compacted",
    "compact_latest": _LATEST + "select c_custkey, c_acctbal, c_mktsegment, k, operation, id as seq from latest",
    "apply_changes": _APPLIED,
    "apply_changes_per_operation": _COMPACT + """
        select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, cast(null as integer) as k from customer
        where c_custkey not in (select c_custkey from compacted)
        union all
        select c_custkey, null, null, c_acctbal, c_mktsegment, k from compacted where operation <> 3""",
    "apply_changes_type_conflict": _APPLIED.replace(
        "select * from applied",
        "select c_custkey, c_name, c_nationkey, cast(c_acctbal as varchar) as c_acctbal, c_mktsegment, k from applied"),
    "replace_table": _APPLIED,
    "apply_changes_partitioned": _APPLIED,
    "align_schemas_string": """
        select c_custkey, cast(c_acctbal as varchar) as c_acctbal, c_name, null as o_orderstatus from customer
        union all
        select o_custkey, cast(o_orderkey as varchar), null, o_orderstatus from orders""",
    "align_schemas_widen": """
        select c_custkey, cast(c_nationkey as bigint) as n, c_acctbal as v from customer
        union all
        select o_custkey, o_orderkey, cast(1 as double) from orders""",
    "map_columns": """
        select c_custkey as party_key, c_name as name, c_nationkey as nation, c_acctbal as c_acctbal_customer_crm,
               c_mktsegment as c_mktsegment_customer_crm from customer""",
    "consolidate": "with " + _PARTY + "select * from party",
    "consolidate_many_to_one": """
        select coalesce(c_custkey, o_custkey) as party, coalesce(c_mktsegment, cast(o_orderkey as varchar)) as amount,
               o_totalprice as o_totalprice_orders_a, c_acctbal as c_acctbal_customer_b
        from orders full join customer on o_custkey = c_custkey""",
    "propagate_replace": _PROPAGATED,
    "propagate_patch": _LATEST + "," + _PARTY + """,
        patched as (
          select p.party_key, p.name, p.nation,
                 case when l.id is null then c_acctbal_customer_crm when l.operation <> 3 then l.c_acctbal end as c_acctbal_customer_crm,
                 case when l.id is null then c_mktsegment_customer_crm when l.operation <> 3 then l.c_mktsegment end as c_mktsegment_customer_crm,
                 s_acctbal_supplier_erp,
                 case when l.operation <> 3 then l.k end as k_customer_crm, l.operation
          from party p left join latest l on p.party_key = l.c_custkey)
        select * exclude (operation) from patched
        where operation is null or operation <> 3
           or coalesce(name, cast(nation as varchar), cast(s_acctbal_supplier_erp as varchar)) is not null
        union all
        select c_custkey, null, null, c_acctbal, c_mktsegment, null, k from upserts
        where c_custkey not in (select party_key from party)""",
    "targets_of": """
        select 'm_' || o_orderkey as merge_table_name from orders
        where (o_custkey % 100 = 5 and o_orderstatus = 'F') or (o_orderkey % 100 = 5 and o_totalprice > 250000)""",
    "new_members": """
        select 'm_' || o_orderkey as merge_table_name, o_orderkey * 3 + 2 as table_id, 't_' || (o_custkey % 7) as table_name,
               'db_X' as database_alias
        from orders where o_orderstatus <> 'P'""",
    "decode_postgresql": """
        select l_orderkey || '_' || l_linenumber as id, printf('%.2f', l_extendedprice) as price, cast(l_quantity as double) as qty,
               '2024-01-02 03:04:05' as at, right('000' || hex(l_orderkey), 2 * ((length(hex(l_orderkey)) + 1) // 2)) as raw,
               cast(l_orderkey * 10 + l_linenumber as bigint) as seq
        from lineitem where length(hex(l_orderkey)) % 2 = 0
        union all
        select l_orderkey || '_' || l_linenumber, printf('%.2f', l_extendedprice), cast(l_quantity as double),
               '2024-01-02 03:04:05', hex(encode('\\x' || lower(hex(l_orderkey)))), cast(l_orderkey * 10 + l_linenumber as bigint)
        from lineitem where length(hex(l_orderkey)) % 2 = 1""",
    "decode_oracle": """
        select l_orderkey || '_' || l_linenumber as id, printf('%.2f', l_extendedprice) as price, cast(l_quantity as double) as qty,
               '2024-01-02 03:04:05' as at, cast(l_orderkey * 10 + l_linenumber as bigint) as seq
        from lineitem""",
    "decode_binary": "select c_custkey, sha256(c_name) as h from customer",
    "stream_late_events": """
        with log as (
          select event_id + 1 as id, case when event_type in ('signup', 'purchase') then 1 when event_type in ('view', 'click') then 2 else 3 end as operation,
                 (select (max(event_id) + 1) // 2 from events) as middle
          from events)
        select id, operation, 'behind applied position' as reason from log
        where id % 7 = 0 and id <= (select max(id) from log where id <= middle and id % 7 <> 0)""",
    "consolidate_refresh": """
        with s as (select *, s_suppkey % 3 <> 0 as stays from supplier)
        select coalesce(c_custkey, s_suppkey) as party_key, coalesce(s_name, c_name) as name, coalesce(s_nationkey, c_nationkey) as nation,
               c_acctbal as c_acctbal_customer_crm, c_mktsegment as c_mktsegment_customer_crm,
               case when stays then s_acctbal + 1 end as s_acctbal_supplier_erp
        from customer full join s on c_custkey = s_suppkey""",
    "describe_tables": _CATALOG + """
        select table_name, count(*) as column_count,
               string_agg(lower(column_name) || ':' || data_type, ',' order by n) as columns
        from cat group by table_name""",
    "parse_source_types": _CATALOG + """
        select table_name, field, type, "typeSize", "typeScale", "isSigned", "defaultValue", array_to_string(vals, ',') as "possibleValues"
        from parsed_new""",
    "map_source_types": _CATALOG + """
        select table_name, column_name,
               case when data_type like 'varchar%' or data_type like 'enum%' then 'string'
                    when data_type like '% unsigned' then 'bigint' when data_type like 'int%' then 'int'
                    when data_type like 'decimal%' then data_type else 'timestamp' end as spark_type
        from new_cols""",
    "record_schemas": _VERSIONS + "select id, db_type, table_name from versions",
    "latest_schemas": _VERSIONS + """,
        newest as (select db_type, table_name, max(id) as id from versions group by all)
        select db_type, table_name, field, type, "typeSize", "typeScale", "isSigned", "defaultValue", array_to_string(vals, ',') as "possibleValues"
        from newest join parsed_old using (db_type, table_name) where id = 1
        union all
        select db_type, table_name, field, type, "typeSize", "typeScale", "isSigned", "defaultValue", array_to_string(vals, ',')
        from newest join parsed_new using (db_type, table_name) where id = 2""",
    "diff_tables": """
        with o as (select distinct 'Tab_' || o_custkey as name from orders where o_orderstatus = 'F'),
             n as (select distinct 'TAB_' || o_custkey as name from orders where o_orderstatus <> 'F')
        select coalesce(n.name, o.name) as table_name,
               case when o.name is null then 'added' when n.name is null then 'removed' else 'common' end as status
        from o full join n on lower(o.name) = lower(n.name)""",
    "diff_schemas": _DRIFT + "select * from drift",
    "schema_alerts": _DRIFT + """
        select 'TABLE ' || "dbType" || '@db1.example - FIELD: ' || "fieldChanged" || ' IS ' ||
               case when "changeType" = 'FIELD_CHANGED' and "oldValue" is null then 'ADDED'
                    when "changeType" = 'FIELD_CHANGED' and "newValue" is null then 'DELETED' else 'CHANGED' end as msg,
               '2024-02-01T00:00:00' as created, "dbType" || '.' || "dbTable" || '.' || "fieldChanged" || '@db1.example' as entity_name,
               'COLUMN' as entity_type, 'WARNING' as alert_level, 'REALTIME' as alert_cycle, "changeType"
        from drift""",
    "resolve_aliases": """
        select p_partkey as table_id, 't_' || p_partkey as table_name, 'id' as default_key,
               case when s_suppkey % 2 = 0 then 'mysql' else 'postgresql' end as database_type,
               case when s_suppkey % 2 = 0 then '3306' else '5432' end as port,
               lower(s_name) as database_name, 'db' || s_suppkey as alias, lower(n_name) as server_host
        from part join supplier on p_size = s_suppkey join nation on s_nationkey = n_nationkey
        where s_acctbal >= 0""",
    "run_query": "with " + _PARTY + """
        select c_mktsegment, o_orderstatus, count(*) as orders, count(s_acctbal_supplier_erp) as suppliers, max(o_totalprice) as largest
        from customer join orders on c_custkey = o_custkey join party on party_key = c_custkey
        group by c_mktsegment, o_orderstatus""",
    "run_queries": """
        select 1 as "jobId", 10 as "requestId", 'success' as status, count(*) as total_rows from customer where c_acctbal > 0
        union all select 2, 20, 'success', count(distinct o_orderstatus) from orders
        union all select 3, 30, 'fail', null""",
    "export_csv": "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders",
    "percent_returned": """
        with s as (select l_suppkey, sum(case when l_linestatus = 'F' then l_quantity else 0 end) as closed,
                          sum(case when l_linestatus = 'F' and l_returnflag = 'R' then l_quantity else 0 end) as returned
                   from lineitem group by l_suppkey)
        select l_suppkey, case when closed = 0 then 0.0::double else returned / closed * 100 end as percent from s""",
    "percent_by_sql": """
        select l_orderkey, case when sum(l_quantity) = 0 then 0.0::double
               else sum(case when l_returnflag = 'R' then l_quantity else 0 end) / sum(l_quantity) * 100 end as percent
        from lineitem group by l_orderkey""",
    "change_watermarks": _LOG + "select stem || route as table_key, max(id) as max_id, count(*) as events from log group by all",
    "cdc_lag": _LOG + """,
        l as (select stem || route as table_key, max(id) as latest_id,
                     coalesce(max(id) filter (where route = 'customer' or (route = 'supplier' and id <= (select max(id) // 2 from log))), 0) as applied_id
              from log group by all)
        select table_key, latest_id, applied_id, latest_id - applied_id as lag, applied_id < latest_id as is_ready from l""",
    "latest_per_key": """
        select * exclude (rk) from (select *, rank() over (partition by l_suppkey order by l_shipdate desc, l_quantity desc) as rk from lineitem)
        where rk = 1""",
    "run_progress": "with runs as (" + _RUNS + """),
        steps as (select job_id, step, arg_max(status, create_time || "statusOrder") as status,
                         max(create_time || "statusOrder") as last_at, max(number_step) as number_step from runs group by all)
        select job_id, max(number_step) as number_step, count(*) filter (where status = 'success') as finished,
               count(*) filter (where status = 'fail') as failed, count(*) filter (where status = 'processing') as open,
               arg_max(status, last_at) as last_status
        from steps group by job_id""",
    "append_run_log": _RUNS,
    "snapshot_table": "select *, '2024-02-01 00:00:00.000' as modified from orders",
    "stream_changes": _APPLIED,
    "stream_to_merge_table": _PROPAGATED,
    "consolidate_table": "with " + _PARTY + "select * from party",
    "server_watermarks": """
        select 'db1.example' as database_url, '3306' as database_port, max(event_id) + 1 as max_id, count(*) as events from events""",
    "stream_merge_requests": "with " + _PARTY + "select * from party",
    "stream_queries": """
        select 1 as "jobId", 10 as "requestId", 1 as "etlID", 'success' as status, count(*) as total_rows from customer where c_acctbal > 0
        union all select 2, 10, 2, 'success', count(distinct o_custkey) from orders""",
    "stream_run_log": _RUNS,
    "write_table": "select * from orders",
    "apply_changes_versioned": _APPLIED,
    "read_versions": _APPLIED.replace("select * from applied", """,
        early as (select * from (select *, row_number() over (partition by c_custkey order by id desc) as rn from log
                                 where id <= (select max(id) from log) // 3) where rn = 1),
        versions as (
          select 1 as version, c_mktsegment, c_custkey from customer
          union all select 2, c_mktsegment, c_custkey from customer where c_custkey not in (select c_custkey from early)
          union all select 2, c_mktsegment, c_custkey from early where operation <> 3
          union all select 3, c_mktsegment, c_custkey from applied)
        select version, c_mktsegment, count(*) as n_rows, max(c_custkey) as greatest from versions group by all"""),
    "propagate_moved_key": _MOVED + """
        select * from party where party_key not in (select c_custkey from changed)
        union all select * from written""",
    "propagate_moved_key_patch": _MOVED + """
        select party_key, case when c.c_custkey is null then c_custkey_customer_crm end as c_custkey_customer_crm,
               case when c.c_custkey is null then c_acctbal_customer_crm end as c_acctbal_customer_crm, name, s_acctbal_supplier_erp
        from party left join changed c on party_key = c.c_custkey
        where c.c_custkey is null or name is not null or s_acctbal_supplier_erp is not null
        union all select * from written""",
    "stream_restarted": _LOG + """
        select id, operation, 'behind applied position' as reason from log
        where id % 7 = 0 and id <= (select max(id) from log where id <= (select max(id) from log) * 2 // 3 and id % 7 <> 0)""",
    "stream_failing_table": _LOG + """
        select stem || route as table_key, case route when 'supplier' then 'table set aside' else 'unregistered table' end as reason,
               count(*) as n from log where route <> 'customer' group by all
        union all select stem || route, 'applied', max(id) from log where route = 'customer' group by all""",
    "decode_rejects": _LOG + """
        select id, operation, case when n >= 10 then c_custkey end as c_custkey,
               case when n < 5 then c_acctbal end as c_acctbal,
               'values that do not fit: ' || case when n < 5 then 'c_custkey' when n < 10 then 'c_custkey, c_acctbal'
                                             else 'c_acctbal' end as reason
        from log where n < 20""",
    "stream_apply_requests": _LOG + """,
        requested as (select * from log where route = 'customer' or (route = 'supplier' and id > (select max(id) from log) // 4)),
        newest as (select * from (select *, row_number() over (partition by route, c_custkey order by id desc) as rn from requested) where rn = 1)
        select r.route as copy, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, cast(null as integer) as k
        from customer cross join (values ('customer'), ('supplier')) r(route)
        where not exists (select 1 from newest n where n.route = r.route and n.c_custkey = customer.c_custkey)
        union all select route, c_custkey, null, null, c_acctbal, c_mktsegment, k from newest where operation <> 3
        union all select 'unregistered table', count(*), null, null, null, null, null from log where route = 'orders'
        union all select 'orders no identity_key', null, null, null, null, null, null""",
    "consolidate_members": """
        with s as (select * from supplier where s_suppkey % 3 <> 0)
        select coalesce(c_custkey, s_suppkey) as party_key, coalesce(s_name, c_name) as name, coalesce(s_nationkey, c_nationkey) as nation,
               c_acctbal as c_acctbal_customer_crm, c_mktsegment as c_mktsegment_customer_crm, s_acctbal + 1 as s_acctbal_supplier_erp,
               concat_ws(',', case when s_suppkey is not null then 'supplier_erp' end,
                         case when c_custkey is not null then 'customer_crm' end) as fed_by
        from customer full join s on c_custkey = s_suppkey""",
    "propagate_members": _LATEST + """,
        c as (select * from customer),
        whole as (
          select coalesce(c.c_custkey, s_suppkey, l.c_custkey) as party_key, c.c_custkey is not null as was, s_suppkey is not null as supplied,
                 l.operation, c.c_name, c.c_nationkey, s_name, s_nationkey, s_acctbal, l.k,
                 case when l.operation is null then c.c_acctbal when l.operation <> 3 then l.c_acctbal end as balance,
                 case when l.operation is null then c.c_mktsegment when l.operation <> 3 then l.c_mktsegment end as segment
          from c full join supplier on c.c_custkey = s_suppkey
          full join latest l on l.c_custkey = coalesce(c.c_custkey, s_suppkey))
        select party_key,
               case when operation is null then coalesce(s_name, c_name) when operation <> 3 then coalesce(c_name, s_name) else s_name end as name,
               case when operation is null then coalesce(s_nationkey, c_nationkey) when operation <> 3 then coalesce(c_nationkey, s_nationkey)
                    else s_nationkey end as nation,
               balance as c_acctbal_customer_crm, segment as c_mktsegment_customer_crm, s_acctbal as s_acctbal_supplier_erp,
               case when operation <> 3 then k end as k_customer_crm,
               case when operation is null then concat_ws(',', case when supplied then 'supplier_erp' end, case when was then 'customer_crm' end)
                    when operation <> 3 then concat_ws(',', 'customer_crm', case when supplied then 'supplier_erp' end)
                    else 'supplier_erp' end as fed_by
        from whole where operation is null or operation <> 3 or supplied""",
    "stream_to_versions": _PROPAGATED,
}
