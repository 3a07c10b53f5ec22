"""The queries as SQL, written from the definitions of the operators."""

from __future__ import annotations

DIRTY = """
    select o_orderkey, o_custkey, o_orderstatus,
      case o_orderkey % 10 when 0 then null when 1 then '' when 2 then ' null '
        when 3 then ' 1-urgent' else o_orderpriority end as PRIO, o_totalprice, o_orderdate
    from orders"""
LANDING = f"""
    dirty as ({DIRTY}),
    landing as (select row_number() over (order by o_orderkey) as ROW_ID, * from dirty)"""


def _blank(c: str) -> str:
    return f"({c} is null or upper(trim({c}, ' ')) in ('', 'NULL'))"


FILLED = "not " + _blank("PRIO")

# (id, column, type, parameter, description, criticality, violation)
NULL_RULE = (1, "PRIO", "NULL", None, "PRIO must not be NULL", "CRITICAL", _blank("PRIO"))
LE_RULE = (2, "PRIO", "LENGTH", "<= 8", "PRIO must have a length <= 8", "NON-CRITICAL",
           f"{FILLED} and length(PRIO) > 8")
STATUS_RULE = (3, "o_orderstatus", "DOMAIN", "F,O", "o_orderstatus must be one of: F,O",
               "critical", "o_orderstatus not in ('F', 'O')")
CUSTOM_RULE = (
    4, "o_custkey", "CUSTOM",
    "select ROW_ID from landingTable where o_custkey in "
    "(select o_custkey from landingTable group by o_custkey having count(*) > 14)",
    "o_custkey must satisfy custom check", "CRITICAL",
    "o_custkey in (select o_custkey from orders group by o_custkey having count(*) > 14)")
GE_RULE = (5, "PRIO", "LENGTH", " >=9", "PRIO must have a length  >=9", "NON-CRITICAL",
           f"{FILLED} and length(PRIO) < 9")
EQ_RULE = (6, "PRIO", "LENGTH", "=8", "PRIO must have a length =8", "NON-CRITICAL",
           f"{FILLED} and length(PRIO) <> 8")
LT_RULE = (7, "PRIO", "LENGTH", "<9", "PRIO must have a length <9", "NON-CRITICAL",
           f"{FILLED} and length(PRIO) >= 9")
GT_RULE = (8, "PRIO", "LENGTH", "> 6", "PRIO must have a length > 6", "NON-CRITICAL",
           f"{FILLED} and length(PRIO) <= 6")
CLEAN_RULE = (9, "o_orderkey", "LENGTH", "> 0", "o_orderkey must have a length > 0", "low", "false")
DOMAIN_RULE = (10, "PRIO", "domain", "1-URGENT, 2-HIGH,3-medium",
               "PRIO must be one of: 1-URGENT, 2-HIGH,3-medium", "low",
               f"{FILLED} and upper(trim(PRIO, ' ')) not in ('1-URGENT', '2-HIGH', '3-medium')")
UNREADABLE_RULE = (11, "PRIO", "LENGTH", "8", "PRIO must have a length 8", "low", FILLED)
NUMBER_RULES = [
    (12, "o_custkey", "LENGTH", ">2", "o_custkey must have a length >2", "low",
     "length(cast(o_custkey as varchar)) <= 2"),
    (13, "o_orderkey", "DOMAIN", "1,2,3", "o_orderkey must be one of: 1,2,3", "low",
     "o_orderkey not in (1, 2, 3)")]
PLAIN = [NULL_RULE, LE_RULE, DOMAIN_RULE, STATUS_RULE]
ALL = [*PLAIN, CUSTOM_RULE, CLEAN_RULE]
LENGTHS = [LE_RULE, GE_RULE, EQ_RULE, LT_RULE, GT_RULE]


def _text(value: str | None) -> str:
    return "cast(null as varchar)" if value is None else "'" + value.replace("'", "''") + "'"


def _constants(rule: tuple) -> str:
    qc, column, kind, param, desc, criticality, _ = rule
    return f"""cast({qc} as integer) as QC_ID, {_text(column)} as COLUMN_NAME,
      {_text(kind)} as QC_TYPE, {_text(param)} as QC_PARAM, {_text(desc)} as QC_DESC,
      {_text(criticality)} as CRITICALITY"""


RUN = "'20240101' as CYCLE_ID, cast(1 as integer) as RUN_ID, cast(1 as integer) as DATASET_ID"


def _log(rules: list[tuple], run: str = RUN) -> str:
    return " union all ".join(
        f"select {run}, ROW_ID, {_constants(r)} from landing where {r[-1]}" for r in rules)


def _check(*rules: tuple) -> str:
    return f"with {LANDING} {_log(list(rules))}"


ROLLUP = """
    select ROW_ID,
      '[' || array_to_string(cast(list_sort(list_distinct(list(QC_ID))) as varchar[]), ', ') || ']' as QC_ID,
      '[' || array_to_string(list_sort(list_distinct(list(QC_DESC))), ', ') || ']' as QC_DESC,
      max(case when CRITICALITY like '%CRITICAL%' then 'Y' else 'N' end) as CRITICALITY_FLAG
    from log group by ROW_ID"""


def _staging(rules: list[tuple]) -> str:
    return f"""with {LANDING}, log as ({_log(rules)}), flags as ({ROLLUP})
    select f.QC_ID, f.QC_DESC, coalesce(f.CRITICALITY_FLAG, 'N') as CRITICALITY_FLAG, l.*
    from landing l left join flags f on l.ROW_ID = f.ROW_ID"""


def _summary(rules: list[tuple]) -> str:
    return " union all ".join(
        f"""select {RUN}, {_constants(r)}, count(*) as ERROR_COUNT,
        case when count(*) > 0 then 'FAIL' else 'PASS' end as QC_RESULT
        from landing where {r[-1]}""" for r in rules)


PEOPLE = """
    one as (
      select cast(c_custkey as varchar) as ID, c_name as FIRST_NAME,
        case c_custkey % 3 when 0 then null when 1 then '' else 'M' end as MIDDLE_NAME,
        c_mktsegment as LAST_NAME,
        case when c_custkey % 7 <> 0 then cast(c_custkey as varchar) end as NPI
      from customer),
    hcp as (select * from one union all select * from one where NPI is null),
    affil as (
      select cast(o_orderkey as varchar) as ID, cast(o_custkey as varchar) as HCP_ID,
        case when o_custkey % 5 <> 0 then cast(o_custkey as varchar) end as HCP_NPI,
        o_orderpriority as HCO_ID
      from orders),
    addr as (
      select cast(s_suppkey as varchar) as VID, cast(s_nationkey * 2 + 1 as varchar) as NPI,
        s_name as ADDR_LINE_1, case when s_suppkey % 2 = 0 then 'Suite' end as ADDR_LINE_2,
        'City ' || cast(s_nationkey as varchar) as CITY,
        case when s_suppkey % 3 <> 0 then 'ST' end as STATE,
        case when s_suppkey % 4 = 0 then '' else '00501' end as ZIP
      from supplier)"""
FACT = """
    fact as (
      select distinct h.ID, h.FIRST_NAME, h.MIDDLE_NAME, h.LAST_NAME, h.NPI, a.HCO_ID,
        d.ADDR_LINE_1, d.ADDR_LINE_2, d.CITY, d.STATE, d.ZIP,
        cast(null as varchar) as PLACEHOLDER
      from (select distinct * from hcp) h
      left join (select distinct * from affil) a on h.NPI = a.HCP_NPI
      left join (select distinct * from addr) d on h.NPI = d.NPI)"""
NAME = "concat_ws(' ', FIRST_NAME, MIDDLE_NAME, LAST_NAME) as HCP_NAME"
REPORT_ADDRESS = f"""select distinct ID as HCP_ID, {NAME}, NPI as HCP_NPI,
    concat_ws(',', ADDR_LINE_1, CITY, STATE, ZIP) as HCP_ADDR from fact"""

EVENTS = """select event_type as KIND, cast(event_id as varchar) as ID,
    cast(user_id as varchar) as USER, props as PROPS, cast(ts as varchar) as TS,
    cast(value as varchar) as VALUE from events"""
EVENT_LINE = "concat_ws('|', event_id, user_id, event_type, props, ts, value)"
IDS = """select n, cast(1 as bigint) as first, n as last, n * (n + 1) // 2 as total, n as ids
    from (select count(*) as n from lineitem)"""
CONTROL = """
    datasets as (
      select c_custkey as DATASET_ID, c_name as DATASET_NAME,
        case when c_nationkey < 12 then 'raw' else 'processed' end as DATASET_TYPE,
        c_custkey % 211 as JOB_ID,
        case when c_mktsegment = 'BUILDING' then 'N' else 'Y' end as ACTIVE_FLAG
      from customer),
    deps as (
      select o_orderkey % 97 as JOB_ID, o_custkey as SOURCE_DATASET_ID,
        case when o_orderstatus = 'F' then 'N' else 'Y' end as ACTIVE_FLAG
      from orders)"""


def _latest(stamp: str, where: str) -> str:
    return f"""
    with files as (
      select event_type, strftime(ts, '{stamp}') as stamp, ts as mtime,
        'in/' || event_type || '_' || strftime(ts, '{stamp}') || '.csv' as path
      from events where {where})
    select event_type, path, stamp, mtime from files
    qualify row_number() over (
      partition by event_type order by stamp desc, mtime desc, path desc) = 1"""


def _counted(name: str) -> str:
    return f"(select count(*) from {name})"


AUDIT = """cast({run} as integer) as RUN_ID, cast({job} as integer) as GLUE_JOB_ID,
    {name} as GLUE_JOB_NAME, cast({id} as integer) as DATASET_ID, '{type}' as DATASET_TYPE,
    '{dataset}' as DATASET_NAME, '{process}' as PROCESS_NAME, 'SUCCESS' as PROCESS_STATUS,
    {count} as RECORD_COUNT, '' as PROCESS_MESSAGE"""


def _audit(**values) -> str:
    return ("select '20240101' as CYCLE_ID, '2024-01-01 12:00:00' as LOAD_DATE, "
            + AUDIT.format(**values))


IN_LANDING = """
    rows as (select o_orderkey, cast(o_orderkey as varchar) as ORDER_ID,
        cast(o_custkey as varchar) as CUSTOMER_ID, o_orderstatus as STATUS,
        nullif(PRIO, '') as PRIO, cast(o_totalprice as varchar) as TOTAL,
        cast(o_orderdate as varchar) as DAY from dirty),
    landing as (select row_number() over (order by o_orderkey) as ROW_ID, ORDER_ID, CUSTOMER_ID,
        TOTAL, STATUS, PRIO, DAY from rows)"""
IN_RULES = [
    NULL_RULE, LE_RULE,
    (3, "STATUS", "DOMAIN", "F,O", "STATUS must be one of: F,O", "critical", "STATUS not in ('F', 'O')"),
    (4, "CUSTOMER_ID", "CUSTOM",
     "select ROW_ID from landingTable where CUSTOMER_ID in (select CUSTOMER_ID from landingTable "
     "group by CUSTOMER_ID having count(*) > 14)", "CUSTOMER_ID must satisfy custom check", "CRITICAL",
     "CUSTOMER_ID in (select CUSTOMER_ID from landing group by 1 having count(*) > 14)")]
KIND_RULE = (1, "KIND", "DOMAIN", "click,view", "KIND must be one of: click,view", "low",
             "upper(trim(KIND, ' ')) not in ('click', 'view')")
KIND_RUN = RUN.replace("cast(1 as integer) as DATASET_ID", "cast(2 as integer) as DATASET_ID")
IN_EVENTS = """
    landing as (select row_number() over (order by event_id) as ROW_ID,
        cast(user_id as varchar) as USER, event_type as KIND, props as PROPS,
        cast(ts as varchar) as TS, cast(value as varchar) as VALUE,
        cast(event_id as varchar) as ID from events)"""


def _ingested(landing: str, rules: list[tuple], run: str) -> str:
    return f"""with dirty as ({DIRTY}), {landing}, log as ({_log(rules, run)}), flags as ({ROLLUP})
    select f.QC_ID, f.QC_DESC, coalesce(f.CRITICALITY_FLAG, 'N') as CRITICALITY_FLAG, l.*
    from landing l left join flags f on l.ROW_ID = f.ROW_ID"""


def _ingest_audit() -> str:
    def row(i, name, run, status, count, message):
        return f"""select '20240101' as CYCLE_ID, cast({run} as integer) as RUN_ID,
          '2024-01-01 12:00:00' as LOAD_DATE, cast({11 if i == 3 else 10} as integer) as GLUE_JOB_ID,
          'in' as GLUE_JOB_NAME, cast({i} as integer) as DATASET_ID, 'RAW' as DATASET_TYPE,
          '{name}' as DATASET_NAME, 'INGESTION' as PROCESS_NAME, '{status}' as PROCESS_STATUS,
          cast({count} as bigint) as RECORD_COUNT, '{message}' as PROCESS_MESSAGE"""
    rows = [row(i, n, run, "SUCCESS", f"(select count(*) from {t})", "") for run in (1, 2)
            for i, n, t in ((1, "STG_ORDERS", "orders"), (2, "STG_EVENTS", "events"))]
    rows.append(row(3, "STG_BAD", 1, "FAILED", 0,
                    "source columns not found: [''absent'']; the file has [''o_orderkey'', "
                    "''o_custkey'', ''o_orderstatus'', ''PRIO'', ''o_totalprice'', ''o_orderdate'']"))
    return " union all ".join(rows)


ORACLE: dict[str, str] = {
    "ingest_orders": _ingested(IN_LANDING, IN_RULES, RUN),
    "ingest_events": _ingested(IN_EVENTS, [KIND_RULE], KIND_RUN),
    "ingest_log": f"""with dirty as ({DIRTY}), {IN_LANDING} {_log(IN_RULES)} union all
        select * from (with {IN_EVENTS} {_log([KIND_RULE], KIND_RUN)})""",
    "ingest_summary": f"""with dirty as ({DIRTY}), {IN_LANDING} {_summary(IN_RULES)} union all
        select * from (with {IN_EVENTS} {_summary([KIND_RULE]).replace(RUN, KIND_RUN)})""",
    "ingest_audit": _ingest_audit(),
    "read_raw_json_text": """select cast(event_id as varchar) as EVENT_ID, cast(ts as varchar) as TS,
        cast(user_id as varchar) as USER_ID, event_type as EVENT_TYPE, props as PROPS,
        cast(value as varchar) as VALUE, '00501' as ZIP, '1.10' as N from events""",
    "row_id_orders": "select row_number() over (order by o_orderkey) as ROW_ID, * from orders",
    "row_id_hot_key": """select row_number() over (order by k, o_orderkey) as ROW_ID, k, o_orderkey
        from (select case when o_orderkey % 3 = 0 then 'hot' else o_orderpriority end as k,
          o_orderkey from orders)""",
    "row_id_unordered": IDS,
    "row_id_stored": IDS,
    "map_orders": """select o_orderstatus as STATUS, cast(o_orderkey as varchar) as ORDER_ID,
        cast(o_custkey as varchar) as CUSTOMER_ID from orders""",
    "select_all_lineitem": "select * from lineitem",
    "read_raw_csv": EVENTS,
    "read_raw_unheadered": EVENTS,
    "read_raw_json": EVENTS,
    "read_raw_orc": EVENTS,
    "read_raw_parquet": EVENTS,
    "read_raw_xml": EVENTS.replace(" from events", ", '00501' as ZIP from events"),
    "read_raw_text": f"select {EVENT_LINE} as LINE from events".replace("'|'", "chr(9)"),
    "read_raw_quarantine": """select case when event_id % 7 < 2 then 'quarantine' else 'landed' end as PLACE,
        case event_id % 7 when 0 then line || '|more' when 1 then event_id || '|' || user_id
          else line end as RECORD
        from (select *, concat_ws('|', event_id, user_id, event_type, ts, value) as line from events)""",
    "list_raw_files": f"""select event_type, cast(sum(octet_length(encode({EVENT_LINE})) + 1) as bigint)
        as bytes, true as in_folder, true as dated from events group by 1""",
    "dqm_custom_refused": f"""with {LANDING}, refused as (
          select unnest([0, 1, 2, 3]) as QC_ID, unnest(['reads', 'reads', 'not the landing''s',
            'one column']) as why)
        select (select max(ROW_ID) from landing) as ROW_ID, QC_ID, 'refused: ' || why as OUTCOME
        from refused
        union all select max(ROW_ID), 4, 'found' from landing group by PRIO
        union all select ROW_ID, 5, 'found' from landing where o_totalprice > 100000 or o_custkey % 2 = 0""",
    "dependency_levels": """with recursive factors as (
          select p_partkey as k, p_partkey as left_, 0 as n from part where p_partkey > 0
          union all select k, left_ // by_, n + 1 from factors, (select unnest([2, 3, 5]) as by_)
          where left_ % by_ = 0)
        , jobs as (select p_partkey as k from part where p_partkey > 0
          and (p_partkey % 2 = 0 or p_partkey % 3 = 0 or p_partkey % 5 = 0)
          union select p_partkey // by_ from part, (select unnest([2, 3, 5]) as by_) where p_partkey > 0 and p_partkey % by_ = 0)
        select jobs.k as JOB_ID, cast(max(n) as integer) as LEVEL from jobs join factors using (k)
        group by 1""",
    "claimed_run_ids": """select DATASET_ID, cast(last + i as integer) as RUN_ID from (
          select cast(user_id % 5 as integer) as DATASET_ID,
            max(cast(json_extract(props, '$.k') as integer)) as last from events group by 1),
        (select unnest(range(1, 9)) as i)""",
    "log_compacted": """select case when s_nationkey < 12 then '20240101' else '20240102' end as CYCLE_ID,
        cast(s_suppkey as integer) as RUN_ID, s_name as PROCESS_MESSAGE, true as FEWER from supplier""",
    "publish_swap": " union all ".join(
        f"select '{when}' as WHEN_READ, o_orderkey, o_totalprice from orders where {which}"
        for when, which in (("before", "o_orderkey % 2 = 0"), ("by the reader of before", "o_orderkey % 2 = 0"),
                            ("after", "true"), ("after a failure", "true"))),
    "publish_over_itself": "select * replace (o_totalprice + 1 as o_totalprice) from orders",
    "build_fact_by_sql": f"with {PEOPLE}, {FACT} select * from fact",
    "build_report_affiliation": f"""with {PEOPLE}, {FACT}
        select distinct ID as HCP_ID, {NAME}, NPI as HCP_NPI, HCO_ID as HCP_HCO_ID from fact""",
    "latest_file": _latest("%Y%m%d", "true"),
    "latest_file_to_the_second": _latest("%Y%m%d%H%M%S", "event_type in ('click', 'view')"),
    "dqm_null": _check(NULL_RULE),
    "dqm_length_le": _check(LE_RULE),
    "dqm_length_ge": _check(GE_RULE),
    "dqm_length_eq": _check(EQ_RULE),
    "dqm_length_lt": _check(LT_RULE),
    "dqm_length_gt": _check(GT_RULE),
    "dqm_length_unreadable": _check(UNREADABLE_RULE),
    "dqm_domain": _check(DOMAIN_RULE),
    "dqm_numbers": _check(*NUMBER_RULES),
    "dqm_custom": _check(CUSTOM_RULE),
    "dqm_log": _check(NULL_RULE, DOMAIN_RULE, STATUS_RULE, *LENGTHS),
    "dqm_rollup": f"with {LANDING}, log as ({_log(PLAIN)}) {ROLLUP}",
    "staging_orders": _staging(PLAIN),
    "staging_orders_ranged": _staging(PLAIN),
    "staging_orders_custom": _staging(ALL),
    "staging_from_log": _staging(ALL),
    "dqm_summary": f"with {LANDING} select * from ({_summary(ALL)}) where ERROR_COUNT > 0",
    "dqm_summary_with_pass": f"with {LANDING} {_summary(ALL)}",
    "next_run_id": """select user_id as DATASET_ID, strftime(ts, '%Y%m%d') as CYCLE_ID,
        cast(max(cast(json_extract(props, '$.k') as integer)) + 1 as integer) as MAX_RUN_ID
        from events group by 1, 2""",
    "job_datasets": f"""with {CONTROL} select * from datasets
        where JOB_ID = 7 and ACTIVE_FLAG = 'Y' and DATASET_TYPE = 'raw'""",
    "dataset_rules": """select l_orderkey % 100 as DATASET_ID, l_linenumber as QC_ID,
        l_partkey as QC_PARAM, 'Y' as ACTIVE_FLAG
        from lineitem where l_orderkey % 100 = 42 and l_linestatus = 'O'""",
    "job_dependencies": f"""with {CONTROL} select * from deps
        where JOB_ID = 5 and ACTIVE_FLAG = 'Y'""",
    "dependency_resolve": f"""with {CONTROL}
        select d.*, s.DATASET_ID, s.DATASET_NAME, s.DATASET_TYPE, s.JOB_ID as SOURCE_JOB_ID
        from deps d join datasets s on d.SOURCE_DATASET_ID = s.DATASET_ID
        where d.ACTIVE_FLAG = 'Y'""",
    "job_target": """select o_custkey as JOB_ID, max(o_orderkey) as DATASET_ID
        from orders group by 1 having count(*) = 1""",
    "column_layout": f"""with {CONTROL}
        select p_size as DATASET_ID, p_partkey as COLUMN_SEQUENCE_NUMBER,
          p_name as SOURCE_COLUMN_NAME, p_type as COLUMN_NAME, p_brand as COLUMN_DATA_TYPE,
          DATASET_NAME from part join datasets on p_size = DATASET_ID""",
    "heavy_left_join": """select o_orderkey, k, c_custkey, c_name
        from (select o_orderkey,
          case o_orderkey % 3 when 0 then 1 when 1 then o_custkey end as k from orders)
        left join customer on k = c_custkey""",
    "heavy_right_join": """select c_custkey, c_name, o_orderkey, k
        from customer left join (select o_orderkey,
          case o_orderkey % 3 when 0 then 1 else o_custkey * 2 end as k from orders)
        on k = c_custkey""",
    "heavy_join_mixed_types": """with l as (
          select o_orderkey, cast(case when o_orderkey % 2 = 0 then 7 else o_custkey end as bigint) as k
          from orders),
        r as (select c_custkey as c, case when c_custkey % 10 = 0 then 7 else c_custkey end as v
          from customer)
        select o_orderkey, k, count(*) as n, cast(sum(r.c) as bigint) as dk,
          cast(sum(e.c) as bigint) as ek
        from l left join r on k = r.v left join (select * from r where c % 3 = 0) e on k = e.v
        group by 1, 2""",
    "heavy_join_light_pairs": """select o_orderkey, k, s_suppkey, r
        from (select o_orderkey, o_orderkey % 40 as k from orders)
        left join (select s_suppkey, s_suppkey % 40 as r from supplier) on k = r""",
    "fact_heavy_keys": f"""with {PEOPLE.replace("hcp as", "cool_hcp as", 1).replace(
          "affil as", "cool_affil as", 1)},
        hcp as (select * replace (case when cast(ID as bigint) % 4 = 0 then '3' else NPI end as NPI)
          from cool_hcp),
        affil as (select * replace (case when cast(ID as bigint) % 9 = 0 then '3' else HCP_NPI end
          as HCP_NPI) from cool_affil),
        {FACT} select * from fact""",
    "fact_customer_rows": f"with {PEOPLE}, {FACT} select * from fact",
    "fact_customer_by_sql": f"""with {PEOPLE}
        select distinct h.*, a.HCO_ID, d.CITY from hcp h
        left join affil a on h.NPI = a.HCP_NPI left join addr d on h.NPI = d.NPI""",
    "report_names": f"""with {PEOPLE} select distinct ID, {NAME},
        concat_ws(',', MIDDLE_NAME, NPI) as HCP_ADDR from hcp""",
    "report_address_rows": f"with {PEOPLE}, {FACT} {REPORT_ADDRESS}",
    "report_affiliation_rows": f"""with {PEOPLE}, {FACT}
        select distinct ID as HCP_ID, {NAME}, NPI as HCP_NPI, HCO_ID as HCP_HCO_ID from fact""",
    "publish_roundtrip": "select * from customer",
    "publish_numbered_files": "select * from orders",
    "publish_rebalanced": "select * from orders",
    "archive_copy": "select * from customer",
    "catalog_table": "select c_custkey, c_name, c_nationkey, c_mktsegment from customer",
    "warehouse_layout": """select cast(o_orderdate as date) as o_orderdate,
        cast(o_orderkey as varchar) as o_orderkey, o_custkey, o_totalprice, o_orderpriority
        from orders""",
    "log_append": _check(*PLAIN),
    "log_replace": f"""with {LANDING} {_log([DOMAIN_RULE])} union all
        {_log([STATUS_RULE], RUN.replace("cast(1 as integer) as RUN_ID", "cast(2 as integer) as RUN_ID"))}""",
    "load_audit": " union all ".join(
        _audit(run=1, job=10, name="'load'", id=i, type="RAW", dataset=name, process="INGESTION",
               count=_counted(name))
        for i, name in enumerate(("customer", "part", "orders", "lineitem", "events"), start=1)),
    "stage_orders": _staging(ALL),
    "stage_orders_log": _check(*ALL),
    "stage_orders_summary": f"with {LANDING} {_summary(ALL)}",
    "build_fact": f"with {PEOPLE}, {FACT} select * from fact",
    "build_report": f"with {PEOPLE}, {FACT} {REPORT_ADDRESS}",
    "build_audit": f"with {PEOPLE}, {FACT} " + " union all ".join([
        _audit(run=run, job=20, name="'fact'", id=4, type="PROCESSED", dataset="F_CUSTOMER",
               process="FACT", count=_counted("fact")) for run in (1, 2)] + [
        _audit(run=1, job=30, name="'report'", id=5, type="PROCESSED", dataset="RPT",
               process="REPORTING", count=_counted("(select distinct ID, NPI from fact)"))]),
    "dependency_frames": f"""with {PEOPLE}
        select 'STG_MDM_HCP' as DATASET_NAME, count(*) as n from hcp
        union all select 'STG_MDM_AFFIL', count(*) from affil
        union all select 'STG_VEEVA_ADDR', count(*) from addr""",
}
