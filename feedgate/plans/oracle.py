"""The registered queries in plain SQL, for a second engine to check them against.

Written for DuckDB on the given tables.  The derived feeds start from the same feed text as
the Spark side; everything after that is stated independently here.
"""

from __future__ import annotations

from feedgate.plans.feeds import CSV_COLUMNS, EARLIER_ID, EMPLOYEE_FEED, RUN_ID, csv_header
from feedgate.plans.tables import SHIPMENT_FEED

UUID = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
ISO_DATE = r"\d{4}-\d{2}-\d{2}"
NUMBER = r"-?\d+\.\d+"
PART_BYTES = 65536


def _uuid(c: str) -> str:
    return f"case when regexp_full_match({c}, '{UUID}') then lower({c}) end"


def _date(c: str) -> str:
    return f"case when regexp_full_match({c}, '{ISO_DATE}') then try_cast({c} as date) end"


def _flag(c: str) -> str:
    return f"case lower({c}) when 'true' then true when 'false' then false end"


def _text(c: str) -> str:
    return f"coalesce(nullif({c}, ''), ' ')"


def _bad(c: str, value: str, label: str) -> str:
    return f"case when coalesce({c}, '') <> '' and ({value}) is null then concat('{label}', {c}) end"


SKILLS = (
    "list_filter(list_transform(string_split(regexp_replace(regexp_replace(trim(skills), '^\\[', ''),"
    " '\\]$', ''), ','), lambda x: regexp_replace(regexp_replace(trim(x), '^\"', ''), '\"$', '')),"
    " lambda x: x <> '')"
)
CSV_SKILLS = f"case when coalesce(skills, '') = '' then '' else array_to_string({SKILLS}, '|') end"
JSON_SKILLS = """case src_row % 6 when 1 then 'Scala|Data Models|SQL' when 2 then 'a|5|null|true|'
  when 5 then replace(skills, ',', '|') else '' end"""

SALARY = f"case when regexp_full_match(salary, '{NUMBER}') then cast(salary as decimal(18,2)) end"

CSV_ERRORS = [
    _bad("employee_id", _uuid("employee_id"), "Invalid UUID: "),
    _bad("hire_date", _date("hire_date"), "Invalid date: "),
    _bad("salary", SALARY, "Invalid decimal: "),
    _bad("manager_id", _uuid("manager_id"), "Invalid UUID: "),
    _bad("is_active", _flag("is_active"), "Invalid boolean: "),
    "case when address is not null and not json_valid(address) then 'Invalid JSON in address' end",
    "case when emergency_contact is not null and not json_valid(emergency_contact)"
    " then 'Invalid JSON in emergency_contact' end",
]
JSON_ERRORS = [
    _bad("employee_id", _uuid("employee_id"), "Invalid UUID for field ''employee_id'': "),
    _bad("hire_date", _date("hire_date"), "Invalid date for field ''hire_date'': "),
    _bad("salary", SALARY, "Invalid decimal for field ''salary'': "),
    _bad("manager_id", _uuid("manager_id"), "Invalid UUID for field ''manager_id'': "),
    _bad("is_active", _flag("is_active"), "Invalid boolean for field ''is_active'': "),
]


def _member(column: str, key: str) -> str:
    return f"json_extract_string(case when json_valid({column}) then {column} end, '$.{key}')"


def _parsed(errors: list[str], skills: str) -> str:
    return f"""parsed as (select src_row, feed_file,
 {_uuid('employee_id')} as employee_id, {_text('first_name')} as first_name,
 {_text('last_name')} as last_name, {_text('email')} as email,
 {_text('phone_number')} as phone_number, {_date('hire_date')} as hire_date,
 {_text('department')} as department, {_text('job_title')} as job_title,
 {_text('currency')} as currency, {_text('employment_status')} as employment_status,
 {_uuid('manager_id')} as manager_id, {_flag('is_active')} as is_active,
 {SALARY} as salary, {skills} as skills,
 {_member('address', 'city')} as city,
 {_member('emergency_contact', 'name')} as contact_name,
 {_member('emergency_contact', 'relationship')} as contact_relationship,
 {_member('emergency_contact', 'phone')} as contact_phone,
 {_member('emergency_contact', 'email')} as contact_email,
 coalesce({', '.join(errors)}) as parse_error
from feed)"""


def _length(c: str, low: int, high: int) -> str:
    return (
        f"case when length({c}) not between {low} and {high}"
        f" then concat('{c} length ', length({c}), ' not in [{low}, {high}]') end"
    )


TRIMMED = r"length(regexp_replace(regexp_replace(currency, '^[\x00-\x20]+', ''), '[\x00-\x20]+$', ''))"
RULES = [
    ("employee_id present", "case when employee_id is null then 'employee_id is null (required primary key)' end"),
    ("first_name length", _length("first_name", 3, 15)),
    ("last_name length", _length("last_name", 0, 15)),
    ("email length", _length("email", 13, 30)),
    ("email shape", "case when trim(email) <> '' and not (email like '%@%' and email like '%.%')"
     " then 'email does not contain ''@'' and ''.''' end"),
    ("phone_number length", _length("phone_number", 10, 15)),
    ("department length", _length("department", 0, 20)),
    ("job_title length", _length("job_title", 0, 30)),
    ("currency width", f"case when {TRIMMED} <> 3 then concat('currency must be exactly 3 characters, got: ', {TRIMMED}) end"),
    ("employment_status length", _length("employment_status", 3, 13)),
    ("salary sign", "case when salary < 0 then 'salary must be non-negative' end"),
]
CHECK = ("currency stored width", "case when length(rtrim(currency)) <> 3 then"
         " 'currency does not fit its 3 character column' end")

REASONED = f"""reasoned as (select *, coalesce(parse_error,
 nullif(concat_ws('; ', {', '.join(sql for _, sql in RULES)}), ''), {CHECK[1]}) as reason
from parsed)"""

FEED = f"with feed as ({EMPLOYEE_FEED})"
CSV = f"{FEED}, {_parsed(CSV_ERRORS, CSV_SKILLS)}"
JSON = f"{FEED}, {_parsed(JSON_ERRORS, JSON_SKILLS)}"
CSV_VALID = f"""{CSV}, {REASONED}, valid as (select * from reasoned where reason is null),
firsts as (select * from (select *, row_number() over (partition by employee_id order by feed_file, src_row) as nth from valid) where nth = 1),
before as (select * from firsts where src_row % 3 = 0)"""

PLAIN = """src_row, employee_id, first_name, last_name, email, phone_number, hire_date, department,
 job_title, currency, employment_status, manager_id, is_active, salary, skills, city,
 contact_name, contact_phone"""
FAILED = "select feed_file as source_file, src_row, reason as error_reason from reasoned where reason is not null"

SERVED = """employee_id, first_name, last_name, email, phone_number, hire_date, department,
 job_title, case when length(currency) > 3 then substr(currency, 1, 3) else currency end as currency,
 employment_status, manager_id, coalesce(is_active, false) as is_active, salary, skills, city,
 contact_name, contact_phone, contact_email"""


def _loaded(base: str) -> str:
    """What a run leaves in the target; the feed files hold the rows in order of src_row."""
    return f"""{base}, {REASONED}, loaded as (select * from (select *, row_number() over
 (partition by employee_id order by src_row) as nth from reasoned where reason is null) where nth = 1)
select {SERVED}, '{RUN_ID}' as execution_id from loaded"""


def _cells(*parts: str) -> str:
    return f"{FEED} select src_row, {', '.join(parts)} from feed"


def _null_policy(base: str) -> str:
    return f"""{base} select
 count(*) filter (where first_name = ' ') as blank_first_names,
 count(*) filter (where department = ' ') as blank_departments,
 count(*) filter (where employee_id is null) as null_ids,
 count(*) filter (where manager_id is null) as null_managers,
 count(*) filter (where salary is null) as null_salaries,
 count(*) filter (where is_active is null) as null_flags,
 count(*) filter (where skills = '' and src_row % 6 <> 2) as empty_skills,
 cast(0 as bigint) as null_skills,
 (select count(*) from feed where address is null) as null_addresses
from parsed"""


_CELL = "coalesce(strlen({c}) + case when contains({c}, ',') or contains({c}, '\"') then 2 + strlen({c}) - strlen(replace({c}, '\"', '')) else 0 end, 0)"
_LINE_BYTES = " + ".join(
    _CELL.format(c=c if c != "src_row" else "cast(src_row as varchar)") for c in csv_header()
)

ROUNDTRIP = f"{FEED} select src_row, {', '.join(CSV_COLUMNS)} from feed"

# Input rows, their distinct keys, and what the target holds after the run.
COUNTS = """select (select count(*) from feed) as input_records,
 (select count(distinct employee_id) from parsed) as distinct_keys,
 (select count(employee_id) - count(distinct employee_id) from parsed) as duplicates_in_feed,
 (select count(*) from reasoned where reason is not null) as error_records,
 (select count(*) from firsts f where exists (select 1 from parsed p where p.employee_id = f.employee_id)) as matched_records,
 (select count(*) from firsts f where not exists (select 1 from before b where b.employee_id = f.employee_id)) as new_records,
 (select count(*) from firsts) as total_records"""
VERDICT = f"""counted as ({COUNTS}), judged as (select *, input_records - error_records as expected_records,
 matched_records - new_records as existing_records, matched_records as accounted_records,
 case when matched_records = input_records - error_records then 'passed' else 'mismatch' end as status from counted)"""

# Shipments
_S_NET = f"case when regexp_full_match(net, '{NUMBER}') then cast(net as decimal(12,2)) end"
def _shipments(of: str) -> str:
    """Typed and judged shipments; ``of`` is what follows the kind in a parse message."""
    where = {f: of.replace("*", f) for f in ("shipment_id", "ship_date", "net")}
    return f"""with feed as ({SHIPMENT_FEED}), typed as (select {_uuid('shipment_id')} as shipment_id,
 {_date('ship_date')} as ship_date, {_S_NET} as net, {_flag('returned')} as returned,
 {_text('status')} as status, l_suppkey, l_partkey, l_extendedprice, l_returnflag,
 coalesce({_bad('shipment_id', _uuid('shipment_id'), f'Invalid UUID{where["shipment_id"]}: ')},
  {_bad('ship_date', _date('ship_date'), f'Invalid date{where["ship_date"]}: ')},
  {_bad('net', _S_NET, f'Invalid decimal{where["net"]}: ')}) as parse_error from feed),
judged as (select *, coalesce(parse_error, nullif(concat_ws('; ', {_length('status', 1, 1)},
 case when status not in ('O', 'F') then concat('status is unknown: ', status) end,
 case when net < 0 then 'net must be non-negative' end), '')) as reason from typed),
firsts as (select * from (select *, row_number() over (partition by shipment_id
 order by l_suppkey, l_partkey, l_extendedprice) as nth from judged where reason is null) where nth = 1)"""

SHIP = _shipments("")
SHIP_JSON = _shipments(" for field ''*''")
OUTCOMES = "select coalesce(reason, 'valid') as outcome, count(*) as rows from judged group by 1"

DOCS = f"""with judged as (select doc_id, source, nullif(concat_ws('; ', {_length('text', 50, 5000)},
 case when lang not in ('en', 'fr', 'de') then concat('lang is unknown: ', lang) end,
 {_length('source', 1, 8)},
 case when not (source like '%@%' and source like '%.%') then 'source does not contain ''@'' and ''.''' end), '') as reason
from documents)"""

_RUNNING = "coalesce(sum(bytes) over (order by {k} rows between unbounded preceding and 1 preceding), 0)"


def _rule_counts(base: str, source: str, rules: list[tuple[str, str]]) -> str:
    return f"{base} " + " union all ".join(
        f"select '{name}' as rule, (select count({sql}) from {source}) as violations"
        for name, sql in rules
    )


def _texts(table: str, key: str, body: str) -> str:
    return f"select {key} as id, length({body}) as characters, md5({body}) as digest from {table}"


ORACLE: dict[str, str] = {
    "feed_inventory": f"""{FEED} select true as has_files,
 cast(0 as bigint) as oversized_files, cast(sum({_LINE_BYTES} + {len(csv_header())}) as bigint) as data_bytes from feed""",
    "read_csv_roundtrip": ROUNDTRIP,
    "read_csv_per_file_headers": ROUNDTRIP,
    "parse_csv_rows": f"{CSV} select {PLAIN}, parse_error from parsed",
    "parse_json_arrays": f"{JSON} select {PLAIN}, parse_error from parsed",
    "parse_json_lines": f"{JSON} select {PLAIN}, parse_error from parsed",
    "parse_json_large_arrays": f"{JSON} select {PLAIN}, parse_error from parsed",
    "parse_uuid": _cells(
        f"{_uuid('employee_id')} as employee_id", f"{CSV_ERRORS[0]} as employee_id_error",
        f"{_uuid('manager_id')} as manager_id", f"{CSV_ERRORS[3]} as manager_id_error",
    ),
    "parse_date": _cells(f"{_date('hire_date')} as hire_date", f"{CSV_ERRORS[1]} as hire_date_error"),
    "parse_decimal": _cells(f"{SALARY} as salary", f"{CSV_ERRORS[2]} as salary_error"),
    "parse_boolean": _cells(f"{_flag('is_active')} as is_active", f"{CSV_ERRORS[4]} as is_active_error"),
    "parse_skills": _cells(f"{CSV_SKILLS} as skills"),
    "parse_json_cells": _cells(
        "address", f"{CSV_ERRORS[5]} as address_error",
        "emergency_contact", f"{CSV_ERRORS[6]} as emergency_contact_error",
    ),
    "parse_uuid_lenient": """select c_custkey, concat(lpad(cast(c_custkey as varchar), 8, '0'), '-',
 lpad(cast(c_nationkey as varchar), 4, '0'), '-000a-00bc-', lpad(cast(c_custkey as varchar), 12, '0')) as lenient,
 cast(null as varchar) as strict from customer""",
    "parse_decimal_forms": """with c as (select o_orderkey, cast(round(o_totalprice * 100) as bigint) as cents from orders)
select o_orderkey, case o_orderkey % 5 when 0 then concat(cents, '.50')
 when 1 then cast(cast(cast(-cents as decimal(18,0)) / 100 as decimal(18,2)) as varchar)
 when 2 then case when cents > 999 then concat(substr(cast(cents as varchar), 1, 3), '.', substr(cast(cents as varchar), 4))
  else rpad(cast(cents as varchar), 3, '0') end
 when 3 then cast(cents as varchar) end as amount from c""",
    # One character after the other: q inside quotes, p behind a quote there, o what is read so far;
    # cells are told apart by chr(1).
    "csv_cells_of_text": """with lines as (select doc_id, cast(generate_subscripts(string_split(text, chr(10)), 1) - 1 as integer) as line_no,
 replace(unnest(string_split(text, chr(10))), 'e', '"') as line from documents),
scanned as (select doc_id, line_no, list_reduce([{'q': false, 'p': false, 'o': ''}]
 || list_transform(regexp_extract_all(line, '(?s).'), lambda c: {'q': false, 'p': false, 'o': c}), lambda a, x: case
 when a.q and a.p and x.o = '"' then {'q': true, 'p': false, 'o': a.o || '"'}
 when a.q and not a.p and x.o = '"' then {'q': true, 'p': true, 'o': a.o}
 when a.q and not a.p then {'q': true, 'p': false, 'o': a.o || x.o}
 when x.o = '"' then {'q': true, 'p': false, 'o': a.o}
 when x.o = ',' then {'q': false, 'p': false, 'o': a.o || chr(1)}
 else {'q': false, 'p': false, 'o': a.o || x.o} end).o as cells from lines),
cut as (select *, string_split(cells, chr(1)) as c from scanned)
select doc_id, line_no, cast(len(c) as integer) as count, md5(cells) as digest, nullif(c[1], '') as first,
 nullif(c[2], '') as second, nullif(c[3], '') as third from cut""",
    "parse_first_error": f"{CSV} select src_row, parse_error from parsed",
    "parse_all_errors": f"{FEED} select src_row, nullif(concat_ws('; ', {', '.join(CSV_ERRORS)}), '') as parse_errors from feed",
    "json_element_isolation": f"""{JSON}, {REASONED} select count(*) as elements,
 count(parse_error) as parse_errors, count(reason) as errors,
 count(*) filter (where reason is null) as valid from reasoned""",
    "null_policy_csv": _null_policy(CSV),
    "null_policy_json": _null_policy(JSON),
    "validate_violations": f"""{CSV}, listed as (select src_row, list_filter([{', '.join(sql for _, sql in [*RULES, CHECK])}],
 lambda x: x is not null) as v from parsed)
select src_row, cast(len(v) as integer) as broken_rules, array_to_string(v, '; ') as violations from listed""",
    "violations_by_rule": _rule_counts(CSV, "parsed where parse_error is null", [*RULES, CHECK]),
    "route_valid": f"{CSV}, {REASONED} select {PLAIN} from reasoned where reason is null",
    "route_errors": f"""{CSV}, {REASONED} select src_row, '{RUN_ID}' as execution_id, feed_file as source_file,
 reason as error_reason, '2024-06-01 12:00:00' as timestamp from reasoned where reason is not null""",
    "error_lines": f"""{CSV}, {REASONED} select feed_file, '{RUN_ID}' as "executionId", feed_file as "sourceFile",
 reason as "errorReason", '2024-06-01T12:00:00.000000Z' as timestamp from reasoned where reason is not null""",
    "errors_replayed": f"""{CSV}, {REASONED} select src_row, reason, true as same_reason
 from reasoned where reason is not null""",
    "errors_per_file": f"""{CSV}, {REASONED} select feed_file as source_file, count(*) as errors
 from reasoned where reason is not null group by rollup (feed_file)""",
    "first_errors_per_file": f"""{CSV}, {REASONED}, failed as ({FAILED}), placed as (select source_file,
 cast(row_number() over (partition by source_file order by src_row) as integer) as position, src_row, error_reason from failed)
select * from placed where position <= 5""",
    "first_wins": f"{CSV_VALID} select employee_id, src_row from firsts",
    "first_wins_hot_keys": """select l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey from (select *,
 row_number() over (partition by l_returnflag order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_extendedprice) as nth from lineitem) where nth = 1""",
    "insert_if_absent": f"""{CSV_VALID} select employee_id, src_row from firsts f
 where not exists (select 1 from before b where b.employee_id = f.employee_id)""",
    "rerun_is_noop": f"""{CSV_VALID} select count(*) as inserted from valid v
 where not exists (select 1 from firsts f where f.employee_id = v.employee_id)""",
    "insert_with_key_index": """select distinct concat('new o', cast(o_orderkey as varchar)) as id, true as fewer_files
 from orders where substr(cast(o_orderdate as varchar), 1, 10) >= '2001-03-01' and o_orderkey % 3 = 0""",
    "matched_keys": f"""{CSV_VALID} select (select count(*) from feed) as input_records,
 (select count(distinct employee_id) from parsed) as distinct_keys,
 (select count(employee_id) - count(distinct employee_id) from parsed) as duplicates_in_feed,
 (select count(*) from before b where exists (select 1 from parsed p where p.employee_id = b.employee_id)) as matched_records""",
    "stamped_rows": f"""{CSV_VALID} select employee_id, first_name, substr(currency, 1, 3) as currency,
 cast(length(substr(currency, 1, 3)) as integer) as currency_width, nullif(skills, '') as skills,
 '2024-06-01 12:00:00' as ingested_at, '{RUN_ID}' as execution_id from valid""",
    "reconcile": f"{CSV_VALID}, {VERDICT} select * from judged",
    "run_summary": f"""{CSV_VALID}, {VERDICT} select '{RUN_ID}' as execution_id, 'feeds/in' as input_directory,
 'csv' as file_format, cast(4 as bigint) as input_file_count, true as split,
 case when status = 'passed' then 'success' else 'failed' end as state, * from judged""",
    "control_totals": f"""{FEED}, counts as (select feed_file as file_name, count(*) as input_records from feed group by all)
select file_name, case file_name when 'feed_3' then null when 'feed_2' then input_records + 1 else input_records end as expected_records,
 input_records, case file_name when 'feed_3' then 'record_count must be a valid number' end as violation,
 case file_name when 'feed_3' then 'refused' when 'feed_2' then 'mismatch' else 'matched' end as status from counts""",
    "split_plan": f"""with lines as (select o_orderkey, strlen(concat_ws(',', cast(o_orderkey as varchar),
 cast(o_custkey as varchar), o_orderstatus, o_orderpriority)) as bytes from orders),
placed as (select o_orderkey, cast({_RUNNING.format(k='o_orderkey')} as bigint) as start from lines)
select o_orderkey, start, start // {PART_BYTES} + 1 as part from placed""",
    "split_plan_documents": f"""with sized as (select doc_id, strlen(text) as bytes from documents),
placed as (select bytes, cast({_RUNNING.format(k='doc_id')} as bigint) as start from sized)
select start // {PART_BYTES} + 1 as part, count(*) as rows, cast(sum(bytes) as bigint) as bytes from placed group by 1""",
    "split_counts": f"""with files as (select source as file_name, cast(sum(strlen(text)) as bigint) as bytes from documents group by 1)
select file_name, bytes, bytes > {PART_BYTES} as oversized,
 greatest(1, (bytes + {PART_BYTES - 1}) // {PART_BYTES}) as parts from files""",
    "split_csv_roundtrip": ROUNDTRIP,
    "split_json_arrays_roundtrip": f"{JSON} select {PLAIN}, parse_error from parsed",
    "split_json_lines_roundtrip": f"{JSON} select {PLAIN}, parse_error from parsed",
    "protect_roundtrip": f"{CSV_VALID} select src_row, phone_number, cast(salary as varchar) as salary, contact_phone from valid",
    "protect_layout": f"""{CSV_VALID} select src_row, cast(4 * ceil((28 + strlen(phone_number)) / 3.0) as integer) as text_length,
 cast(28 + strlen(phone_number) as integer) as byte_length, false as has_breaks, salary is null as salary_absent, false as shows_plain from valid""",
    "protect_json_key": f"""{CSV_VALID} select src_row, contact_name, contact_relationship, contact_email,
 cast(4 * ceil((28 + strlen(contact_phone)) / 3.0) as integer) as phone_text_length, contact_phone from valid""",
    "protect_blank_cipher": """select conv_id, turn, turn % 3 = 0 or text is null as absent,
 case when turn % 3 <> 0 then md5(text) end as digest from conversations""",
    "protect_wrong_key": f"{CSV_VALID} select count(*) as rows, cast(0 as bigint) as readable from valid",
    "serve_newest_first": f"""{CSV_VALID} select {SERVED}, case when src_row % 10 = 0 then null
 when src_row % 2 = 0 then '2024-06-01 12:00:00' else '2024-06-02 12:00:00' end as execution_id,
 row_number() over (order by case when src_row % 10 = 0 then 0 when src_row % 2 = 0 then 2 else 1 end, employee_id) as place from firsts""",
    "ingest_csv": _loaded(CSV),
    "ingest_json": _loaded(JSON),
    "ingest_bucketed": _loaded(CSV),
    "ingest_announced": f"""{CSV_VALID}, counted as ({COUNTS})
select '{RUN_ID}' as execution_id, true as split, true as several_parts, input_records, error_records,
 total_records as new_records, total_records, distinct_keys, input_records + 1 as announced_records,
 'mismatch' as announced_status from counted""",
    "ingest_all_announced": f"""with c as ({CSV}, {REASONED} select distinct employee_id from reasoned where reason is null),
j as ({JSON}, {REASONED} select distinct employee_id from reasoned where reason is null),
n as ({FEED} select count(*) as n from feed), more as (select count(*) as m from j where employee_id not in (select employee_id from c))
select 'loaded' as outcome, null as reason, n as input_records, (select count(*) from c) as new_records,
 (select count(*) from c) as total_records, 'matched' as announced_status from n
union all select 'refused', 'record_count must be a valid number', null, null, null, null
union all select 'loaded', null, n, m, (select count(*) from c) + m, 'matched' from n, more""",
    "errors_of_two_runs": f"""{CSV}, {REASONED} select run as execution_id, run as "executionId", feed_file, count(*) as errors
 from reasoned, (select unnest(['{RUN_ID}', '{EARLIER_ID}']) as run) where reason is not null group by all""",
    "split_keeps_winners": """select concat('k', o_custkey % 300) as key, min(o_orderkey) as row, min(o_orderkey) as split_row
 from orders group by 1""",
    "documents_any_size": """with kinds as (select c_custkey as k, c_nationkey % 7 as kind, c_nationkey from customer),
rows as (select 'object' as outcome, k from kinds where kind = 0 or kind = 3 and k % 2 = 1
 union all select 'object', -1 from (select distinct c_nationkey from kinds where kind = 4)
 union all select 'scalar', null from kinds where kind = 1 union all select 'array', null from kinds where kind = 2
 union all select 'null', null from kinds where kind = 3 and k % 2 = 0
 union all select 'malformed', null from (select distinct c_nationkey from kinds where kind in (5, 6)))
select mode, outcome, count(*) as rows, cast(coalesce(sum(k), 0) as bigint) as keys
 from rows, (select unnest(['whole', 'cut', 'split']) as mode) group by all""",
    "amounts_served_exactly": """with c as (select o_orderkey as id, cast(cast(round(o_totalprice * 100) as bigint) as varchar) as cents from orders)
select id, case id % 3 when 0 then concat(lpad(cents, 30, '7'), '.', lpad(cents, 15, '3'))
 when 1 then concat('-0.', lpad(cents, 15, '0'))
 else concat(cents[1], case when length(cents) > 1 then '.' || cents[2:] else '' end, 'E+', 999 + id + length(cents)) end as amount from c""",
    "split_csv_multiline_roundtrip": _texts("documents", "doc_id", "text"),
    "stamped_from_files": f"""{CSV_VALID} select count(*) as rows, cast(1 as bigint) as runs, cast(1 as bigint) as instants,
 count(*) as rows_with_their_files_time from valid""",
    "refusals": """select * from (values ('no files', 'nothing that looks like csv'), ('empty file', 'feed files of zero bytes'),
 ('no records', 'the feed holds no records'), ('short key', 'the encryption key must be exactly 32 bytes')) as t("case", message)
 where (select count(*) from nation) > 0""",
    "json_nested_array": """with r as (select o_orderkey as k, concat('[,"]}', o_orderpriority) as t from orders
 union all select 0, '' from (select unnest(range(6))))
select mode, cast(null as varchar) as error, k, t from r, (select unnest(['whole', 'cut']) as mode)""",
    "reconcile_differences": """select distinct concat('k', cast(o_orderkey as varchar)) as key, 'missing' as side from orders where o_orderkey % 97 = 5
 union all select distinct concat('x', cast(o_orderkey as varchar)), 'extra' from orders where o_orderkey % 89 = 7""",
    "csv_any_character": """with t as (
 select doc_id, regexp_replace(coalesce(text, ''), '[\\r\\n]+', ' ', 'g') as flat,
 [chr(65535), chr(65534), chr(64976), chr(64977), chr(0)][cast(doc_id % 5 + 1 as integer)] as sign from documents
), b as (select sign, doc_id, concat(substr(flat, 1, 10), sign, substr(flat, 11)) as body from t)
select mode, md5(concat(sign, cast(doc_id as varchar))) as id, length(body) as characters, md5(body) as digest
from b, (select unnest(['whole', 'split']) as mode)""",
    "csv_quoted_blocks": f"""select * from ({_texts("documents", "doc_id", "text")}),
 (select unnest(['many', 'few', 'default']) as blocks)""",
    "split_even_parts": """select count(*) as records, cast(0 as bigint) as parts_too_large,
 true as no_more_parts_than_needed from documents""",
    "ingest_report": f"""{CSV_VALID}, counted as ({COUNTS})
select '{RUN_ID}' as execution_id, 'csv' as file_format, input_records, error_records,
 input_records - error_records as expected_records, distinct_keys, duplicates_in_feed, total_records,
 case when matched_records = input_records - error_records then 'passed' else 'mismatch' end as status,
 case when matched_records = input_records - error_records then 'success' else 'failed' end as state from counted""",
    "ingest_staged_errors": f"{CSV}, {REASONED} select reason as error_reason, count(*) as errors from reasoned where reason is not null group by 1",
    "shipments_by_outcome": f"{SHIP} {OUTCOMES}",
    "shipments_csv_files": f"{SHIP} {OUTCOMES}",
    "shipments_json_lines": f"{SHIP_JSON} {OUTCOMES}",
    "shipments_json_arrays": f"{SHIP_JSON} {OUTCOMES}",
    "shipments_one_array": f"{SHIP_JSON} {OUTCOMES}",
    "shipments_by_rule": _rule_counts(SHIP, "typed where parse_error is null", [
        ("shipment_id present", "case when shipment_id is null then 1 end"),
        ("status length", _length("status", 1, 1)),
        ("status known", "case when status not in ('O', 'F') then 1 end"),
        ("net sign", "case when net < 0 then 1 end"),
    ]),
    "shipments_first_wins": f"{SHIP} select shipment_id, ship_date, net, returned, status from firsts",
    "shipments_new": f"""{SHIP} select shipment_id, ship_date, returned from firsts f where not exists
 (select 1 from orders o where o.o_orderstatus = 'F' and o.o_orderkey = cast(right(f.shipment_id, 12) as bigint))""",
    "shipment_errors_per_flag": f"""{SHIP} select l_returnflag as source_file, count(*) as errors
 from judged where reason is not null group by rollup (l_returnflag)""",
    "shipment_first_errors": f"""{SHIP}, placed as (select l_returnflag as source_file, cast(row_number() over
 (partition by l_returnflag order by l_suppkey, l_partkey, l_extendedprice) as integer) as position,
 l_partkey, reason as error_reason from judged where reason is not null) select * from placed where position <= 5""",
    "document_reasons": f"{DOCS} select doc_id, reason from judged",
    "document_first_errors": f"""{DOCS}, placed as (select source as source_file, cast(row_number() over
 (partition by source order by doc_id) as integer) as position, doc_id, reason as error_reason
 from judged where reason is not null) select * from placed where position <= 5""",
    "event_properties": """select event_id, cast(json_extract_string(props, '$.k') as integer) as k,
 cast(null as varchar) as k_error, cast(null as boolean) as flag,
 concat('Invalid boolean for field ''k'': ', json_extract_string(props, '$.k')) as flag_error from events""",
    "customers_with_orders": """select (select count(*) from customer c where not exists
 (select 1 from orders o where o.o_custkey = c.c_custkey)) as without_orders,
 (select count(*) from customer c where exists (select 1 from orders o where o.o_custkey = c.c_custkey)) as with_orders""",
    "documents_csv_multiline": _texts("documents", "doc_id", "text"),
    "documents_json_lines": _texts("documents", "doc_id", "text"),
    "pages_json_arrays": _texts("pages", "page_id", "html"),
    "conversations_protected": """select conv_id, turn, cast(4 * ceil((28 + strlen(text)) / 3.0) as integer) as sealed_length,
 md5(text) as digest from conversations""",
}
