"""SQL over the test tables that the registered queries must agree with.

The SQL follows the plain definitions (row-level joins, full outer joins, EXCEPT),
not the shortcuts of the DataFrame plans, so that agreement says something.
"""

from __future__ import annotations

from ledgerspark.plans.staging import SILVER_NAMES

# The accepted sets and bounds, as the suites are expected to state them.
YEARS = "2022, 2023, 2024, 2025, 2026"
LEDGERS = "'ACTUALS', 'BUDGET', 'ENCUMBRANCE', 'APPROPRIATION'"
TWELVE = "1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12"
KPI_EXISTS = """exists fiscal_year
exists month
exists department_name
exists total_revenue
exists total_expenses
exists net_amount
exists transaction_count"""
BALANCE = "true net_amount round(total_revenue + total_expenses, 2) = round(net_amount, 2)"

SILVER_CHECKS = f"""exists ledger_sk
exists amount
exists fiscal_year
exists ledger
not_null ledger_sk
not_null amount
unique ledger_sk
in_set fiscal_year {YEARS}
in_set ledger {LEDGERS}
min amount -20000000000
max amount 20000000000"""
SILVER_COLUMN_CHECKS = f"""unique ledger_sk
not_null ledger_sk
not_null amount
not_null fiscal_year
not_null file_fiscal_quarter
not_null ledger
not_null agency_nbr
not_null account
not_null dept_id
in_set fiscal_year {YEARS}
in_set file_fiscal_quarter 1, 2, 3, 4
in_set ledger {LEDGERS}"""
GOLD_CHECKS = f"""{KPI_EXISTS}
not_null fiscal_year
not_null month
not_null department_name
not_null net_amount
in_set fiscal_year {YEARS}
mostly_in_set month {TWELVE}
min total_revenue -100000000000
max total_revenue 100000000000
min total_expenses -2000000000000
max total_expenses 100000000000
between transaction_count 0 and 1000000
min net_amount -2000000000000
max net_amount 200000000000"""
KPI_CHECKS = f"""{KPI_EXISTS}
not_null fiscal_year
not_null month
not_null net_amount
in_set month {TWELVE}
min total_expenses -50000000000
max total_revenue 50000000000
equal net_amount total_revenue + total_expenses"""
FACT_CHECKS = "not_null amount"
FUND_MART_CHECKS = f"not_null fiscal_year\nnot_null month\nnot_null fund_code\n{BALANCE}"
AGENCY_MART_CHECKS = f"not_null fiscal_year\nnot_null agency_id\nnot_null fund_code\n{BALANCE}"

MEASURES = """
    cast(sum(case when {positive} then amount else 0 end) as decimal(38,2)) as total_revenue,
    cast(sum(case when amount < 0 then amount else 0 end) as decimal(38,2)) as total_expenses,
    cast(sum(amount) as decimal(38,2)) as net_amount,
    count(*) as transaction_count"""
ROLLUP = MEASURES.format(positive="amount >= 0")
STRICT_ROLLUP = MEASURES.format(positive="amount > 0")

LINE_AMOUNT = (
    "cast(case when l_linestatus = 'O' then l_extendedprice else -l_extendedprice end"
    " as decimal(18,2))"
)


def md5_key(*cols: str) -> str:
    parts = ", '-', ".join(f"coalesce(cast({c} as varchar), '')" for c in cols)
    return f"md5(concat({parts}))"


# What becomes of a raw text; every column not named here is trimmed.
RULES = {
    "trimmed": "trim({})",
    "code": "nullif(trim({}), '')",
    "untrimmed code": "nullif({}, '')",
    "number": "try_cast(try_cast(trim({}) as double) as integer)",
    "money": "cast({} as decimal(18,2))",
}
RULE_OF = {
    "AGENCYNBR": "code",
    "LEDGER": "code",
    "DEPTID": "code",
    "ROWID": "code",
    "FUND_CODE": "untrimmed code",
    "ACCOUNT": "untrimmed code",
    "FISCAL_YEAR": "number",
    "ACCOUNTING_PERIOD": "number",
    "POSTED_TOTAL_AMT": "money",
}
FALLBACK = {"AGENCYNBR": "OPERATING_UNIT", "AGENCYNAME": "OPERUNITDESCR"}
NEVER_NULL = "agency_nbr ledger fiscal_year accounting_period fund_code dept_id account row_id".split()


def silver() -> str:
    """Every raw column by its rule, then the rows that have all required columns, with their key."""
    columns = []
    for raw, name in SILVER_NAMES.items():
        source = f"coalesce({raw}, {FALLBACK[raw]})" if raw in FALLBACK else raw
        columns.append(f"{RULES[RULE_OF.get(raw, 'trimmed')].format(source)} as {name}")
    key = md5_key(*NEVER_NULL[:-1], "project_id", NEVER_NULL[-1], "source_path")
    present = " and ".join(f"{c} is not null" for c in NEVER_NULL)
    return f"""
    select {key} as ledger_sk, *
    from (select {", ".join(columns)}, source_path from raw) where {present}"""


def dim(sk: str, key: str, key_name: str, description: str, name: str) -> str:
    return f"""
    select {md5_key(key)} as {sk}, {key} as {key_name}, {description} as {name}
    from (select distinct {key}, {description} from silver
          where {key} is not null and {description} is not null)"""


# Named subqueries; each lists what it reads.
TABLES: dict[str, tuple[list[str], str]] = {
    "tidy_raw": (
        [],
        f"""
    select
      case when o_orderpriority <> '1-URGENT'
           then concat(' ', lpad(cast(n_nationkey as varchar), 3, '0'), '  ') end as AGENCYNBR,
      case when o_orderpriority <> '1-URGENT'
           then concat(n_name, case when n_nationkey = 3 and l_linenumber = 1 then ' (old)'
                           else ' ' end) end as AGENCYNAME,
      case l_returnflag when 'A' then 'ACTUALS ' when 'N' then 'BUDGET '
           else 'ENCUMBRANCE ' end as LEDGER,
      concat(cast(year(l_shipdate) as varchar), '.0') as FISCAL_YEAR,
      concat(' ', cast(month(l_shipdate) as varchar)) as ACCOUNTING_PERIOD,
      substr(c_mktsegment, 1, 3) as FUND_CODE,
      concat(' ', c_mktsegment) as FUNDDESCR,
      p_type as CLASS_FLD,
      concat(p_type, ' class') as CLASSDESCR,
      concat(' ', lpad(cast(s_suppkey as varchar), 7, '0')) as DEPTID,
      concat(s_name, ' ') as DEPTDESCR,
      substr(p_brand, 7) as ACCOUNT,
      p_brand as ACCTDESCR,
      lpad(cast(n_nationkey as varchar), 3, '0') as OPERATING_UNIT,
      n_name as OPERUNITDESCR,
      cast(p_size as varchar) as PRODUCT,
      p_name as PRODUCTDESCR,
      nullif(p_type, 'ECONOMY') as PROGRAM_CODE,
      p_type as PGMDESCR,
      cast(year(o_orderdate) as varchar) as BUDGET_REF,
      o_orderstatus as CHARTFIELD1,
      cast(null as varchar) as CF1DESCR,
      cast(null as varchar) as CHARTFIELD2,
      cast(null as varchar) as CF2DESCR,
      substr(o_orderpriority, 1, 1) as PROJECT_ID,
      o_orderpriority as PROJDESCR,
      cast({LINE_AMOUNT} as varchar) as POSTED_TOTAL_AMT,
      l_linestatus as ACTIVITY,
      cast(null as varchar) as ACTVDESCR,
      cast(null as varchar) as RESTYPE,
      cast(null as varchar) as RESDESCR,
      cast(null as varchar) as RCAT,
      cast(null as varchar) as RCATDESCR,
      cast(null as varchar) as RSUBCAT,
      cast(null as varchar) as RSUBCATDESCR,
      concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar), '-',
             cast(l_partkey as varchar), '-', cast(l_suppkey as varchar)) as ROWID,
      concat('ledger_fy', substr(cast(year(l_shipdate) as varchar), 3, 2), '_qtr',
             cast(quarter(l_shipdate) as varchar), '.csv') as source_path,
      l_orderkey % 101 as odd
    from lineitem
    join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey
    join supplier on l_suppkey = s_suppkey
    join part on l_partkey = p_partkey""",
    ),
    "raw": (
        ["tidy_raw"],
        """
    select * exclude (odd) replace (
      case when odd <> 1 then AGENCYNBR end as AGENCYNBR,
      case when odd <> 1 then OPERATING_UNIT end as OPERATING_UNIT,
      if(odd = 2, '  ', LEDGER) as LEDGER,
      if(odd = 3, 'n/a', FISCAL_YEAR) as FISCAL_YEAR,
      case odd when 4 then '' when 9 then '0' when 10 then '13' else ACCOUNTING_PERIOD end
        as ACCOUNTING_PERIOD,
      if(odd = 5, '', FUND_CODE) as FUND_CODE,
      case when odd <> 6 then DEPTID end as DEPTID,
      case when odd <> 7 then ACCOUNT end as ACCOUNT,
      if(odd = 8, ' ', ROWID) as ROWID,
      case when odd <> 11 then FUNDDESCR end as FUNDDESCR)
    from tidy_raw""",
    ),
    "silver": (["raw"], silver()),
    "agencies": (
        ["silver"],
        dim("agency_sk", "agency_nbr", "agency_business_key", "agency_name", "agency_name"),
    ),
    "funds": (
        ["silver"],
        dim("fund_sk", "fund_code", "fund_business_key", "fund_descr", "fund_name"),
    ),
    "departments": (
        ["silver"],
        dim(
            "department_sk", "dept_id", "department_business_key", "dept_descr", "department_name"
        ),
    ),
    "accounts": (
        ["silver"],
        dim("account_sk", "account", "account_business_key", "acct_descr", "account_name"),
    ),
    "fact": (
        ["agencies", "funds", "departments", "accounts"],
        """
    select agency_sk, fund_sk, department_sk, account_sk, account_name, ledger, project_id,
           budget_ref, amount, fiscal_year, accounting_period
    from silver
    left join agencies on agency_nbr = agency_business_key
    left join funds on fund_code = fund_business_key
    left join departments on dept_id = department_business_key
    left join accounts on account = account_business_key""",
    ),
    "decorated": (
        ["fact"],
        """
    select t.agency_sk, t.fund_sk, t.department_sk, t.account_sk, a.agency_name, f.fund_name,
           d.department_name, c.account_name, t.amount, t.fiscal_year,
           t.accounting_period as month
    from fact t
    left join agencies a on t.agency_sk = a.agency_sk
    left join funds f on t.fund_sk = f.fund_sk
    left join departments d on t.department_sk = d.department_sk
    left join accounts c on t.account_sk = c.account_sk""",
    ),
    "monthly": (
        ["decorated"],
        """
    select department_sk, fiscal_year, month,
           cast(sum(amount) as decimal(38,2)) as total_monthly_amount
    from decorated group by 1, 2, 3""",
    ),
    "kpi": (
        ["fact"],
        f"""
    select t.fiscal_year, t.accounting_period as month, d.department_name, {STRICT_ROLLUP}
    from fact t left join departments d on t.department_sk = d.department_sk
    group by 1, 2, 3""",
    ),
    "fund_mart": (
        ["fact"],
        f"""
    select t.fiscal_year, t.accounting_period as month, f.fund_business_key as fund_code,
           f.fund_name, {ROLLUP}
    from fact t left join funds f on t.fund_sk = f.fund_sk
    where f.fund_sk is not null group by 1, 2, 3, 4""",
    ),
    "agency_mart": (
        ["fact"],
        f"""
    select t.fiscal_year, a.agency_business_key as agency_id, a.agency_name,
           f.fund_business_key as fund_code, f.fund_name, {ROLLUP}
    from fact t left join agencies a on t.agency_sk = a.agency_sk
    left join funds f on t.fund_sk = f.fund_sk
    where a.agency_sk is not null and f.fund_sk is not null group by 1, 2, 3, 4, 5""",
    ),
    "file_quarters": (
        ["silver"],
        """
    select *, cast(regexp_extract(source_path, '_qtr([1-4])', 1) as integer)
      as file_fiscal_quarter from silver""",
    ),
    "scaffold": (
        ["fact"],
        """
    select fiscal_year, fund_sk, agency_sk, accounting_period
    from (select distinct fiscal_year, fund_sk, agency_sk from fact)
    cross join unnest(generate_series(1, 12)) as p(accounting_period)""",
    ),
    "uneven": (
        ["fact"],
        """
    select * replace (nullif(fund_sk, md5('BUI')) as fund_sk,
      if(fund_sk = md5('AUT') and ledger = 'ACTUALS', 'BUDGET', ledger) as ledger) from fact""",
    ),
    "untidy": (
        [],
        """
    select o_orderkey, concat(o_orderstatus, ' ') as unit,
      case o_orderpriority when '1-URGENT' then '   ' when '2-HIGH' then ''
           when '3-MEDIUM' then null else concat('  ', o_orderpriority, ' ') end as code
    from orders""",
    ),
    "shared": (
        [],
        f"""
    select cast(s_nationkey as varchar) as dept_id, s_name as dept_descr,
           cast(year(l_shipdate) as integer) as fiscal_year, {LINE_AMOUNT} as amount
    from lineitem join supplier on l_suppkey = s_suppkey""",
    ),
    "shared_departments": (
        ["shared"],
        """
    select md5(dept_id) as department_sk, dept_id as department_business_key,
           dept_descr as department_name
    from (select distinct dept_id, dept_descr from shared)""",
    ),
    "contract": (
        ["silver"],
        """
    select cast(amount as double) as amount, fiscal_year,
           cast(ceil(accounting_period / 3.0) as integer) as quarter,
           dept_descr as department_name, product_descr as vendor_name,
           acct_descr as transaction_description, fund_code
    from silver""",
    ),
}


class Composed(str):
    """Complete SQL text that remembers its last part and the subqueries in front."""

    select: str
    reads: list[str]


def sql(select: str, *reads: str) -> Composed:
    """``select`` with the named subqueries that it needs in front."""
    needed: list[str] = []

    def add(name: str) -> None:
        for parent in TABLES[name][0]:
            add(parent)
        if name not in needed:
            needed.append(name)

    for name in reads:
        add(name)
    ctes = ",\n".join(f"{name} as ({TABLES[name][1]})" for name in needed)
    text = Composed(f"with {ctes}\n{select}" if ctes else select)
    text.select, text.reads = select, needed
    return text


def variance(table: str, null_safe: bool = False, plan_keys: bool = False) -> str:
    """Groups with both kinds of lines, with actuals only, and with a budget only."""
    same = "is not distinct from" if null_safe else "="
    match = f"a.fiscal_year {same} b.fiscal_year and a.fund_sk {same} b.fund_sk"
    keys = "fiscal_year, fund_sk"
    totals = [
        f"(select {keys}, sum(amount) as total from {table} where ledger = '{kind}' group by {keys})"
        for kind in ("ACTUALS", "BUDGET")
    ]
    actual, budget = totals
    only_planned = keys if plan_keys else "null, null"
    return f"""
    select {keys}, cast(spent as decimal(38,2)) as actual_amount,
      cast(planned as decimal(38,2)) as budgeted_amount,
      cast(planned - spent as decimal(38,2)) as budget_variance
    from (
      select a.fiscal_year, a.fund_sk, a.total as spent, b.total as planned
      from {actual} a join {budget} b on {match}
      union all
      select {keys}, total, 0 from {actual} a where not exists (from {budget} b where {match})
      union all
      select {only_planned}, 0, total from {budget} b where not exists (from {actual} a where {match})
    )"""


def check(
    table: str, kind: str, column: str, success: str, unexpected: str = "null", seen: str = "null"
) -> str:
    """One expectation result, computed by its own scan."""
    return f"""
    select '{kind}' as expectation, '{column}' as "column", {success} as success,
      count(*) as element_count, cast({unexpected} as bigint) as unexpected_count,
      cast({seen} as varchar) as observed_value
    from {table}"""


def value_check(table: str, kind: str, column: str, passes: str, mostly: float = 1.0) -> str:
    bad = f"count(*) filter (where not ({passes}))"
    judged = f"count(*) filter (where ({passes}) is not null)"
    ok = f"({judged} = 0 or ({judged} - {bad}) / cast(nullif({judged}, 0) as double) >= {mostly})"
    return check(table, kind, column, ok, bad)


# Result name of a kind of check, and the condition that it puts on a value.
VALUE_KINDS = {
    "in_set": ("expect_column_values_to_be_in_set", "{c} in ({a})"),
    "mostly_in_set": ("expect_column_values_to_be_in_set", "{c} in ({a})"),
    "between": ("expect_column_values_to_be_between", "{c} between {a}"),
    "equal": ("expect_column_to_equal_expression", "{c} = {a}"),
    "true": ("expect_expression_to_be_true", "{a}"),
}
EXTREME_KINDS = {
    "min": ("expect_column_min_to_be_between", "min({c}) >= {a}"),
    "max": ("expect_column_max_to_be_between", "max({c}) <= {a}"),
}


def suite(table: str, checks: str) -> str:
    """The result rows of a suite, one scan per line (kind, column, argument)."""
    rows = []
    for line in checks.splitlines():
        kind, c, a = f"{line} ".split(" ", 2)
        a = a.strip()
        if kind in VALUE_KINDS:
            name, passes = VALUE_KINDS[kind]
            mostly = 0.95 if kind == "mostly_in_set" else 1.0
            rows.append(value_check(table, name, c, passes.format(c=c, a=a), mostly))
        elif kind in EXTREME_KINDS:
            name, holds = EXTREME_KINDS[kind]
            rows.append(check(table, name, c, holds.format(c=c, a=a), seen=f"{kind}({c})"))
        elif kind == "exists":
            rows.append(check(table, "expect_column_to_exist", c, "true"))
        elif kind == "not_null":
            bad = f"count(*) filter (where {c} is null)"
            name = "expect_column_values_to_not_be_null"
            rows.append(check(table, name, c, f"{bad} = 0", bad))
        else:
            many = f"select count(*) as n from {table} where {c} is not null group by {c}"
            bad = f"(select coalesce(sum(n), 0) from ({many} having count(*) > 1))"
            rows.append(check(table, "expect_column_values_to_be_unique", c, f"{bad} = 0", bad))
    return " union all ".join(rows)


def profile(table: str, columns: list[str], numeric: set[str]) -> str:
    rows = []
    for c in columns:
        number = f"cast({c} as double)" if c in numeric else "cast(null as double)"
        rows.append(f"""
    select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count,
      count(distinct {c}) as distinct_count, cast(min({c}) as varchar) as min,
      cast(max({c}) as varchar) as max, round(avg({number}), 3) as mean,
      round(stddev_samp({number}), 3) as stddev
    from {table}""")
    return " union all ".join(rows)


LABELS = """(values (0, 'Q1', 'Opening Balance'), (1, 'Q1', 'January'), (2, 'Q1', 'February'),
      (3, 'Q1', 'March'), (4, 'Q2', 'April'), (5, 'Q2', 'May'), (6, 'Q2', 'June'),
      (7, 'Q3', 'July'), (8, 'Q3', 'August'), (9, 'Q3', 'September'), (10, 'Q4', 'October'),
      (11, 'Q4', 'November'), (12, 'Q4', 'December')) as labels(number, quarter, label)"""
NUMERIC = {"fiscal_year", "accounting_period", "amount"}
PROFILED = ["ledger_sk", *SILVER_NAMES.values(), "source_path"]
RAW_ROW_ID = "concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar))"

ORACLE_SQL: dict[str, str] = {
    # A quoted empty text is read as NULL.
    "csv_roundtrip": sql(
        """
    select * replace (nullif(FUND_CODE, '') as FUND_CODE,
      nullif(ACCOUNTING_PERIOD, '') as ACCOUNTING_PERIOD) from raw""",
        "raw",
    ),
    "csv_union_by_name": """
    select event_id, event_type, cast(user_id as varchar) as user_id,
           cast(null as varchar) as "value", 'clicks.csv' as source_path
    from (select cast(event_id as varchar) as event_id, event_type, user_id from events
          where event_type = 'click')
    union all
    select cast(event_id as varchar), event_type, null,
           cast(cast("value" as decimal(18,2)) as varchar), 'others.csv'
    from events where event_type <> 'click'""",
    "source_lineage": """
    select 'lineitem.parquet' as source_file, count(*) as lines from lineitem""",
    "parquet_roundtrip": sql(
        "select ledger_sk, fiscal_year, accounting_period, amount, row_id from silver", "silver"
    ),
    "stage_ledger": sql("select * from silver", "silver"),
    "file_quarters": sql(
        "select source_path, file_fiscal_quarter, count(*) as lines from file_quarters group by 1, 2",
        "file_quarters",
    ),
    "clean_trim_nullif": sql(
        """
    select o_orderkey, trim(code) as trimmed, nullif(trim(code), '') as blank_as_null,
           nullif(code, '') as empty_as_null,
           nullif(trim(chr(160) || code || chr(160)), '') as unicode_trimmed
    from untidy""",
        "untidy",
    ),
    "coalesce_fallback": sql(
        """
    select o_orderkey, coalesce(trim(code), trim(unit)) as first_present,
           nullif(coalesce(trim(code), trim(unit)), '') as first_present_or_null,
           coalesce(nullif(trim(code), ''), nullif(trim(unit), '')) as first_nonblank
    from untidy""",
        "untidy",
    ),
    "safe_int_cast": """
    select l_orderkey, l_linenumber, number,
           try_cast(try_cast(number as double) as integer) as number_int
    from (select l_orderkey, l_linenumber,
      case when l_returnflag = 'A' and l_linestatus = 'O' then concat(l_partkey, '.5')
           when l_returnflag = 'A' then concat(' ', l_linenumber, '.0 ')
           when l_returnflag = 'N' and l_linestatus = 'O' then concat(l_suppkey, 'e1')
           when l_returnflag = 'N' then concat('-', l_orderkey, '.5')
           when l_linestatus = 'O' then concat(l_orderkey, '99999999999')
           else concat(l_orderkey, 'x') end as number
      from lineitem)""",
    "decimal_cast": """
    select o_orderkey, cast(concat(cents, '5') as decimal(18,2)) as rounded,
           cast(concat(' -', cents, '5') as decimal(18,2)) as rounded_negative,
           cast(concat('1', lpad(cents, 12, '0')) as decimal(18,2)) as from_currency
    from (select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) as varchar) as cents
          from orders)""",
    "quality_filter": """
    select o_orderkey, o_orderstatus as status, o_orderpriority as priority from orders
    where o_orderstatus <> 'F' and o_orderpriority <> '1-URGENT'""",
    "surrogate_key": sql(
        """
    select row_id, ledger_sk, md5(coalesce(program_code, '') || '-' || fund_code)
             as empty_null_key,
           md5(coalesce(program_code, '_dbt_utils_surrogate_key_null_') || '-' || fund_code)
             as marked_null_key,
           md5(concat(length(coalesce(program_code, '')), ':', coalesce(program_code, ''), '-',
               length(fund_code), ':', fund_code)) as safe_key
    from silver""",
        "silver",
    ),
    "period_labels": f"""
    select period, coalesce(quarter, 'Unknown') as fiscal_quarter,
      coalesce(label, 'Unknown') as fiscal_month_name, lines
    from (select cast(l_quantity as integer) - 2 as period, count(*) as lines
          from lineitem group by 1)
    left join {LABELS} on number = period""",
    "dim_agencies": sql("select * from agencies", "agencies"),
    "dim_funds": sql("select * from funds", "funds"),
    "dim_departments": sql("select * from departments", "departments"),
    "dim_accounts": sql("select * from accounts", "accounts"),
    "dim_programs": sql(
        """
    select distinct md5(program_code) as program_sk, program_code as program_business_key
    from silver where program_code is not null""",
        "silver",
    ),
    "dim_time": sql(
        f"""
    select md5(concat(fiscal_year, '-', accounting_period)) as time_sk,
      fiscal_year as time_business_key, accounting_period,
      coalesce(quarter, 'Unknown') as fiscal_quarter, coalesce(label, 'Unknown') as fiscal_month_name
    from (select distinct fiscal_year, accounting_period from silver)
    left join {LABELS} on number = accounting_period""",
        "silver",
    ),
    "fct_transactions": sql("select * from fact", "fact"),
    "transactions_decorated": sql("select * from decorated", "decorated"),
    "fct_fanout": sql(
        """
    select f.department_sk, d.department_name, fiscal_year, count(*) as lines,
           cast(sum(amount) as decimal(38,2)) as amount
    from (select department_sk, fiscal_year, amount from shared
          left join shared_departments on dept_id = department_business_key) f
    left join shared_departments d on f.department_sk = d.department_sk
    group by 1, 2, 3""",
        "shared_departments",
    ),
    "weighted_fanout": sql(
        """
    select d.department_sk, fiscal_year, cast(sum(amount) as decimal(38,2)) as total_amount
    from shared left join shared_departments d on md5(dept_id) = d.department_sk
    group by 1, 2""",
        "shared_departments",
    ),
    "dim_one_name": sql(
        """
    select department_sk, department_business_key, min(department_name) as department_name
    from shared_departments group by 1, 2""",
        "shared_departments",
    ),
    "dedupe_on_key": """
    select * from lineitem
    qualify row_number() over (partition by l_orderkey order by l_shipdate, l_linenumber,
      l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
      l_linestatus) = 1""",
    "relationships_violations": sql(
        """
    select md5('other ' || fund_sk) as orphan_key, count(*) as rows from fact
    where fund_sk = md5('BUI') group by 1""",
        "fact",
    ),
    "relationships_violation_rows": sql(
        """
    select 'other ' || agency_sk as agency_sk, department_sk, fiscal_year, accounting_period, amount
    from fact where agency_sk in (select agency_sk from agencies where agency_business_key <= '004')""",
        "fact",
    ),
    "kpi_monthly_summary": sql("select * from kpi", "kpi"),
    "mart_base": sql(
        """
    select fiscal_year, accounting_period, agency_sk, fund_sk, department_sk, account_sk, ledger,
      cast(sign(amount) as integer) as sign, cast(sum(amount) as decimal(38,2)) as amount, count(*) as "rows"
    from fact group by all""",
        "fact",
    ),
    "marts_from_base": sql(
        " union all ".join(
            f"""select '{mart}' as mart, count(*) as "rows", cast(sum({net}) as decimal(38,2)) as net from {table}"""
            for mart, net, table in [
                ("kpi_monthly_summary", "net_amount", "kpi"),
                ("mart_fund_year_period", "net_amount", "fund_mart"),
                ("mart_agency_fund_year", "net_amount", "agency_mart"),
                ("int_department_spend_monthly", "total_monthly_amount", "monthly"),
                ("mart_budget_variance_by_fund", "budget_variance", f"({variance('fact')})"),
            ]
        ),
        "kpi",
        "fund_mart",
        "agency_mart",
        "monthly",
    ),
    "mart_fund_year_period": sql("select * from fund_mart", "fund_mart"),
    "mart_agency_fund_year": sql("select * from agency_mart", "agency_mart"),
    "department_spend_monthly": sql("select * from monthly", "monthly"),
    "variance_vs_prior_month": sql(
        """
    select department_sk, fiscal_year, month,
      cast(total_monthly_amount - lag(total_monthly_amount, 1, 0) over (
        partition by department_sk order by fiscal_year, month) as decimal(38,2))
        as variance_vs_prior_month
    from monthly""",
        "monthly",
    ),
    "budget_variance": sql(variance("fact"), "fact"),
    "budget_variance_uneven": sql(variance("uneven"), "uneven"),
    "budget_variance_conformed": sql(variance("uneven", True, True), "uneven"),
    "completeness_scaffold": sql("select * from scaffold", "scaffold"),
    "missing_periods": sql(
        """
    select * from scaffold
    except select distinct fiscal_year, fund_sk, agency_sk, accounting_period from fact""",
        "scaffold",
    ),
    "revenue_by_department": sql(
        """
    select fiscal_year, department_name, cast(sum(total_revenue) as decimal(38,2))
      as total_revenue from kpi group by 1, 2""",
        "kpi",
    ),
    "filtered_rollup": sql(
        """
    select fiscal_year, department_name, cast(sum(amount) as decimal(38,2)) as total_amount
    from fact t left join departments d on t.department_sk = d.department_sk
    join funds f on t.fund_sk = f.fund_sk
    where fiscal_year = 1998 and fund_business_key = 'AUT' group by 1, 2""",
        "fact",
    ),
    "department_rollup": sql(
        """
    select fiscal_year, department_name, cast(sum(amount) as decimal(38,2)) as total_amount
    from fact t join departments d on t.department_sk = d.department_sk
    where department_name = 'Supplier#000000001' group by 1, 2""",
        "fact",
    ),
    "total_transactions": sql("select count(*) as total_transactions from fact", "fact"),
    "total_amount": sql(
        "select cast(sum(amount) as decimal(38,2)) as total_amount from fact", "fact"
    ),
    "top_categories": """
    select event_type, cast(sum(cast("value" as decimal(18,2))) as decimal(38,2)) as total
    from events group by 1 order by total desc nulls last, event_type limit 10""",
    "top_accounts": sql(
        """
    select account_name, cast(sum(amount) as decimal(38,2)) as total
    from fact group by 1 order by total desc nulls last, account_name limit 10""",
        "fact",
    ),
    "monthly_trend": """
    select cast(date_trunc('month', o_orderdate) as timestamp) as month,
           cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(38,2)) as total
    from orders group by 1""",
    "expectations_silver": sql(suite("silver", SILVER_CHECKS), "silver"),
    "expectations_gold": sql(suite("kpi", GOLD_CHECKS), "kpi"),
    "expectations_silver_columns": sql(
        suite("file_quarters", SILVER_COLUMN_CHECKS), "file_quarters"
    ),
    "expectations_kpi": sql(suite("kpi", KPI_CHECKS), "kpi"),
    "expectations_marts": sql(
        " union all ".join(
            [
                suite("fact", FACT_CHECKS),
                suite("fund_mart", FUND_MART_CHECKS),
                suite("agency_mart", AGENCY_MART_CHECKS),
            ]
        ),
        "fund_mart",
        "agency_mart",
    ),
    "expectation_failures": sql(
        f"select * from ({suite('silver', SILVER_CHECKS)}) where not success", "silver"
    ),
    "suite_statistics": sql(
        f"""
    select count(*) as evaluated_expectations,
      count(*) filter (where success) as successful_expectations,
      count(*) filter (where not success) as unsuccessful_expectations,
      count(*) filter (where success) * 100.0 / cast(count(*) as double) as success_percent
    from ({suite("kpi", GOLD_CHECKS)})""",
        "kpi",
    ),
    "in_set_mostly": sql(
        " union all ".join(
            [
                value_check(
                    "silver",
                    "expect_column_values_to_be_in_set",
                    "accounting_period",
                    "accounting_period between 1 and 12",
                    0.95,
                ),
                value_check(
                    "silver",
                    "expect_column_values_to_be_in_set",
                    "program_code",
                    "program_code in ('STANDARD', 'PROMO')",
                    0.95,
                ),
                value_check(
                    "silver",
                    "expect_column_values_to_be_in_set",
                    "ledger",
                    "ledger in ('ACTUALS', 'BUDGET')",
                    0.5,
                ),
                value_check(
                    "silver",
                    "expect_column_values_to_be_between",
                    "fiscal_year",
                    "fiscal_year >= 1996",
                    0.5,
                ),
                value_check(
                    "silver",
                    "expect_column_to_equal_expression",
                    "fund_code",
                    "fund_code = substr(fund_descr, 1, 3)",
                ),
            ]
        ),
        "silver",
    ),
    "unique_violations": f"""
    select {RAW_ROW_ID} as "value", count(*) as records from lineitem
    group by 1 having count(*) > 1""",
    "accepted_values_violations": sql(
        f"""
    select fiscal_year as "value", count(*) as records from silver
    where fiscal_year not in ({YEARS}) group by 1""",
        "silver",
    ),
    "net_balance_violations": sql(
        """
    select 'net_balance' as rule, fiscal_year, month, department_name from kpi
    where not (round(total_revenue + total_expenses, 2) = round(net_amount, 2))
    union all
    select 'no_expenses', fiscal_year, month, department_name from kpi
    where net_amount <> total_revenue""",
        "kpi",
    ),
    "allowed_pairs": sql(
        """
    select ledger_sk, fund_code, account from silver
    where (fund_code = 'AUT' and account not in ('1', '2', '3'))
       or (fund_code = 'BUI' and account not in ('4', '5'))""",
        "silver",
    ),
    "reconcile_targets": f"""
    select 'total_expenses' as metric_name, year(l_shipdate)::int as fiscal_year,
      cast(sum({LINE_AMOUNT}) as decimal(38,2)) as calculated_value,
      cast(sum({LINE_AMOUNT}) + 0.02 as decimal(18,2)) as expected_value_usd
    from lineitem
    where {LINE_AMOUNT} < 0 and year(l_shipdate) > 1997 and l_orderkey % 101 not between 1 and 8
    group by 2""",
    "csv_dirty_files": """
    select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus,
      case when o_orderkey % 5 = 4
           then concat(o_orderpriority, chr(10), '"', o_orderstatus, '", x', chr(10))
           else o_orderpriority end as o_orderpriority,
      'orders_' || o_orderkey % 5 || '.csv' as source_path from orders""",
    "csv_rejects": """
    select 'orders_3.csv' as source_path, line, reason
    from orders, (values ('x', '1 of 3 fields'), ('a,b,c,d', '4 of 3 fields')) as bad(line, reason)
    where o_orderkey % 5 = 3""",
    "csv_load_summary": """
    select 'orders_' || o_orderkey % 5 || '.csv' as source_path, count(*) as "rows",
      case when o_orderkey % 5 = 3 then 2 * count(*) else 0 end as rejected
    from orders group by o_orderkey % 5""",
    "csv_dialects": """
    select
      case when o_orderkey % 6 <> 2 then cast(o_orderkey as varchar) end as "key",
      case o_orderkey % 6 when 1 then o_orderstatus || ';' when 3 then concat(o_orderstatus, chr(10), ',')
        when 5 then concat(o_orderstatus, '" ', o_orderstatus) when 0 then o_orderstatus end as status,
      case when o_orderkey % 6 in (0, 1, 3, 5) then o_orderpriority end as priority,
      case when o_orderkey % 6 = 2 then cast(o_orderkey as varchar) end as column0,
      case when o_orderkey % 6 = 2 then o_orderstatus end as column1,
      case when o_orderkey % 6 in (2, 4) then o_orderpriority end as column2,
      cast(null as varchar) as column3,
      case when o_orderkey % 6 = 4 then o_orderstatus end as key_1,
      'style_' || o_orderkey % 6 || '.csv' as source_path
    from orders""",
    "merge_raw": """
    select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus,
      case when o_orderkey % 5 = 4
           then concat(o_orderpriority, chr(10), '"', o_orderstatus, '", x', chr(10))
           else o_orderpriority end as o_orderpriority
    from orders""",
    "file_manifest": """
    select (doc_id % 64)::integer as folder, strlen(string_agg(text || chr(10), '' order by text)) as length,
      sha256(string_agg(text || chr(10), '' order by text)) as sha256
    from documents where text <> '' group by 1""",
    "release_silver": sql("select * from silver", "silver"),
    "release_fact": sql("select * from fact", "fact"),
    "release_kpi": sql("select * from kpi", "kpi"),
    "changed_files": """
    select cast(doc_id as varchar) as path, length(text) as length, sha256(text) as sha256
    from documents where doc_id % 7 = 3""",
    "ingest_summary": """
    select case when doc_id % 7 = 3 then 'changed' when doc_id % 7 = 5 then 'removed'
      else 'unchanged' end as status, count(*) as files
    from documents group by 1""",
    "model_tests": sql(
        """
    select 'allowed_account_for_fund' as test, 'error' as severity, 0::bigint as violations
    union all select 'allowed_account_name_for_fund', 'error', 0
    union all select 'columns_fct_transactions', 'error', 0
    union all select 'columns_mart_agency_fund_year', 'error', 0
    union all select 'columns_mart_fund_year_period', 'error', 0
    union all select 'columns_stg_ledger', 'warn', 1
    union all select 'period_completeness', 'warn', count(*) from (select * from scaffold
      except select distinct fiscal_year, fund_sk, agency_sk, accounting_period from fact)
    union all select 'relationships_account_sk', 'error', 0
    union all select 'relationships_agency_sk', 'error', 0
    union all select 'relationships_department_sk', 'error', 0
    union all select 'relationships_fund_sk', 'error', 0""",
        "scaffold",
    ),
    "fct_one_name": sql(
        """
    select department_sk, min(department_name) as department_name, fiscal_year,
      cast(sum(amount) as decimal(38,2)) as amount
    from (select distinct dept_id, fiscal_year, department_sk, department_name, sums.amount
      from (select dept_id, fiscal_year, sum(amount) as amount from shared group by 1, 2) sums
      join (select department_sk, department_business_key, min(department_name) as department_name
            from shared_departments group by 1, 2) on dept_id = department_business_key)
    group by 1, 3""",
        "shared_departments",
    ),
    "suite_json": sql(suite("kpi", GOLD_CHECKS), "kpi"),
    "export_reread": sql("select * from agencies", "agencies"),
    "rollup_by_ordinal": sql(
        """
    select fiscal_year, ledger, cast(sum(amount) as decimal(38,2)) as total from fact
    group by fiscal_year, ledger""",
        "fact",
    ),
    "schema_contract": sql(
        """
    select *, nullif(concat_ws('; ',
        case when amount is null then 'amount not null' end,
        case when fiscal_year is null then 'fiscal_year not null' end,
        case when fiscal_year < 2000 then 'fiscal_year >= 2000' end,
        case when fiscal_year > 2050 then 'fiscal_year <= 2050' end,
        case when quarter is null then 'quarter not null' end,
        case when quarter < 1 then 'quarter >= 1' end,
        case when quarter > 4 then 'quarter <= 4' end), '') as broken_rules
    from contract""",
        "contract",
    ),
    "contract_failure_cases": sql(
        """
    select ledger_sk as row_id, 'amount' as column_name, 'type double' as rule, concat('$', amount) as value
    from silver where accounting_period = 4 and ledger = 'ENCUMBRANCE'
    union all
    select ledger_sk, 'fiscal_year', 'type int', 'FY' || fiscal_year from silver where accounting_period = 2
    union all
    select ledger_sk, 'fiscal_year', 'not null', null from silver where accounting_period = 3
    union all
    select ledger_sk, 'fiscal_year', '>= 2000', cast(fiscal_year as varchar)
    from silver where accounting_period not in (2, 3) and fiscal_year < 2000
    union all
    select ledger_sk, 'quarter', '>= 1', '0' from silver where accounting_period = 0
    union all
    select ledger_sk, 'quarter', '<= 4', '5' from silver where accounting_period = 13""",
        "silver",
    ),
    "contract_accepted": sql(
        """
    select cast(amount as double) as amount, fiscal_year, cast(ceil(accounting_period / 3) as integer) as quarter,
      dept_descr as department_name, product_descr as vendor_name, acct_descr as transaction_description, fund_code
    from silver
    where accounting_period not in (0, 2, 3, 13) and not (accounting_period = 4 and ledger = 'ENCUMBRANCE')""",
        "silver",
    ),
    "suite_from_json": sql(suite("silver", "\n".join(SILVER_CHECKS.splitlines()[:9])), "silver"),
    "schema_contract_violations": sql(
        " union all ".join(
            [
                *[
                    value_check(
                        "contract", "expect_column_values_to_not_be_null", c, f"{c} is not null"
                    )
                    for c in ("amount", "fiscal_year", "quarter")
                ],
                value_check(
                    "contract",
                    "expect_column_values_to_be_between",
                    "fiscal_year",
                    "fiscal_year between 2000 and 2050",
                ),
                value_check(
                    "contract",
                    "expect_column_values_to_be_between",
                    "quarter",
                    "quarter between 1 and 4",
                ),
            ]
        ),
        "contract",
    ),
    "table_profile": sql(profile("silver", PROFILED, NUMERIC), "silver"),
    "table_profile_approx": sql(
        f"select *, true as close from ({profile('silver', PROFILED, NUMERIC)})", "silver"
    ),
    "profile_merged": sql(
        " union all ".join(
            f"""
    select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count,
      cast(min({c}) as varchar) as min, cast(max({c}) as varchar) as max,
      {f"count(*) filter ({c} = 0)" if c in NUMERIC else "null::bigint"} as zeros,
      {"null::bigint" if c in NUMERIC else f"min(length({c}))"} as shortest,
      {"null::bigint" if c in NUMERIC else f"max(length({c}))"} as longest,
      {f"round(avg(cast({c} as double)), 2)" if c in NUMERIC else "null::double"} as mean,
      {f"round(stddev_samp(cast({c} as double)), 1)" if c in NUMERIC else "null::double"} as stddev,
      {"null::double" if c in NUMERIC else f"round(avg(length({c})), 2)"} as mean_length,
      true as quantiles_close
    from silver"""
            for c in PROFILED
            if c != "fiscal_year"
        ),
        "silver",
    ),
    "table_shape": sql(
        "select count(*) as row_count, cast(38 as bigint) as column_count from silver", "silver"
    ),
}
ORACLE_SQL["missing_from_scaffold"] = ORACLE_SQL["missing_periods"]
