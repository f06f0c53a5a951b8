"""Role views as SQL text for the DuckDB oracle (same shapes as ``sources.roles``).

Every oracle query is one SELECT: the views it needs are prepended as CTEs.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "v_deposit": """
select p.*, cast(year(process_dt) * 1000 + dayofyear(process_dt) as integer) as day_key,
       case when maturity_date is null then 7
            when maturity_date - open_date < 31 then 8
            else case
                when mm between 1 and 5 then 9 when mm = 6 then 10 when mm = 7 then 11
                when mm between 8 and 11 then 12 when mm = 12 then 13 when mm = 13 then 14
                when mm between 14 and 23 then 15 else 16 end
       end as funding_id
from (select q.*, extract(year from age(cast(maturity_date as timestamp), cast(open_date as timestamp))) * 12
                 + extract(month from age(cast(maturity_date as timestamp), cast(open_date as timestamp))) as mm
      from (select date '2023-12-01' + cast(o_orderkey % 20 as int) as process_dt,
             o_orderkey as account_id,
             case when c_mktsegment = 'BUILDING' then 'Business' else 'Individual' end as account_type,
             cast((o_orderkey % 900) / 100.0 as decimal(18,6)) as interest_rate,
             cast((o_orderkey % 700) / 100.0 as decimal(18,6)) as vof_rate,
             cast(floor(o_totalprice) as bigint) as balance,
             cast(o_orderdate as date) as open_date,
             case when o_orderstatus = 'P' then null
                  else cast(o_orderdate as date) + cast((o_orderkey * 37) % 1000 as int) end as maturity_date
            from orders join customer on o_custkey = c_custkey) q) p""",
    "v_loan": """
select p.*, cast(year(process_dt) * 1000 + dayofyear(process_dt) as integer) as day_key,
       case when account_type = 'CV CCSTK' then 20 when account_type = 'CV VND LS USD' then 21
            when mm < 12 then 22 when mm <= 60 then 23 when mm <= 120 then 24
            when mm <= 180 then 25 else 26 end as funding_id
from (select q.*, extract(year from age(cast(maturity_date as timestamp), cast(open_date as timestamp))) * 12
                 + extract(month from age(cast(maturity_date as timestamp), cast(open_date as timestamp))) as mm
      from (select date '2023-12-01' + cast(l_orderkey % 20 as int) as process_dt,
             l_orderkey * 10 + l_linenumber as account_id,
             case l_partkey % 20 when 0 then 'CV CCSTK' when 1 then 'CV VND LS USD' else 'CV OTHER' end as account_type,
             case when l_returnflag = 'R' then 'Business' else 'Individual' end as customer_type,
             cast((l_orderkey % 1500) / 100.0 as decimal(18,6)) as interest_rate,
             cast((l_orderkey % 1100) / 100.0 as decimal(18,6)) as cof_rate,
             cast(floor(l_extendedprice) as bigint) as balance,
             cast(l_shipdate as date) as open_date,
             cast(l_shipdate as date) + cast((l_partkey * 97) % 6500 as int) as maturity_date
            from lineitem) q) p""",
    "v_area": """
select * from (values ('B','AREA_B'),('C','AREA_C'),('D','AREA_D'),('E','AREA_E'),
                      ('F','AREA_F'),('G','AREA_G'),('H','AREA_H')) as t(area_code, area_name)""",
    "v_city": """
select 'CITY_' || cast(n_nationkey as varchar) as tinh,
       substr('BCDEFGH', cast(1 + n_nationkey % 7 as int), 1) as area_code
from nation""",
    "v_loan_kpi": """
select cast(202301 + o_orderkey % 3 as int) as kpi_month,
       'CITY_' || cast(c_nationkey as varchar) as pos_city,
       cast(floor(o_totalprice) as decimal(18,2)) as outstanding_principal,
       case when o_orderkey % 11 = 0 then cast(202301 + o_custkey % 3 as int) end as write_off_month,
       case when o_orderkey % 11 = 0 then cast(floor(o_totalprice / 10) as decimal(18,2))
            else cast(0 as decimal(18,2)) end as write_off_balance_principal,
       case when o_orderkey % 7 = 0 then null else cast(1 + o_custkey % 5 as int) end as max_bucket
from orders join customer on o_custkey = c_custkey""",
    "v_gl_code": """
select * from (values (0,'702000030002'),(1,'702000030001'),(2,'702000030012'),(3,'716000000001'),
  (4,'719000030002'),(5,'719000030003'),(6,'801000000001'),(7,'803000000001'),(8,'702000010001'),
  (9,'816000000001'),(10,'809000000002'),(11,'790000050101'),(12,'850000000001'),(13,'860000000001'),
  (14,'870000000001'),(15,'790000050001'),(16,'999000000001')) as t(i, account_code)""",
    "v_gl": """
select account_code,
       cast(cast(floor(l_extendedprice) as decimal(18,2)) * (case when i between 6 and 15 then -1 else 1 end)
            as decimal(18,2)) as amount,
       cast(l_shipdate as date) as transaction_date,
       '00000000' || substr('0BCDEFGH', cast(1 + (l_suppkey + l_linenumber) % 8 as int), 1) as analysis_code
from lineitem join v_gl_code on (l_orderkey * 7 + l_linenumber) % 17 = i""",
    "v_sales_kpi": """
select c_name as sale_name, 'p' || cast(c_custkey as varchar) || '@x' as email,
       'AREA_' || substr('BCDEFGH', cast(1 + c_nationkey % 7 as int), 1) as area_name,
       cast(1 + o_orderkey % 12 as int) as month,
       cast(floor(o_totalprice) as decimal(18,2)) as loan_to_new,
       cast(o_orderkey % 97 as decimal(18,2)) as psdn,
       cast((o_orderkey % 100) / 100.0 as decimal(18,4)) as app_rate
from orders join customer on o_custkey = c_custkey""",
    "v_tick": """
select event_type as series_id, ts, event_id, value as close from events""",
    "v_bar": """
select event_type as series_id, cast(ts as date) as date,
       min_by(value, ts) as open, max(value) as high, min(value) as low,
       max_by(value, ts) as close, count(*) as volume
from events group by event_type, cast(ts as date)""",
    "v_price_text": """
select o_orderkey as row_id,
       lpad(cast(day(o_orderdate) as varchar), 2, '0') || '/' || lpad(cast(month(o_orderdate) as varchar), 2, '0')
         || '/' || cast(year(o_orderdate) as varchar) as date_text,
       cast(cast(floor(o_totalprice / 1000) as bigint) as varchar) || ','
         || lpad(cast(cast(floor(o_totalprice) as bigint) % 1000 as varchar), 3, '0') || '.5' as close_text,
       cast(o_orderkey % 9 as varchar) || '.25%' as change_text,
       case o_orderkey % 6 when 0 then '1.5K' when 1 then '2M' when 2 then '3.25B'
            when 3 then cast(o_orderkey as varchar) when 4 then '-' else null end as volume_text
from orders""",
    "v_macro_long": """
select year(o_orderdate) as year, 'GDP' as series_name, cast(sum(cast(floor(o_totalprice) as bigint)) as double) as value
from orders group by year(o_orderdate)
union all
select year(o_orderdate), 'Inflation', cast(count(*) as double) from orders group by year(o_orderdate)
union all
select year(l_shipdate), 'Unemployment_rate', cast(count(*) as double) from lineitem group by year(l_shipdate)""",
}

_DEPS = {"v_gl": ["v_gl_code"]}


def with_views(names: list[str], body: str) -> str:
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in order)
    body = body.strip()
    if body.lower().startswith("with recursive "):
        return f"with recursive {ctes},\n{body[15:]}"
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


def round_quot(num: str, den: str, digits: int = 2) -> str:
    """DuckDB text: round(num/den, digits) half away from zero, exact, for integral num/den; DOUBLE."""
    p = 10 ** digits
    return (f"(cast(sign({num}) * sign({den}) * ((2 * abs(cast({num} as hugeint)) * {p} + abs(cast({den} as hugeint)))"
            f" // (2 * abs(nullif(cast({den} as hugeint), 0)))) as double) / {p})")
