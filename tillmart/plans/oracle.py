"""SQL counterparts of the query catalogue, for an independent engine (DuckDB).

Each text reads the given tables. Relations are spelled out as CTEs, together
with the ones they need.
"""

from __future__ import annotations

# name -> (relations it reads, body)
_RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {
    "customers": (
        (),
        """select cast(c_custkey as bigint) customer_id, c_name customer_name,
                  concat('c', cast(c_custkey as varchar), '@example.com') email,
                  n_name city, r_name country, date '2020-01-01' created_date
           from customer join nation on c_nationkey = n_nationkey
                         join region on n_regionkey = r_regionkey""",
    ),
    "products": (
        (),
        """select cast(p_partkey as bigint) product_id, p_name product_name, p_type category,
                  cast(p_retailprice as decimal(10,2)) unit_price,
                  cast(p_size as int) stock_quantity
           from part""",
    ),
    "sales": (
        (),
        """select cast(l_orderkey * 10 + l_linenumber as bigint) sale_id,
                  cast(o_custkey as bigint) customer_id, cast(l_partkey as bigint) product_id,
                  cast(floor(l_quantity) as int) quantity,
                  cast(p_retailprice as decimal(10,2)) unit_price,
                  cast(l_extendedprice as decimal(10,2)) total_amount,
                  cast(o_orderdate as date) sale_date
           from lineitem join orders on l_orderkey = o_orderkey
                         join part on l_partkey = p_partkey""",
    ),
    "dimc": (
        ("customers",),
        "select row_number() over (order by customer_id) customer_key, * from customers",
    ),
    "dimp": (
        ("products",),
        """select row_number() over (order by product_id) product_key, product_id, product_name,
                  category, unit_price from products""",
    ),
    "unmatched": (
        ("sales",),
        """select * replace (case when customer_id % 7 = 0 then -customer_id else customer_id end
                                 as customer_id,
                             case when product_id % 11 = 0 then -product_id else product_id end
                                 as product_id)
           from sales""",
    ),
    "flawed": (
        ("unmatched",),
        """select * replace (case when sale_id % 10 = 7 then sale_id - 1 else sale_id end as sale_id,
                             case when sale_id % 10 = 5 then null else quantity end as quantity,
                             case when sale_id % 10 = 4 then null else product_id end as product_id)
           from unmatched""",
    ),
    "matched": (
        ("unmatched", "dimc", "dimp"),
        """select sale_id, customer_key, product_key, sale_date, quantity, s.unit_price,
                  total_amount
           from unmatched s join dimc using (customer_id) join dimp using (product_id)""",
    ),
    "rejected": (
        ("unmatched", "dimc", "dimp"),
        """select sale_id, s.customer_id, s.product_id, sale_date, customer_key, product_key,
                  case when customer_key is null and product_key is null then 'both'
                       when customer_key is null then 'customer' else 'product' end reason
           from unmatched s left join dimc c on s.customer_id = c.customer_id
                            left join dimp p on s.product_id = p.product_id""",
    ),
    "fact": (
        ("sales", "dimc", "dimp"),
        """select sale_id, customer_key, product_key, sale_date, quantity, s.unit_price,
                  total_amount
           from sales s join dimc using (customer_id) join dimp using (product_id)""",
    ),
    "ranked": (
        ("fact", "dimp"),
        """select *, row_number() over (partition by sale_date order by revenue desc, product_id) rn
           from (select sale_date, product_id, product_name, sum(total_amount) revenue
                 from fact join dimp using (product_key)
                 group by sale_date, product_id, product_name)""",
    ),
    "summaries": (
        ("fact", "ranked"),
        """select a.sale_date summary_date, unique_customers, total_orders, total_items_sold,
                  total_revenue, avg_order_value, min_order_value, max_order_value,
                  product_id top_product_id, product_name top_product_name,
                  cast(revenue as decimal(38,2)) top_product_revenue
           from (select sale_date, {measures_by_key} from fact group by sale_date) a
           join ranked r on r.sale_date = a.sale_date and rn = 1""",
    ),
    "job_history": (
        (),
        """select event_id instance_id, concat('job_', cast(user_id as varchar)) job_name,
                  cast(event_id % 2 as int) step_id,
                  case event_type when 'error' then 0 when 'purchase' then 1 when 'signup' then 2
                                  when 'view' then 3 when 'click' then 4 end run_status,
                  cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as int) run_date,
                  cast(hour(ts) * 10000 + minute(ts) * 100 + floor(second(ts)) as int) run_time,
                  cast(floor(n / 3600) * 10000 + floor((n % 3600) / 60) * 100 + n % 60 as int)
                      run_duration,
                  props message
           from (select *, cast(floor(value * 37) as int) n from events) e""",
    ),
    "executions": (
        (),
        """select event_id execution_id, user_id operation_id,
                  concat('folder_', cast(user_id % 4 as varchar)) folder_name,
                  concat('project_', cast(user_id % 5 as varchar)) project_name,
                  concat('package_', cast(user_id % 3 as varchar)) package_name,
                  case event_type when 'error' then 4 when 'click' then 2 when 'view' then 9
                                  when 'signup' then 3 else 7 end status,
                  ts start_time,
                  case when event_type = 'click' then null
                       else ts + to_seconds(cast(floor(value) as int)) end end_time
           from events""",
    ),
    "messages": (
        (),
        """select user_id operation_id, ts message_time,
                  case event_type when 'error' then 120 when 'signup' then 110 when 'view' then 70
                                  when 'click' then 60 else 50 end message_type,
                  event_type message_source_name, props message, 'Package' package_path,
                  concat('Package/', event_type) execution_path,
                  concat('part_', cast(user_id % 7 as varchar)) subcomponent_name
           from events""",
    ),
    "job_activity": (
        (),
        """select concat('job_', cast(user_id as varchar)) job_name,
                  cast(floor(event_id / 1000) as int) session_id, ts run_requested_date,
                  case when event_type = 'signup' then null else ts end start_execution_date,
                  case when event_type in ('signup', 'click') then null
                       else ts + to_seconds(cast(floor(value) as int)) end stop_execution_date,
                  cast(event_id % 4 as int) last_executed_step_id
           from events""",
    ),
    "jobs": (
        (),
        """select distinct concat('job_', cast(user_id as varchar)) job_name,
                  cast(user_id % 7 as int) category_id from events""",
    ),
    "run_log": (
        (),
        """select event_id log_id, event_type dag_id,
                  concat('task_', cast(user_id % 4 as varchar)) task_id,
                  cast(ts as date) execution_date, ts start_time,
                  case when event_id % 5 = 1 then ts + to_seconds(30) end end_time,
                  case event_id % 5 when 1 then 'SUCCESS' when 2 then 'FAILED'
                                    else 'STARTED' end status,
                  cast(event_id % 1000 as bigint) rows_extracted,
                  case when event_id % 3 = 0 then null else cast(event_id % 900 as bigint) end
                      rows_loaded
           from events""",
    ),
}

_RUN_STATUS = """case run_status when 0 then 'Failed' when 1 then 'Succeeded' when 2 then 'Retry'
    when 3 then 'Canceled' when 4 then 'In Progress' end"""
_EXEC_STATUS = """case status when 1 then 'Created' when 2 then 'Running' when 3 then 'Canceled'
    when 4 then 'Failed' when 5 then 'Pending' when 6 then 'Ended Unexpectedly'
    when 7 then 'Succeeded' when 8 then 'Stopping' when 9 then 'Completed' end"""
# DuckDB averages decimals as doubles; cents are rounded half up in whole numbers instead.
_AVG = """cast(cast((cast(sum(total_amount) * 100 as hugeint) * 2 + count(*)) // (2 * count(*))
    as decimal(20,0)) * cast(0.01 as decimal(3,2)) as decimal(10,2)) avg_order_value"""


def _measures(customer: str) -> str:
    return f"""count(distinct {customer}) unique_customers, count(*) total_orders,
        cast(sum(quantity) as bigint) total_items_sold,
        cast(sum(total_amount) as decimal(38,2)) total_revenue, {_AVG},
        min(total_amount) min_order_value, max(total_amount) max_order_value"""


def _sql(reads: str, body: str) -> str:
    """``body`` behind the CTEs of the relations it reads and of theirs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        needs, _ = _RELATIONS[name]
        for need in needs:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in reads.split():
        visit(name)
    ctes = [
        f"{name} as ({_RELATIONS[name][1].replace('{measures_by_key}', _measures('customer_key'))})"
        for name in ordered
    ]
    if ctes and body.startswith("with "):
        return "with " + ",\n".join(ctes) + ",\n" + body.removeprefix("with ")
    return ("with " + ",\n".join(ctes) + "\n" if ctes else "") + body


_DAY = "date '1997-06-15'"
_NO_KEY = "customer_key is null or product_key is null"
_ANALYSIS = """sale_date, customer_name, city, country, product_name, category, quantity,
    f.unit_price, total_amount"""
_TOP = """select product_name, category, count(*) total_orders,
    cast(sum(quantity) as bigint) total_quantity_sold,
    cast(sum(total_amount) as decimal(38,2)) total_revenue, """ + _AVG + """
    from fact join dimp using (product_key) group by product_name, category"""
_LATEST = "row_number() over (partition by {by} order by {order} desc) rn"


_LOADED = """case when {day} between date '1997-06-01' and date '1997-06-30'
    then '2024-05-02 00:00:00' else '2024-05-01 00:00:00' end"""


def _violations(name: str, table: str, pk: str, required: list[str]) -> str:
    parts = [
        f"""select '{name}_pk_{pk}' constraint_name, count(*) violations
            from (select {pk} from {table} group by {pk} having count(*) > 1)"""
    ]
    parts += [
        f"""select '{name}_not_null_{c}', count(*) from {table} where {c} is null"""
        for c in required
    ]
    return " union all ".join(parts)


_VALUE = f"""select customer_name, city, country, count(distinct sale_date) purchase_days,
                   count(*) total_orders, cast(sum(quantity) as bigint) total_items_purchased,
                   cast(sum(total_amount) as decimal(38,2)) lifetime_value, {_AVG},
                   max(sale_date) last_purchase_date
            from {{fact}} join dimc using (customer_key) group by customer_name, city, country"""

_MATCHED_SUMMARY = f"""with ranked as (
              select *, row_number() over (partition by sale_date
                                           order by revenue desc, product_id) rn
              from (select sale_date, product_id, product_name, sum(total_amount) revenue
                    from matched join dimp using (product_key)
                    group by sale_date, product_id, product_name))
            select a.*, product_id top_product_id, product_name top_product_name,
                   cast(revenue as decimal(38,2)) top_product_revenue
            from (select sale_date summary_date, {_measures('customer_key')}
                  from matched group by sale_date) a
            join ranked r on r.sale_date = a.summary_date and rn = 1"""

ORACLE: dict[str, str] = {
    "src_customers": _sql("customers", "select * from customers"),
    "src_products": _sql(
        "products", "select product_id, product_name, category, unit_price from products"
    ),
    "src_sales_scan": _sql("sales", "select * from sales"),
    "sales_by_date_range": _sql(
        "sales customers products",
        """select sale_id, sale_date, customer_name, city, product_name, category, quantity,
                  s.unit_price, total_amount
           from sales s join customers using (customer_id) join products using (product_id)
           where sale_date between date '1997-06-01' and date '1997-06-30'
           order by sale_date desc, sale_id""",
    ),
    "row_counts": _sql(
        "customers products sales",
        """select 'customers' table_name, count(*) row_count from customers
           union all select 'products', count(*) from products
           union all select 'sales', count(*) from sales""",
    ),
    "dim_customers": _sql("dimc", "select * from dimc"),
    "dim_products": _sql("dimp", "select * from dimp"),
    "dim_key_map": _sql("dimp", "select product_id, product_key from dimp"),
    "dim_surrogate_keys": _sql(
        "customers",
        """with even as (
               select customer_id, row_number() over (order by customer_id) customer_key
               from customers where customer_id % 2 = 0),
           kept as (select * from even where customer_key < (select max(customer_key) from even))
           select * from kept
           union all
           select customer_id, row_number() over (order by customer_id)
                  + (select max(customer_key) from even)
           from customers where customer_id not in (select customer_id from kept)""",
    ),
    "fact_load": _sql("matched", "select * from matched"),
    "fact_rejects": _sql(
        "rejected", f"select sale_id, customer_id, product_id, reason from rejected where {_NO_KEY}"
    ),
    "fact_replace_by_date": _sql(
        "sales",
        """select sale_id, sale_date, quantity + 1 quantity, total_amount from sales
           where sale_date not in (select sale_date from sales
                 where sale_date between date '1997-06-10' and date '1997-06-20')
           union all
           select sale_id, sale_date, quantity, total_amount from sales
           where sale_date between date '1997-06-10' and date '1997-06-20'""",
    ),
    "vw_daily_sales_summary": _sql(
        "sales", f"select sale_date, {_measures('customer_id')} from sales group by sale_date"
    ),
    "daily_product_revenue": _sql(
        "ranked",
        f"""select product_id, product_name, cast(revenue as decimal(38,2)) revenue
            from ranked where sale_date = {_DAY}""",
    ),
    "top_product_one_day": _sql(
        "ranked",
        f"""select product_id, product_name, cast(revenue as decimal(38,2)) revenue
            from ranked where sale_date = {_DAY} and rn = 1""",
    ),
    "top_product_per_day": _sql(
        "ranked",
        """select sale_date summary_date, product_id top_product_id,
                  product_name top_product_name,
                  cast(revenue as decimal(38,2)) top_product_revenue
           from ranked where rn = 1""",
    ),
    "daily_summary_one_day": _sql(
        "summaries", f"select * from summaries where summary_date = {_DAY}"
    ),
    "daily_summary": _sql("summaries", "select * from summaries"),
    "summary_upsert": _sql(
        "summaries",
        """select summary_date, total_orders,
                  case when summary_date < date '1997-01-01' then cast(0 as decimal(38,2))
                       else total_revenue end total_revenue, top_product_id
           from summaries""",
    ),
    "summary_stats": _sql(
        "summaries",
        f"""select summary_date "date", total_orders, cast(total_revenue as double) total_revenue,
                   unique_customers, top_product_name top_product,
                   cast(top_product_revenue as double) top_revenue
            from summaries where summary_date = {_DAY}""",
    ),
    "vw_sales_analysis": _sql(
        "fact dimc dimp",
        f"""select {_ANALYSIS} from fact f join dimc using (customer_key)
                                           join dimp using (product_key)""",
    ),
    "vw_top_products": _sql("fact dimp", _TOP),
    "top_products_10": _sql(
        "fact dimp", _TOP + " order by total_revenue desc, product_name, category limit 10"
    ),
    "vw_customer_ltv": _sql("fact dimc", _VALUE.format(fact="fact")),
    "derived_audit_columns": _sql(
        "sales", "select sale_id, 'Airflow_Production' loaded_by, cast(1 as int) batch_id from sales"
    ),
    "stage_sales": _sql(
        "sales",
        """select cast(null as bigint) sale_id, customer_id, product_id, quantity, unit_price,
                  total_amount, sale_date, cast(1 as int) batch_id, 'Airflow_Production' loaded_by
           from sales""",
    ),
    "stage_customers": _sql(
        "customers",
        """select row_number() over (order by customer_id) stage_id, *, 'New' load_status
           from customers""",
    ),
    "stage_products": _sql(
        "products",
        """select row_number() over (order by product_id) stage_id, *, 'New' load_status
           from products""",
    ),
    "stage_row_count": _sql(
        "sales",
        f"""select {_DAY} sale_date, count(*) row_count,
                   case when count(*) > 0 then 'ok' else 'warn' end severity
            from sales where sale_date = {_DAY}""",
    ),
    "load_verification": _sql(
        "sales",
        f"""select count(*) rows_loaded, max(sale_id) last_sale_id from sales
            where sale_date = {_DAY}""",
    ),
    "dq_report": _sql(
        "rejected matched",
        f"""select check_name, expected, actual, expected = actual passed from (
              select 'fact_count' check_name,
                     (select count(*) from rejected where sale_date = {_DAY}) expected,
                     (select count(*) from matched where sale_date = {_DAY}) actual
              union all
              select 'null_keys', 0,
                     (select count(*) from rejected where sale_date = {_DAY} and ({_NO_KEY}))
              union all
              select 'summary_exists', 1,
                     (select count(distinct sale_date) from matched where sale_date = {_DAY}))""",
    ),
    "dq_null_keys": _sql(
        "rejected",
        f"""select sale_date, count(*) filter (where {_NO_KEY}) null_count
            from rejected group by sale_date""",
    ),
    "dq_missing_summaries": _sql(
        "fact summaries",
        """select distinct sale_date from fact where sale_date not in
           (select summary_date from summaries where summary_date < date '1998-01-01')""",
    ),
    "dq_constraints": _sql(
        "flawed customers products",
        _violations(
            "sales",
            "flawed",
            "sale_id",
            ["customer_id", "product_id", "quantity", "unit_price", "total_amount", "sale_date"],
        )
        + """ union all select 'sales_fk_customer_id', count(*) from flawed
                where customer_id not in (select customer_id from customers)
              union all select 'sales_fk_product_id', count(*) from flawed
                where product_id not in (select product_id from products)
              union all """
        + _violations("customers", "customers", "customer_id", ["customer_name"])
        + " union all "
        + _violations("products", "products", "product_id", ["product_name", "unit_price"]),
    ),
    "mart_facts": _sql(
        "matched", f"select *, {_LOADED.format(day='sale_date')} loaded_at from matched"
    ),
    "mart_summary": _sql(
        "matched dimp",
        f"""select *, '2024-05-01 00:00:00' loaded_at,
                   {_LOADED.format(day='summary_date')} updated_at
            from ({_MATCHED_SUMMARY})""",
    ),
    "mart_rejects": _sql(
        "rejected",
        f"""with rejects as (
              select r.*, sale_date between date '1997-06-01' and date '1997-06-30' again
              from rejected r where {_NO_KEY})
            select sale_id, customer_id, product_id, reason, sale_date,
                   case when again then date '1997-06-01'
                        else (select min(sale_date) from rejected) end execution_date,
                   case when again then '2024-05-02 00:00:00' else '2024-05-01 00:00:00' end loaded_at,
                   'SUCCESS' status,
                   (select count(*) from rejects x where x.again or not r.again) rows_rejected
            from rejects r""",
    ),
    "mart_top_products": _sql("matched dimp", _TOP.replace("fact", "matched")),
    "mart_customer_ltv": _sql("matched dimc", _VALUE.format(fact="matched")),
    "mart_daily_summary": _sql("matched dimp", _MATCHED_SUMMARY),
    "mart_top_product_per_day": _sql(
        "matched dimp",
        f"""select summary_date, top_product_id, top_product_name, top_product_revenue
            from ({_MATCHED_SUMMARY})""",
    ),
    "mart_stage": _sql(
        "sales",
        f"""select sale_id, customer_id, product_id, quantity, unit_price, total_amount, sale_date,
                   cast(1 as int) batch_id, 'Airflow_Production' loaded_by from sales
            union all
            select sale_id, customer_id, product_id, quantity, unit_price, total_amount, sale_date,
                   2, 'Airflow_Test' from sales where sale_date = {_DAY}""",
    ),
    "run_log_started": _sql(
        "run_log",
        """select log_id, dag_id, task_id, execution_date, status from run_log
           where status = 'STARTED' and end_time is null""",
    ),
    "run_log_updated": _sql(
        "run_log",
        """select log_id,
                  case when log_id % 4 = 0 then 'FAILED' when log_id % 2 = 0 then 'SUCCESS'
                       else status end status,
                  case when log_id % 2 = 0 and log_id % 4 <> 0 then log_id % 700
                       else rows_loaded end rows_loaded,
                  case when log_id % 4 = 0 then 'step failed' end error_message,
                  case when log_id % 2 = 0 then start_time + to_seconds(60)
                       else end_time end end_time
           from run_log""",
    ),
    "run_log_completed": _sql(
        "run_log",
        """select log_id, case when log_id % 5 = 0 then 'SUCCESS' else status end status,
                  case when log_id % 5 = 0 then rows_extracted else rows_loaded end rows_loaded
           from run_log""",
    ),
    "decode_run_status": _sql(
        "job_history",
        f"select run_status, {_RUN_STATUS} status_text, count(*) n from job_history group by 1, 2",
    ),
    "decode_exec_status": _sql(
        "executions",
        f"select status, {_EXEC_STATUS} status_text, count(*) n from executions group by 1, 2",
    ),
    "run_duration_seconds": _sql(
        "job_history",
        """select instance_id, cast((run_duration // 10000) * 3600
                  + ((run_duration // 100) % 100) * 60 + run_duration % 100 as bigint)
                  duration_seconds
           from job_history""",
    ),
    "run_datetime": _sql(
        "job_history",
        f"""select instance_id, {_RUN_STATUS} status_text,
                   concat(cast(run_date as varchar), ' ',
                          substr(lpad(cast(run_time as varchar), 6, '0'), 1, 2), ':',
                          substr(lpad(cast(run_time as varchar), 6, '0'), 3, 2), ':',
                          substr(lpad(cast(run_time as varchar), 6, '0'), 5, 2)) run_datetime
            from job_history""",
    ),
    "execution_durations": _sql(
        "executions",
        """select execution_id, date_diff('second', start_time, end_time) duration_seconds
           from executions""",
    ),
    "latest_run_per_job": _sql(
        "job_history jobs",
        f"""select job_name, instance_id, run_status, {_RUN_STATUS} status_text, message
            from (select *, {_LATEST.format(by='job_name', order='instance_id')}
                  from job_history where step_id = 0) h
            join jobs using (job_name) where rn = 1""",
    ),
    "latest_execution": _sql(
        "executions",
        f"""select execution_id, folder_name, project_name, package_name, status,
                   {_EXEC_STATUS} status_text, start_time, end_time,
                   date_diff('second', start_time, end_time) duration_seconds
            from (select *, {_LATEST.format(by='folder_name, project_name, package_name', order='execution_id')}
                  from executions where cast(start_time as date) = date '2024-01-30')
            join region on folder_name = concat('folder_', cast(r_regionkey as varchar))
            where rn = 1 and r_name <> 'EUROPE'""",
    ),
    "runs_in_progress": _sql(
        "job_activity",
        """select distinct job_name from job_activity
           where start_execution_date is not null and stop_execution_date is null
             and session_id = (select max(session_id) from job_activity)""",
    ),
    "current_session_activity": _sql(
        "job_activity",
        """select job_name, run_requested_date from job_activity
           where session_id = (select max(session_id) from job_activity)""",
    ),
    "activity_step_text": _sql(
        "job_activity",
        """select job_name, run_requested_date,
                  case last_executed_step_id when 0 then 'Not running'
                       else concat('Step ', cast(last_executed_step_id as varchar)) end current_step
           from job_activity where session_id = (select max(session_id) from job_activity)""",
    ),
    "message_type_counts": _sql(
        "messages",
        """select operation_id, count(*) filter (where message_type = 120) error_count,
                  count(*) filter (where message_type = 110) warning_count,
                  count(*) filter (where message_type = 70) info_count
           from messages group by operation_id""",
    ),
    "component_stats": _sql(
        "messages",
        """select package_path, execution_path, subcomponent_name, message_type,
                  count(*) message_count
           from messages group by 1, 2, 3, 4
           order by message_count desc, 1, 2, 3, 4 limit 10""",
    ),
    "latest_messages": _sql(
        "messages",
        """select message_time, case message_type when 120 then 'ERROR' when 110 then 'WARNING'
                  when 70 then 'INFO' else cast(message_type as varchar) end "type",
                  message_source_name, substr(message, 1, 200) message
           from messages where message_type in (70, 110, 120)
           order by message_time desc, operation_id, message_source_name, message_type, message limit 20""",
    ),
    "execution_errors": _sql(
        "messages",
        """select operation_id, message_time, message
           from (select *, row_number() over (partition by operation_id
                     order by message_time desc, message) rn
                 from messages where message_type = 120) where rn <= 5""",
    ),
    "messages_by_prefix": _sql(
        "messages",
        """select message_source_name, count(*) n from messages
           where message_source_name like 's%' group by message_source_name""",
    ),
    "retention_candidates": _sql(
        "executions",
        """select count(*) executions_to_cleanup from executions
           where start_time < timestamp '2024-02-15 00:00:00' - interval 30 day""",
    ),
    "log_latest_execution": _sql(
        "executions",
        f"""select execution_id, folder_name, project_name, package_name, status,
                   {_EXEC_STATUS} status_text, start_time, end_time,
                   date_diff('second', start_time, end_time) duration_seconds
            from (select *, {_LATEST.format(by='folder_name, project_name, package_name', order='execution_id')}
                  from executions where cast(start_time as date) = date '2024-01-30')
            where rn = 1""",
    ),
    "log_retention": _sql(
        "executions",
        """select count(*) filter (where old) dropped, count(*) filter (where not old) kept
           from (select coalesce(start_time < timestamp '2024-02-15 00:00:00' - interval 30 day, false) old
                 from executions)""",
    ),
    "run_report": _sql(
        "executions messages",
        f"""select operation_id, execution_id, cast(start_time as date) execution_date, folder_name,
                   project_name, package_name, {_EXEC_STATUS} status_text,
                   date_diff('second', start_time, end_time) duration_seconds,
                   rows_loaded, error_count
            from (select *, {_LATEST.format(by='operation_id', order='execution_id')}
                  from executions)
            join (select operation_id, count(*) filter (where message_type = 120) error_count
                  from messages group by operation_id) using (operation_id)
            join (select cast(ts as date) d, count(*) rows_loaded from events group by 1)
                 on d = cast(start_time as date)
            where rn = 1""",
    ),
    "jobs_with_category": _sql(
        "jobs",
        """select job_name, r_name category_name
           from jobs left join region on category_id = r_regionkey""",
    ),
    "hierarchy_rollup": """select r_name region, n_name nation, count(*) customers
        from customer join nation on c_nationkey = n_nationkey
                      join region on n_regionkey = r_regionkey
        group by r_name, n_name""",
    "nested_lookup": """select c_custkey from customer where c_nationkey =
        (select n_nationkey from nation where n_name = 'NATION_3' and n_regionkey =
            (select r_regionkey from region where r_name = 'EUROPE'))""",
    "run_status_batch": """select user_id, arg_max(event_type, event_id) last_event_type,
        max(event_id) last_event_id from events group by user_id""",
    "run_timeouts": _sql(
        "job_history",
        """select run_id, started, started + to_seconds(3600) deadline
           from (select e.user_id run_id, min(ts) started,
                        min(ts) filter (where run_status in (0, 1, 3)) ended
                 from job_history h join events e on h.instance_id = e.event_id
                 where run_status is not null group by e.user_id)
           where started + to_seconds(3600) <= timestamp '2024-02-15 00:00:00'
             and (ended is null or ended > started + to_seconds(3600))""",
    ),
    # The watermark stands ten minutes behind the newest event.
    "run_timeouts_stream": _sql(
        "job_history",
        """select run_id, started + to_seconds(3600) deadline
           from (select e.user_id run_id, min(ts) started,
                        min(ts) filter (where run_status in (0, 1, 3)) ended
                 from job_history h join events e on h.instance_id = e.event_id
                 where run_status is not null group by e.user_id)
           where ended > started + to_seconds(3600)
              or (ended is null and started + to_seconds(3600)
                  <= (select max(ts) - to_seconds(600) from events))""",
    ),
    "run_status_stream": _sql(
        "job_history",
        f"""select run_id, instance_id, run_status status, {_RUN_STATUS} status_text
            from (select e.user_id run_id, h.instance_id, h.run_status,
                         row_number() over (partition by e.user_id order by e.event_id desc) rn
                  from job_history h join events e on h.instance_id = e.event_id)
            where rn = 1""",
    ),
}
