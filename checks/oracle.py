"""The registered queries once more, as SQL over the driver's tables.

Money is counted in whole cents and time in whole microseconds, so sums are exact and means can
be rounded half away from zero on integers; only the last division makes a DOUBLE.
"""

from __future__ import annotations

MICROS_PER_DAY = 86_400_000_000

VIEWS = {
    "customers": """
        select o_orderkey as customer_id, o_custkey * 10000 + year(o_orderdate) as customer_unique_id,
               n_name as customer_state
        from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey""",
    "first_shipment": """
        select o_orderkey, min(l_shipdate) as shipped
        from orders join lineitem on l_orderkey = o_orderkey and l_shipdate >= o_orderdate
        group by o_orderkey""",
    "sales": """
        select o_orderkey as order_id, o_orderkey as customer_id,
               case when o_orderstatus = 'F' then 'delivered' when o_orderstatus = 'O' then 'shipped'
                    when o_orderpriority = '1-URGENT' then 'canceled'
                    when o_orderpriority = '2-HIGH' then 'unavailable' else 'processing' end as order_status,
               o_orderdate as purchased, shipped as delivered,
               o_orderdate + interval '365' day as estimated
        from orders left join first_shipment using (o_orderkey)""",
    "items": """
        select l_orderkey as order_id, l_linenumber as order_item_id, l_partkey as product_id,
               l_suppkey as seller_id, l_shipdate as shipping_limit_date,
               cast(l_extendedprice as decimal(10,2)) as price, cast(l_quantity as decimal(10,2)) as freight_value,
               cast(100 * cast(l_extendedprice as decimal(10,2)) as bigint) as price_cents,
               cast(100 * (cast(l_extendedprice as decimal(10,2)) + cast(l_quantity as decimal(10,2))) as bigint)
                   as gross_cents
        from lineitem""",
    "sellers": """
        select s_suppkey as seller_id, s_name as seller_city, n_name as seller_state
        from supplier join nation on n_nationkey = s_nationkey""",
    "products": """
        select p_partkey as product_id,
               case when p_size = 50 then null else p_brand || '/' || cast(p_size as varchar) end as category_name
        from part""",
    "translation": """
        select distinct p_brand || '/' || cast(p_size as varchar) as category_name,
               lower(p_brand || '/' || cast(p_size as varchar)) as english
        from part where p_size <= 30""",
    "labelled": """
        select product_id, coalesce(english, category_name, 'Uncategorized') as category
        from products left join translation using (category_name)""",
    "payments": """
        select user_id as order_id, event_id as payment_sequential, event_type as payment_type,
               cast(json_extract_string(props, '$.k') as int) % 12 + 1 as payment_installments,
               cast(100 * cast(value as decimal(10,2)) as bigint) as payment_cents
        from events""",
    "reviews": """
        select event_id as review_id, event_id // 2 as order_id,
               1 + cast(json_extract_string(props, '$.k') as int) % 5 as review_score
        from events""",
    "active": "select * from sales where order_status not in ('canceled', 'unavailable')",
    "persons": """
        select customer_unique_id, count(distinct order_id) as total_orders, sum(gross_cents) as cents,
               count(*) as item_rows, cast(min(purchased) as date) as first_order_date,
               cast(max(purchased) as date) as last_order_date
        from customers join active using (customer_id) join items using (order_id)
        group by customer_unique_id""",
    "quartiles": """
        select *, ntile(4) over (order by cents desc nulls first, customer_unique_id) as quartile from persons""",
    "category_totals": """
        select category, count(distinct order_id) as total_orders, sum(price_cents) as cents, count(*) as item_rows
        from items join active using (order_id) join labelled using (product_id) group by category""",
    "seller_totals": """
        select seller_id, seller_city, seller_state, count(distinct items.order_id) as total_orders,
               count(distinct product_id) as unique_products, sum(price_cents) as cents,
               sum(review_score) as score_sum, count(review_score) as scores
        from items join sellers using (seller_id) join active on active.order_id = items.order_id
             left join reviews on reviews.order_id = active.order_id
        group by seller_id, seller_city, seller_state""",
    "state_totals": """
        select customer_state, count(distinct order_id) as total_orders,
               count(distinct customer_unique_id) as unique_customers, sum(gross_cents) as cents,
               count(*) as item_rows
        from customers join active using (customer_id) join items using (order_id) group by customer_state""",
}

# Which views each view reads; the statement for a query holds just the ones it needs.
VIEW_INPUTS = {
    "sales": ["first_shipment"],
    "labelled": ["products", "translation"],
    "active": ["sales"],
    "persons": ["customers", "active", "items"],
    "quartiles": ["persons"],
    "category_totals": ["items", "active", "labelled"],
    "seller_totals": ["items", "sellers", "active", "reviews"],
    "state_totals": ["customers", "active", "items"],
}


def statement(views: str, body: str) -> str:
    needed: list[str] = []

    def add(view: str) -> None:
        for inner in VIEW_INPUTS.get(view, []):
            add(inner)
        if view not in needed:
            needed.append(view)

    for view in views.split():
        add(view)
    named = ",\n".join(f"{v} as ({VIEWS[v]})" for v in needed)
    return f"with {named}\n{body}" if named else body


def ratio(num: str, den: str, digits: int) -> str:
    """``num / den`` for whole numbers, rounded half away from zero to ``digits``."""
    n = f"(cast({num} as hugeint) * {10 ** digits})"
    d = f"cast({den} as hugeint)"
    rounded = f"(sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // nullif(2 * abs({d}), 0)))"
    return f"(cast({rounded} as double) / {10 ** digits})"


def money(cents: str) -> str:
    return f"(cast({cents} as double) / 100)"


def mean_money(cents: str, count: str) -> str:
    return ratio(cents, f"100 * {count}", 2)


def mean_days(micros: str) -> str:
    return ratio(f"sum({micros})", f"count({micros}) * {MICROS_PER_DAY}", 1)


def micros(start: str, end: str) -> str:
    return f"(epoch_us({end}) - epoch_us({start}))"


DELIVERY = f"""count(order_id) as delivered_orders,
    {mean_days(micros('purchased', 'delivered'))} as avg_delivery_days,
    {mean_days(micros('delivered', 'estimated'))} as avg_days_early_vs_estimate
    from sales join customers using (customer_id)
    where order_status = 'delivered' and delivered is not null"""

SEGMENT = """case when order_count = 1 then '1 – One-time buyer' when order_count = 2 then '2 – Repeat (2 orders)'
    when order_count between 3 and 5 then '3-5 – Loyal' when order_count >= 6 then '6+ – VIP' end"""

PERSON_COLUMNS = f"""customer_unique_id, total_orders, {money('cents')} as lifetime_value,
    {mean_money('cents', 'item_rows')} as avg_order_value, first_order_date, last_order_date,
    cast(datediff('day', first_order_date, last_order_date) as int) as customer_lifespan_days,
    cast(quartile as int) as clv_quartile"""

REPORTS = {
    "q01_monthly_revenue": statement(
        "active items",
        f"""
        select strftime(first_day, '%Y-%m') as month, {money('cents')} as revenue,
               {money('previous')} as prev_month_revenue,
               {ratio('100 * (cents - previous)', 'previous', 2)} as mom_pct_change
        from (select first_day, cents, lag(cents) over (order by first_day nulls last) as previous
              from (select date_trunc('month', purchased) as first_day, sum(gross_cents) as cents
                    from active join items using (order_id) group by 1))""",
    ),
    "q02_top_categories": statement(
        "category_totals",
        f"""
        select category, total_orders, {money('cents')} as total_revenue,
               {mean_money('cents', 'item_rows')} as avg_item_price
        from category_totals order by cents desc nulls first, category limit 20""",
    ),
    "q03_delivery_by_state": statement(
        "sales customers", f"select customer_state, {DELIVERY} group by customer_state"
    ),
    "q04_payment_breakdown": statement(
        "payments",
        f"""
        select payment_type, total_orders, {money('cents')} as total_revenue,
               {mean_money('cents', 'payments')} as avg_order_value,
               {ratio('installments', 'payments', 1)} as avg_installments,
               {ratio('100 * total_orders', 'sum(total_orders) over ()', 2)} as pct_of_orders
        from (select payment_type, count(distinct order_id) as total_orders, sum(payment_cents) as cents,
                     count(*) as payments, sum(payment_installments) as installments
              from payments group by payment_type)""",
    ),
    "q05_top_sellers": statement(
        "seller_totals",
        f"""
        select seller_id, seller_city, seller_state, total_orders, unique_products,
               {money('cents')} as total_revenue, {ratio('score_sum', 'scores', 2)} as avg_review_score
        from seller_totals order by cents desc nulls first, seller_id limit 10""",
    ),
    "q06_review_by_category": statement(
        "reviews sales items labelled",
        f"""
        select category, count(review_id) as total_reviews,
               {ratio('sum(review_score)', 'count(review_score)', 2)} as avg_review_score,
               count(*) filter (where review_score = 5) as five_star_count,
               count(*) filter (where review_score <= 2) as low_score_count
        from reviews join sales using (order_id) join items using (order_id) join labelled using (product_id)
        where review_score is not null group by category having count(review_id) >= 30""",
    ),
    "q07_state_volume": statement(
        "state_totals",
        f"""
        select customer_state, total_orders, unique_customers, {money('cents')} as total_revenue,
               {mean_money('cents', 'item_rows')} as avg_order_value
        from state_totals""",
    ),
    "q08_repeat_customers": statement(
        "customers active",
        f"""
        select customer_segment, customer_count,
               {ratio('100 * customer_count', 'sum(customer_count) over ()', 2)} as pct_of_customers
        from (select {SEGMENT} as customer_segment, count(*) as customer_count
              from (select customer_unique_id, count(distinct order_id) as order_count
                    from customers join active using (customer_id) group by customer_unique_id)
              group by 1)""",
    ),
    "q09_status_breakdown": statement(
        "sales",
        f"""
        select order_status, order_count,
               {ratio('100 * order_count', 'sum(order_count) over ()', 2)} as pct_of_total
        from (select order_status, count(*) as order_count from sales group by order_status)""",
    ),
    "q10_customer_clv": statement(
        "quartiles",
        f"select {PERSON_COLUMNS} from quartiles order by cents desc nulls first, customer_unique_id limit 50",
    ),
    "q10_clv_full": statement("quartiles", f"select {PERSON_COLUMNS} from quartiles"),
}

METRICS = {
    "m01_category_share": statement(
        "category_totals",
        f"""
        select category, {money('cents')} as total_revenue,
               {ratio('100 * cents', 'sum(cents) over ()', 2)} as pct_of_revenue,
               {ratio('100 * so_far', 'sum(cents) over ()', 2)} as running_pct
        from (select *, sum(cents) over (order by cents desc nulls first, category
                                         rows unbounded preceding) as so_far
              from category_totals)""",
    ),
    "m02_overall_delivery": statement("sales customers", f"select {DELIVERY}"),
    "m03_seller_state_concentration": statement(
        "seller_totals",
        f"""
        select seller_state, count(*) as sellers, {money('sum(cents)')} as total_revenue
        from (select * from seller_totals order by cents desc nulls first, seller_id limit 10)
        group by seller_state""",
    ),
    "m04_state_share": statement(
        "state_totals",
        f"""
        select customer_state, total_orders,
               {ratio('100 * total_orders', 'sum(total_orders) over ()', 2)} as pct_of_orders
        from state_totals""",
    ),
    "m05_clv_quartiles": statement(
        "quartiles",
        f"""
        select cast(quartile as int) as clv_quartile, customers, {money('cents')} as total_value,
               {mean_money('cents', 'customers')} as avg_lifetime_value,
               {mean_money('sum(cents) over ()', 'sum(customers) over ()')} as avg_lifetime_value_all
        from (select quartile, count(*) as customers, sum(cents) as cents from quartiles group by quartile)""",
    ),
    "m06_order_value_true": statement(
        "state_totals",
        f"""
        select customer_state, total_orders, {mean_money('cents', 'item_rows')} as avg_item_value,
               {mean_money('cents', 'total_orders')} as avg_order_value
        from state_totals""",
    ),
    "m06_seller_revenue_true": statement(
        "items active seller_totals",
        f"""
        select seller_id, {money('true_cents')} as revenue, {money('cents')} as reported_revenue
        from seller_totals
             join (select seller_id, sum(price_cents) as true_cents
                   from items join active using (order_id) group by seller_id) using (seller_id)""",
    ),
}

OPERATORS = {
    "active_filter": statement(
        "active",
        """
        select order_id, order_status, purchased as order_purchase_timestamp,
               delivered as order_delivered_customer_date
        from active where order_status = 'delivered' and delivered is not null and delivered <= estimated""",
    ),
    "inner_join_chain": statement(
        "items sales products sellers customers",
        f"""
        select order_status, count(*) as item_rows, {money('sum(gross_cents)')} as gross
        from items join sales using (order_id) join products using (product_id)
             join sellers using (seller_id) join customers using (customer_id)
        group by order_status""",
    ),
    "left_join_coalesce": statement(
        "items labelled",
        "select category, count(*) as item_rows from items join labelled using (product_id) group by category",
    ),
    "fanout_join": statement(
        "items reviews",
        f"""
        select items.order_id, count(*) as joined_rows, count(review_id) as pair_count,
               {money('sum(price_cents)')} as repeated_price
        from items left join reviews on reviews.order_id = items.order_id group by items.order_id""",
    ),
    "two_distinct": statement(
        "items",
        """
        select seller_id, count(distinct order_id) as orders, count(distinct product_id) as products
        from items group by seller_id""",
    ),
    "exact_avg": statement(
        "items",
        f"""
        select seller_id, {mean_money('sum(price_cents)', 'count(*)')} as mean_price,
               {ratio('sum(order_item_id)', 'count(*)', 1)} as mean_line,
               {mean_money('sum(gross_cents)', 'count(distinct order_id)')} as gross_per_order
        from items group by seller_id""",
    ),
    "elapsed_days": statement(
        "sales customers",
        f"""
        select customer_unique_id, {mean_days(micros('purchased', 'delivered'))} as mean_days,
               cast(datediff('day', cast(min(purchased) as date), cast(max(purchased) as date)) as int) as lifespan_days
        from sales join customers using (customer_id) group by customer_unique_id""",
    ),
    "conditional_count": statement(
        "reviews",
        """
        select order_id // 50 as order_block, count(*) as reviews,
               count(*) filter (where review_score = 5) as five_stars,
               count(*) filter (where review_score <= 2) as low_scores,
               count(*) filter (where review_score between 2 and 4) as middle_scores
        from reviews group by 1 having count(*) >= 30""",
    ),
    "min_max_sort": statement(
        "sales customers",
        """
        select customer_unique_id, min(purchased) as first_purchase, max(purchased) as last_purchase
        from sales join customers using (customer_id) group by customer_unique_id""",
    ),
    "order_ascending": statement(
        "sales",
        """
        select strftime(first_day, '%Y-%m') as month, count(*) as orders,
               row_number() over (order by first_day asc nulls last) as place
        from (select date_trunc('month', delivered) as first_day from sales) group by first_day""",
    ),
    "order_descending": statement(
        "sales",
        """
        select strftime(first_day, '%Y-%m') as month, count(*) as orders,
               row_number() over (order by first_day desc nulls first) as place
        from (select date_trunc('month', delivered) as first_day from sales) group by first_day""",
    ),
    "order_by_unreturned": statement(
        "customers active",
        f"""
        select customer_segment, customer_count, row_number() over (order by least) as place
        from (select {SEGMENT} as customer_segment, count(*) as customer_count, min(order_count) as least
              from (select customer_unique_id, count(*) as order_count
                    from customers join active using (customer_id) group by 1) group by 1)""",
    ),
    "month_bucket": statement(
        "sales",
        "select strftime(purchased, '%Y-%m') as month, count(*) as orders from sales group by 1",
    ),
    "lag_change": statement(
        "payments",
        f"""
        select payment_day, {money('cents')} as paid, {money('previous')} as previous_paid,
               {ratio('100 * (cents - previous)', 'previous', 2)} as pct_change
        from (select payment_day, cents, lag(cents) over (order by payment_day) as previous
              from (select cast(ts as date) as payment_day,
                           sum(cast(100 * cast(value as decimal(10,2)) as bigint)) as cents
                    from events group by 1))""",
    ),
    "share_of_total": statement(
        "items",
        f"""
        select order_item_id, item_rows,
               {ratio('100 * item_rows', 'sum(item_rows) over ()', 2)} as pct_of_items
        from (select order_item_id, count(*) as item_rows from items group by order_item_id)""",
    ),
    "ntile_global": statement(
        "",
        """
        select o_orderkey as order_id,
               cast(ntile(7) over (order by o_totalprice desc nulls first, o_orderkey) as int) as tile
        from orders""",
    ),
    "topk": statement(
        "items",
        f"""
        select 'categories' as ranking, cast(product_id as varchar) as id, {money('cents')} as amount from
            (select product_id, sum(price_cents) as cents from items group by 1 order by 2 desc, 1 limit 20)
        union all
        select 'sellers', cast(seller_id as varchar), {money('cents')} from
            (select seller_id, sum(price_cents) as cents from items group by 1 order by 2 desc, 1 limit 10)
        union all
        select 'orders', cast(order_id as varchar), {money('cents')} from
            (select order_id, sum(price_cents) as cents from items group by 1 order by 2 desc, 1 limit 50)""",
    ),
    "dedup_keep_first": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice from (
            select *, row_number() over (
                partition by l_orderkey, l_linenumber
                order by l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax,
                         l_returnflag, l_linestatus) as place
            from lineitem) where place = 1""",
}

QUALITY = {
    "pk_violations": statement(
        "items",
        """
        select order_id, order_item_id, count(*) as row_count
        from items group by order_id, order_item_id having count(*) > 1""",
    ),
    "fk_orphans": statement(
        "sales items",
        """
        select order_id as reference, count(*) as row_count from sales
        where order_id not in (select order_id from items) group by order_id""",
    ),
    "check_violations": """
        select event_id, cast(json_extract_string(props, '$.k') as int) % 7 as score from events
        where not (cast(json_extract_string(props, '$.k') as int) % 7 between 1 and 5)""",
    "null_counts": statement(
        "sales products",
        """
        select 'order_purchase_timestamp' as column_name, count(*) - count(purchased) as null_count from sales
        union all select 'order_delivered_customer_date', count(*) - count(delivered) from sales
        union all select 'order_estimated_delivery_date', count(*) - count(estimated) from sales
        union all select 'product_category_name', count(*) - count(category_name) from products""",
    ),
    "length_violations": """
        select p_partkey, 'p_name' as column_name, cast(length(p_name) as int) as value_length, 10 as max_length
        from part where length(p_name) > 10
        union all
        select p_partkey, 'p_brand', cast(length(p_brand) as int), 7 from part where length(p_brand) > 7""",
}

LOADS = {
    "load_csv_roundtrip": statement(
        "items",
        """
        select cast(order_id as varchar) as order_id, order_item_id, cast(product_id as varchar) as product_id,
               cast(seller_id as varchar) as seller_id, shipping_limit_date, cast(price as double) as price,
               cast(freight_value as double) as freight_value
        from items""",
    ),
    "load_text_roundtrip": """
        select cast(doc_id as varchar) as review_id, lang as review_comment_title, text as review_comment_message
        from documents""",
    "load_audit": statement(
        "customers sales items sellers products translation payments reviews",
        " union all ".join(
            f"select '{table}' as table_name, count(*) as row_count from {view}"
            for table, view in {
                "product_category_name_translation": "translation",
                "customers": "customers",
                "sellers": "sellers",
                "products": "products",
                "orders": "sales",
                "order_items": "items",
                "order_payments": "payments",
                "order_reviews": "reviews",
            }.items()
        ),
    ),
    "load_null_marker": """
        select cast(doc_id as varchar) as review_id,
               case doc_id % 3 when 0 then 'null' when 1 then 'empty' else 'text ' || lang end as title,
               case doc_id % 3 when 0 then 0 when 1 then -1 else cast(length(text) as int) end as message_length
        from documents""",
    "load_strict": statement(
        "customers sales items sellers products translation",
        """
        select table_name, row_count as first_load,
               case when table_name = 'order_payments' then 0 else row_count end as second_load
        from (
            select 'product_category_name_translation' as table_name, count(*) as row_count from translation
            union all select 'geolocation', 0
            union all select 'customers', count(*) from customers
            union all select 'sellers', count(*) from sellers
            union all select 'products', count(*) from products
            union all select 'orders', count(*) from sales
            union all select 'order_items', count(distinct (order_id, order_item_id)) from items
            union all select 'order_payments', count(*) from events
            union all select 'order_reviews', count(distinct event_id // 3) from events
        )""",
    ),
    "load_lenient_reasons": statement(
        "customers sales items sellers products",
        """
        , customers_judged as (
            select customer_id, case when customer_id % 40 = 1 then 'customer_id longer than 32' else 'accepted' end as outcome
            from customers
        ), sellers_judged as (
            select seller_id, case when seller_id % 5 = 0 then 'seller_city missing' else 'accepted' end as outcome from sellers
        ), products_judged as (
            select product_id, case when product_id % 50 = 0 then 'unreadable' else 'accepted' end as outcome from products
        ), orders_judged as (
            select order_id, case when order_id % 40 = 2 then 'unreadable'
                when customer_id not in (select customer_id from customers_judged where outcome = 'accepted')
                then 'customer_id not in customers' else 'accepted' end as outcome
            from sales
        ), good_orders as (
            select order_id from orders_judged where outcome = 'accepted'
        ), items_judged as (
            select case when count(*) over (partition by order_id, order_item_id) > 1 then 'duplicate key'
                when order_id not in (from good_orders) then 'order_id not in orders'
                when product_id not in (select product_id from products_judged where outcome = 'accepted')
                then 'product_id not in products'
                when seller_id not in (select seller_id from sellers_judged where outcome = 'accepted')
                then 'seller_id not in sellers' else 'accepted' end as outcome
            from items
        ), payments_judged as (
            select case when event_id % 20 in (3, 4) then 'unreadable'
                when event_id // 2 not in (from good_orders) then 'order_id not in orders' else 'accepted' end as outcome
            from events
        ), reviews_judged as (
            select event_id // 3 as review_id, event_id // 2 as order_id, ts,
                cast(json_extract_string(props, '$.k') as int) % 7 as score,
                case when cast(json_extract_string(props, '$.k') as int) % 7 not between 1 and 5
                    then 'review_score not in 1..5'
                when event_id % 9 = 0 or event_id // 2 not in (from good_orders) then 'order_id not in orders' end as reason
            from events
        ), reviews_chosen as (
            select case when reason is not null then reason
                when row_number() over (partition by review_id, reason order by ts, cast(order_id as varchar), score) > 1
                then 'repeated key' else 'accepted' end as outcome
            from reviews_judged
        )
        select table_name, outcome, sum(row_count)::bigint as row_count from (
            select 'customers' as table_name, outcome, 1 as row_count from customers_judged
            union all select 'sellers', outcome, 1 from sellers_judged
            union all select 'products', outcome, 1 from products_judged
            union all select 'orders', outcome, 1 from orders_judged
            union all select 'order_items', outcome, 1 from items_judged
            union all select 'order_payments', outcome, 1 from payments_judged
            union all select 'order_reviews', outcome, 1 from reviews_chosen
            union all select unnest(['product_category_name_translation', 'geolocation']), 'accepted', 0
        ) group by table_name, outcome""",
    ),
    "load_refresh": statement(
        "customers sales items sellers products translation payments",
        """
        , judged as (
            select 'product_category_name_translation' as table_name, 'accepted' as outcome from translation
            union all select 'customers', 'accepted' from customers
            union all select 'sellers', 'accepted' from sellers
            union all select 'products', 'accepted' from products
            union all select 'orders', 'accepted' from sales
            union all select 'order_items', case when count(*) over (partition by order_id, order_item_id) > 1
                then 'duplicate key' else 'accepted' end from items
            union all select 'order_payments', case when payment_sequential > 32767 then 'unreadable'
                when order_id not in (select order_id from sales) then 'order_id not in orders'
                else 'accepted' end from payments
            union all select 'order_reviews',
                case when cast(json_extract_string(props, '$.k') as int) % 7 not between 1 and 5
                    then 'review_score not in 1..5'
                when event_id // 2 not in (select order_id from sales) then 'order_id not in orders'
                else 'accepted' end from events)
        select table_name, outcome, count(*) as row_count from judged group by table_name, outcome
        union all select 'geolocation', 'accepted', 0""",
    ),
    "load_stopped": statement(
        "customers sales items sellers products translation",
        """
        , repeated as (
            select count(*) as keys from (select order_id, order_item_id from items group by all having count(*) > 1)
        ), missing as (
            select count(distinct seller_id) as sellers from items where seller_id % 2 = 1
        )
        select 'product_category_name_translation' as table_name, count(*) as row_count, null::varchar as problem from translation
        union all select 'geolocation', 0, null
        union all select 'customers', count(*), null from customers
        union all select 'sellers', count(*), null from sellers where seller_id % 2 = 0
        union all select 'products', count(*), null from products
        union all select 'orders', count(*), null from sales
        union all select 'order_items', 0, 'duplicate key: ' || keys || ', seller_id not in sellers: ' || sellers from repeated, missing
        union all select unnest(['order_payments', 'order_reviews']), 0, null""",
    ),
    "load_fault_places": """
        with lines as (
            select doc_id, doc_id % 8 as part,
                case when doc_id % 50 = 13 then 1 else 1 + length(text) - length(replace(text, chr(10), '')) end as height
            from documents
        ), placed as (
            select doc_id, part, 2 + coalesce(sum(height) over (
                partition by part order by doc_id rows between unbounded preceding and 1 preceding), 0) as line
            from lines
        )
        select cast(part as int) as part, cast(line as bigint) as line,
            case doc_id % 50 when 17 then 'order_id missing' when 19 then 'review_score not in 1..5' else 'unreadable' end as reason,
            case doc_id % 50 when 7 then 'review_score' when 17 then 'order_id' when 19 then 'review_score' end as column_name
        from placed where doc_id % 50 in (7, 11, 13, 17, 19)""",
    "load_first_in_file": """
        select cast(event_id // 3 as varchar) as review_id, cast(event_id // 2 as varchar) as order_id, cast(event_id as varchar) as event_id
        from events qualify row_number() over (partition by event_id // 3 order by event_id % 4, event_id desc) = 1""",
}
