"""SQL that gives the rows of each gallery query, written independently."""

from __future__ import annotations

import math
from fractions import Fraction

FIXTURES = """
fx_seq as (select 1 as s union all select 2 union all select 3),
fx_packages as (
  select concat('pkg-', cast(bn as varchar)) as package_id, s as subpackage_id,
    10+s as width, 5+bn as height, 20 as length,
    case when s=3 then cast(null as float) else cast(s*1.25 as float) end as weight,
    case when bn%7=0 and s=1 then cast(null as int)
         else (10+s)*(5+bn)*20 end as volume
  from (select distinct cast(substr(p_brand,7) as int) as bn from part) b
  cross join fx_seq where not (bn%5=0 and s=2)
),
fx_products as (
  select concat('prd-', cast(p_partkey as varchar)) as product_id, p_name as product_name,
    p_type as category, cast(cast(p_retailprice as float) as double) as price,
    p_partkey%50=49 as is_empty, 1+p_partkey%3 as n_sizes
  from part
),
fx_components as (
  select concat('prd-', cast(p_partkey as varchar)) as product_id,
    p_name as product_name, cast(cast(p_retailprice as float) as double) as price,
    cast(s-1 as int) as component_pos,
    concat('pkg-', substr(p_brand,7)) as package_id,
    case when p_partkey%40=39 and s=1 then cast(null as int) else s end as subpackage_id,
    cast(1+(p_partkey+s)%4 as int) as package_quantity
  from part cross join fx_seq where s <= 1+p_partkey%3 and p_partkey%50<>49
),
fx_measured as (
  select c.*, k.width, k.height, k.length, cast(k.weight as double) as weight, k.volume
  from fx_components c left join fx_packages k
    on c.package_id = k.package_id and c.subpackage_id = k.subpackage_id
),
fx_units as (
  select product_id,
    sum(package_quantity * coalesce(cast(volume as double), cast(1 as double))) as unit_volume,
    sum(package_quantity * coalesce(weight, cast(1 as double))) as unit_weight
  from fx_measured group by product_id
),
fx_lines as (
  select concat('ord-', cast(l_orderkey as varchar)) as order_id,
    l_linenumber as pos,
    concat('prd-', cast(l_partkey as varchar)) as product_id,
    cast(l_quantity as int) as quantity
  from lineitem
),
fx_orders as (
  select concat('ord-', cast(o_orderkey as varchar)) as order_id,
    concat('addr-', cast(o_custkey as varchar)) as address_id
  from orders
),
fx_clients as (
  select concat('cl-', cast(c_custkey as varchar)) as client_id,
    concat('addr-', cast(c_custkey as varchar)) as address_id,
    n_name as country, r_name as state, c_mktsegment as occupation,
    cast(cast(cast(c_custkey%18000 as double)/cast(100 as double)-cast(90 as double) as float) as double) as lat,
    cast(cast(cast(c_custkey%36000 as double)/cast(100 as double)-cast(180 as double) as float) as double) as lon
  from customer join nation on c_nationkey=n_nationkey
  join region on n_regionkey=r_regionkey
)
"""

TOTALS = """
  count(*) as n_items,
  sum(l.quantity * p.price) as total_amount,
  sum(l.quantity * coalesce(u.unit_volume, cast(0 as double))) as total_volume,
  sum(l.quantity * coalesce(u.unit_weight, cast(0 as double))) as total_weight
"""

LINE_JOIN = """
  fx_lines l join fx_products p on l.product_id = p.product_id
  left join fx_units u on l.product_id = u.product_id
"""

SEED = 7
AS_OF = "2024-05-06 07:08:09"
RUN = "gallery"


def _draw(tag: str, id_sql: str) -> str:
    return f"cast('0x' || substr(md5('{SEED}:{tag}:' || {id_sql}), 1, 15) as bigint)"


def _choice(drawn: str, bounds: list[int]) -> str:
    total = bounds[-1]
    cases = " ".join(
        f"when {drawn} % {total} < {bound} then {k}"
        for k, bound in enumerate(bounds[:-1], start=1)
    )
    return f"cast(case {cases} else {len(bounds)} end as int)"


# 1/k in sixtieths for k up to 5, in sixths for k up to 3, summed up.
OF_FIVE = [60, 90, 110, 125, 137]
OF_THREE = [6, 9, 11]


def _uuid(text_sql: str) -> str:
    return (
        f"regexp_replace(md5({text_sql}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$',"
        r" '\1-\2-\3-\4-\5')"
    )


def _with(body: str, *more: str) -> str:
    return "with " + ",\n".join([FIXTURES, *more]) + "\n" + body


def _totals(on_empty: str) -> str:
    where = "where not p.is_empty" if on_empty == "drop_item" else ""
    having = "having not bool_or(p.is_empty)" if on_empty == "drop_order" else ""
    return f"""
    select l.order_id, {TOTALS} from {LINE_JOIN} {where}
    group by l.order_id {having}
    """


def _events(totals: str, orders: str, run: str = RUN) -> str:
    """``totals`` and ``orders`` (order_id, address_id) to flat events."""
    return f"""
    select 'ev-' || {_uuid(f"'5:event|' || cast(length('{run}') as varchar) || ':{run}|' || cast(length(t.order_id) as varchar) || ':' || t.order_id || '|-'")} as event_id,
      'ORDER_CREATED' as event_type, '{AS_OF}' as event_timestamp, t.order_id,
      c.client_id as customer_id, '{AS_OF}' as order_timestamp,
      '{AS_OF[:10]}' as order_date, t.n_items, t.total_amount, t.total_volume,
      t.total_weight, 'RECEIVED' as status, c.address_id, c.state, c.country, c.lat, c.lon,
      '' as payment_method, '' as payment_status, '' as transaction_id
    from {totals} t join {orders} o on t.order_id = o.order_id
    join fx_clients c on o.address_id = c.address_id
    """


REAL = f"real_totals as ({_totals('drop_order')})"
REAL_EVENTS = _events("real_totals", "fx_orders")


def _index(name: str, source: str, key: str) -> str:
    return f"""
    {name} as (
      select {key}, row_number() over (order by substr(md5({key}),1,4), {key}) - 1 as idx,
        count(*) over () as n_rows
      from {source}
    )"""


SECOND_EVENTS = _events("real_totals", "fx_orders", "second")


def _thirtieths() -> str:
    """k for a draw out of 30: the draws are cut at whole numbers."""
    shares = [Fraction(1, k) for k in range(1, 31)]
    cuts = [2**60 * sum(shares[:k]) / sum(shares) for k in range(1, 30)]
    cases = " ".join(
        f"when d < {math.floor(cut)} then {k}" for k, cut in enumerate(cuts, start=1)
    )
    return f"cast(case {cases} else 30 end as int)"


def _outcomes(on_empty: str) -> str:
    policy = {
        "drop_order": "when bool_or(p.is_empty) then 'empty_product'",
        "drop_item": "when bool_and(p.is_empty) then 'empty_product'",
        "keep": "",
    }[on_empty]
    return f"""
    with {FIXTURES}, judged as (
      select l.order_id, case when bool_or(p.product_id is null) then 'unknown_product'
          {policy} else 'accepted' end as outcome
      from fx_lines l left join fx_products p on l.product_id = p.product_id group by l.order_id
    )
    select coalesce(o.order_id, j.order_id) as order_id,
      case when j.order_id is null then 'no_lines'
        when j.outcome <> 'accepted' then j.outcome
        when c.address_id is null then 'unknown_client' else 'accepted' end as outcome
    from fx_orders o full join judged j on o.order_id = j.order_id
    left join fx_clients c on c.address_id = o.address_id
    """


LINE_PRODUCTS = """
select l.order_id, l.pos, l.product_id, p.product_name, p.price, l.quantity
from fx_lines l left join fx_products p on l.product_id = p.product_id
"""

# Whole parts and fractions (in units of 2**-62) are added up as whole numbers.
CHARGES = """
with priced as (
  select l_orderkey, l_extendedprice * (1 - l_discount) * (1 + l_tax) as x from lineitem
), parts as (
  select l_orderkey, sum(cast(trunc(x) as hugeint)) as whole,
    sum(cast((x - trunc(x)) * pow(2::double, 62) as hugeint)) as part from priced group by l_orderkey
)
select l_orderkey as order_key, cast(whole + part // 4611686018427387904 as double)
  + cast(part % 4611686018427387904 as double) / pow(2::double, 62) as charge from parts
"""

VALIDATED = """
with cased as (select event_id, event_id % 10 as c, value from events), fault as (
  select * from (values (0, '$', 'not_json'), (1, '$.id', 'absent'), (1, '$.type', 'absent'),
    (2, '$.type', 'not_text'), (3, '$.type', 'null'), (4, '$.parts[1].n', 'not_whole'),
    (5, '$.parts[1].n', 'out_of_range'), (6, '$.parts', 'not_array'), (7, '$.more', 'unexpected'),
    (8, '$', 'not_object')) f(c, path, reason)
)
select event_id, path, reason, cast(null as double) as value from cased join fault using (c)
union all select event_id, '', 'accepted', value from cased where c = 9
"""

DAMAGED = """
with cased as (select event_id, event_id % 5 as c from events)
select event_id, format, case when c < 2 then 'bad' else 'good' end as state,
  case when c >= 2 then '' when format = 'csv' then case c when 0 then 'value: not double' else 'columns' end
    when c = 0 then '$.value: not_number' else '$: not_json' end as reasons
from cased cross join (select unnest(['csv', 'json']) as format) f
"""

STREAM_LINES = f"""
with {FIXTURES}, cased as (
  select *, cast(substr(order_id, 5) as bigint) % 10 as n_case
  from (select distinct order_id from fx_lines)
), told as (
  select l.*, a.address_id,
    n_case = 0 and pos = max(pos) over o and min(pos) over o < max(pos) over o as late
  from fx_lines l join fx_orders a on l.order_id = a.order_id join cased c on l.order_id = c.order_id
  window o as (partition by l.order_id)
), judged as (
  select t.order_id, count(*) as n_lines, sum(t.quantity * p.price) as total_amount,
    case when bool_or(p.product_id is null) then 'unknown_product'
      when bool_or(p.is_empty) then 'empty_product'
      when bool_or(c.address_id is null) then 'unknown_client' else 'accepted' end as outcome
  from told t left join fx_products p on t.product_id = p.product_id
  left join fx_clients c on t.address_id = c.address_id where not late group by t.order_id
)
select order_id, outcome, n_lines, case when outcome = 'accepted' then total_amount end as total_amount from judged
union all select order_id, 'late_line', count(*), null from told where late group by order_id
union all select null, 'no_order_id', 1, null where exists (select 1 from told where late)
"""


def oracle_sql() -> dict[str, str]:
    real_events = _with(REAL_EVENTS, REAL)
    hist = [
        f"""select cast({n} as int) as n, {_choice(_draw("hist", "order_id"), bounds)} as k
        from fx_orders"""
        for n, bounds in ((5, OF_FIVE), (3, OF_THREE))
    ]
    hist.append(
        f"""select cast(30 as int) as n, {_thirtieths()} as k
        from (select {_draw("hist", "order_id")} as d from fx_orders) x"""
    )
    formats = " union all ".join(
        f"select '{name}' as format, * from customer"
        for name in ("csv", "json", "orc", "parquet")
    )
    return {
        "lookup_product": _with(
            """select product_id, product_name as name, category, price,
                 case when is_empty then 0 else n_sizes end as n_components
               from fx_products where category = 'ECONOMY'"""
        ),
        "lookup_pruned": _with(
            """select *, 'product' as by from fx_lines where product_id in ('prd-17', 'prd-180')
               union all select *, 'order' from fx_lines where order_id = 'ord-17'"""
        ),
        "dimension_snapshot": _with(
            """select b.batch, product_id, price from fx_products
                 cross join (select unnest(['first', 'second']) as batch) b
               union all select 'next run', product_id, price * 2 from fx_products
               where product_id <> 'prd-1'"""
        ),
        "line_products_bucketed": _with(LINE_PRODUCTS),
        "line_products_hot": _with(
            """select l.order_id, l.pos, l.product_id, p.product_name, p.price, l.quantity
               from (select order_id, pos, quantity, case
                   when cast(substr(order_id, 5) as bigint) % 3 = 0 then 'prd-7'
                   when cast(substr(order_id, 5) as bigint) % 10 <> 1 then product_id end as product_id
                 from fx_lines) l left join fx_products p on l.product_id = p.product_id"""
        ),
        "order_totals_exact": _with(
            f"""select t.*, r.route from ({_totals('drop_order')}) t
                cross join (select unnest(['flat', 'nested']) as route) r"""
        ),
        "charges_exact": CHARGES,
        "validate_documents": VALIDATED,
        "read_damaged": DAMAGED,
        "lookup_client": _with(
            """select client_id, address_id, country, occupation
               from fx_clients where state = 'ASIA'"""
        ),
        "dimension_rows": _with(
            """select 'clients' as source, address_id as key, client_id as label from fx_clients
               union all select 'products', product_id, product_name from fx_products
               union all select 'packages', package_id || '/' || cast(subpackage_id as varchar),
                 'box ' || substr(package_id, 5) from fx_packages"""
        ),
        "first_client_by_country": _with(
            """select country, occupation, client_id from (
                 select *, row_number() over (
                   partition by country order by occupation, client_id) as n
                 from fx_clients) r where n = 1"""
        ),
        "client_index": _with(
            "select address_id, idx from client_index",
            _index("client_index", "fx_clients", "address_id"),
        ),
        "explode_components": _with("select * from fx_components"),
        "component_measures": _with(
            f"""select product_id, {_choice(_draw("qty", "product_id"), OF_THREE)}
                 as product_quantity,
                 package_id, subpackage_id, product_name, price, package_quantity,
                 width, height, length, weight, volume
               from fx_measured"""
        ),
        "unmatched_components": _with(
            """select product_id, package_id, subpackage_id, package_quantity
               from fx_components c where not exists (
                 select 1 from fx_packages k where k.package_id = c.package_id
                   and k.subpackage_id = c.subpackage_id)"""
        ),
        "item_packages": _with(
            """select product_id, product_name, price, component_pos as package_pos,
                 package_id, subpackage_id, package_quantity as quantity, weight,
                 cast(volume as double) as volume
               from fx_measured"""
        ),
        "unit_measures": _with(
            """select p.product_id, product_name, price, is_empty, unit_volume, unit_weight
               from fx_products p left join fx_units u on p.product_id = u.product_id"""
        ),
        "line_products": _with(LINE_PRODUCTS),
        "order_totals_nested": _with(_totals("drop_order")),
        "order_totals_flat": _with(_totals("drop_order")),
        "order_totals_drop_item": _with(_totals("drop_item")),
        "order_totals_keep": _with(_totals("keep")),
        "order_totals_parts": _with(
            f"""select t.*, cast(0 as bigint) as n_wrong, cast(0 as bigint) as n_missing, m.most
                from ({_totals('drop_order')}) t
                cross join (select cast(unnest([1, 4, 0]) as int) as most) m"""
        ),
        "order_outcomes": _outcomes("drop_order"),
        "order_outcomes_drop_item": _outcomes("drop_item"),
        "order_outcomes_keep": _outcomes("keep"),
        "order_rejects": _with(
            """select l.order_id, 'empty_product' as reason, count(*) as n_lines
               from fx_lines l join fx_products p on l.product_id = p.product_id
               group by l.order_id having bool_or(p.is_empty)"""
        ),
        "order_item_packages": _with(
            """select l.order_id, l.product_id, l.quantity, m.package_id, m.subpackage_id,
                 m.package_quantity, m.weight, cast(m.volume as double) as volume
               from fx_lines l join fx_measured m on l.product_id = m.product_id
               where l.order_id in (select order_id from real_totals)""",
            REAL,
        ),
        "destination_address": _with(
            """select o.order_id, c.client_id as customer_id, c.address_id, c.state,
                 c.country, cast(null as varchar) as postcode,
                 c.lat as first_coordinate, c.lon as second_coordinate, c.lat, c.lon
               from fx_orders o join fx_clients c on o.address_id = c.address_id"""
        ),
        "order_events": real_events,
        "published_lines": real_events,
        "stream_published": real_events,
        "event_envelope": _with(
            f"select *, 'ORDER_CREATED' as record_key from ({REAL_EVENTS}) e", REAL
        ),
        "kinesis_records": _with(
            f"""select order_id as partition_key, event_id, total_amount
                from ({REAL_EVENTS}) e""",
            REAL,
        ),
        "validate_events": """
            select event_id, case when event_id % 10 <> 0 then event_type end as event_type,
              case when event_id % 10 <> 0 and event_type is not null
                then 'accepted' else 'rejected' end as verdict
            from events""",
        "validate_json": """
            select event_id, case when event_id % 5 = 4 and event_type is not null
                then 'accepted' else 'rejected' end as verdict
            from events""",
        "reciprocal_choice_hist": _with(
            f"""select n, k, count(*) as n_draws from ({" union all ".join(hist)}) h
                group by n, k"""
        ),
        "draw_clients": _with(
            f"""select o.order_id, i.address_id from fx_orders o join client_index i
                on i.idx = {_draw("client", "o.order_id")} % i.n_rows""",
            _index("client_index", "fx_clients", "address_id"),
        ),
        "draw_products": _with(
            f"""select l.order_id, l.pos, i.product_id from fx_lines l join product_index i
                on i.idx = {_draw("product", "l.order_id || ':' || cast(l.pos as varchar)")} % i.n_rows""",
            _index("product_index", "fx_products", "product_id"),
        ),
        "stream_orders": real_events,
        "append_roundtrip": _with(f"{REAL_EVENTS} union all {SECOND_EVENTS}", REAL),
        "append_replayed": _with(f"{REAL_EVENTS} union all {SECOND_EVENTS}", REAL),
        "written_once": _outcomes("drop_order"),
        "stream_once": real_events,
        "stream_lines": STREAM_LINES,
        "read_formats": formats,
    }
