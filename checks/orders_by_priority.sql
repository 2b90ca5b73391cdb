select o_orderpriority, count(*) as orders, max(o_orderdate) as last_order
from sample_orders
group by o_orderpriority
