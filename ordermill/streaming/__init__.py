from ordermill.streaming.lines import gather_orders
from ordermill.streaming.orders import first_arrivals, stream_orders

__all__ = ["first_arrivals", "gather_orders", "stream_orders"]
