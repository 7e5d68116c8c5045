from ordermill.plans.catalog import Catalog, prepare_catalog
from ordermill.plans.writing import Written, write_orders

__all__ = ["Catalog", "Written", "prepare_catalog", "write_orders"]
