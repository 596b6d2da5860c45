from .fixture import TXN_CTE, transactions, transactions_from_events
from .tables import TABLES, read_table

__all__ = ["TXN_CTE", "TABLES", "read_table", "transactions", "transactions_from_events"]
