from . import fixtures, landing
from .landing import (landing_dates, read_blacklist, read_seed, read_terminals,
                      read_transactions, write_landing)

__all__ = ["fixtures", "landing", "landing_dates", "read_blacklist", "read_seed",
           "read_terminals", "read_transactions", "write_landing"]
