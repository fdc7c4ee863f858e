from .scalars import (FILE_DATE_FORMAT, FILE_DATE_PATTERN, amount, as_timestamp,
                      day_of, elapsed, epoch_second, file_date, file_tag, full_name,
                      open_end, prev_second, seconds, shift_days)

__all__ = ["FILE_DATE_FORMAT", "FILE_DATE_PATTERN", "amount", "as_timestamp", "day_of",
           "elapsed", "epoch_second", "file_date", "file_tag", "full_name", "open_end",
           "prev_second", "seconds", "shift_days"]
