from mallflow.functions.calendar import PARTS, clock, date_keys, date_part, date_path, epoch_seconds
from mallflow.functions.grid import cell, snap

__all__ = ["PARTS", "cell", "clock", "date_keys", "date_part", "date_path", "epoch_seconds", "snap"]
