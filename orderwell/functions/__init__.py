from orderwell.functions.dates import date_key, mixed_date
from orderwell.functions.money import half_up_mean, order_value
from orderwell.functions.text import blank_to_null, title_case

__all__ = [
    "blank_to_null",
    "date_key",
    "half_up_mean",
    "mixed_date",
    "order_value",
    "title_case",
]
