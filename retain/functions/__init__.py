from retain.functions.dates import month_index, month_label, month_start
from retain.functions.joins import join_dimension
from retain.functions.numeric import clip, money, round_half_even, sum_money
from retain.functions.quantiles import exact_quantiles
from retain.functions.rows import add_row, with_row

__all__ = [
    "add_row", "clip", "exact_quantiles", "join_dimension", "money", "month_index",
    "month_label", "month_start", "round_half_even", "sum_money", "with_row",
]
