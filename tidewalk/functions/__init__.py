from tidewalk.functions.numeric import net_pct, net_ratio_pct, pct_change, ratio, round_f, skew_pct
from tidewalk.functions.stats import average_rank, is_near_constant, pearson

__all__ = [
    "average_rank", "is_near_constant", "net_pct", "net_ratio_pct", "pct_change", "pearson", "ratio",
    "round_f", "skew_pct",
]
