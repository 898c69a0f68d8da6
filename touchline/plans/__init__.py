"""Plan-level patterns shared by the operators: bounded top-n, top-k,
materialising a small reused intermediate."""

from touchline.plans.materialize import materialize
from touchline.plans.topn import rank_within, top_k, top_n_per_group

__all__ = ["materialize", "rank_within", "top_k", "top_n_per_group"]
