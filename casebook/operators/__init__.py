"""Reusable DataFrame operators. Each returns a lazily planned DataFrame."""

from casebook.operators.ranking import (  # noqa: F401
    first_rows, dense_rank_by, rank_by, top_per_group, top_values, top_n)
from casebook.operators.shares import (  # noqa: F401
    with_total_share, percent_of_group, with_grand_total)
from casebook.operators.running import running_sum  # noqa: F401
