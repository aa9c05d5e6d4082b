"""Customer lifetime value and churn on Spark.

A change-captured order ledger becomes clean order values, order values become
purchase histories, fitted buy-till-you-die models score every customer, and
the scored base is segmented.  Every step is a function from DataFrame to
DataFrame; the jobs in ``clientele.plans.jobs`` put them together.
"""

import sys

from pyspark import cloudpickle

from clientele.config import ScoringConfig
from clientele.session import configure

__all__ = ["ScoringConfig", "configure"]

# Arrow functions travel with their helpers, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
