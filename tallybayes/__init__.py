"""tallybayes: categorical Naive Bayes as Spark DataFrame plans.

Train with one counting aggregate, keep the model as DataFrames, score with a
broadcast model (or a join for large vocabularies), evaluate with aggregates.
"""

from tallybayes.operators import *  # noqa: F401,F403
from tallybayes.operators import __all__ as _ops
from tallybayes.sources import DatasetSpec

__all__ = [*_ops, "DatasetSpec"]
