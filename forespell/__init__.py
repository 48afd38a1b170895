"""Weighted prefix completion on Spark.

A dictionary is a DataFrame ``text, weight``; a query table is ``qid, q, k``.
"""

from forespell.operators import *  # noqa: F403
from forespell.operators import __all__ as _operators
from forespell.plans import *  # noqa: F403
from forespell.plans import __all__ as _plans
from forespell.sources import *  # noqa: F403
from forespell.sources import __all__ as _sources
from forespell.streaming import *  # noqa: F403
from forespell.streaming import __all__ as _streaming

__all__ = [*_operators, *_plans, *_sources, *_streaming]
