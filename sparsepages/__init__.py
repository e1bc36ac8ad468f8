"""Sparse, numbered collections of JSON records as Spark jobs."""

from sparsepages.functions import *  # noqa: F401,F403
from sparsepages.operators import *  # noqa: F401,F403
from sparsepages.plans import *  # noqa: F401,F403
from sparsepages.schema import MALFORMED, MISSING, NOT_FOUND, OK, RECORD, RESPONSES, SENTINEL  # noqa: F401
from sparsepages.sources import *  # noqa: F401,F403
