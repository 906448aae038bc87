"""recordcheck: declarative record data-quality audits on Spark DataFrames.

Rules on columns and between columns are evaluated in one projection into an
array of typed, graded observations per record; summaries, detail tables,
reports, views, totals and per-field profiles are derived from it with
built-in Spark functions.
"""

import sys

from pyspark import cloudpickle

from recordcheck.operators.evaluate import evaluate
from recordcheck.operators.summary import executive_summary, with_summary
from recordcheck.plans.audit import Audit
from recordcheck.plans.catalog_party import Catalog, party_catalog

__all__ = ["Audit", "Catalog", "evaluate", "executive_summary", "party_catalog", "with_summary"]

# Functions that run inside tasks travel with the job, so executors need numpy
# and pyarrow but no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
