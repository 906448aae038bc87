"""The audit over a file stream equals the batch audit."""

import tempfile

from pyspark.sql import functions as F

from recordcheck import constants as K
from recordcheck.plans.audit import Audit
from recordcheck.sources.delimited import write_delimited
from recordcheck.streaming import start_audit_stream


def test_stream_summary_equals_batch(spark, party_small):
    base = tempfile.mkdtemp(prefix="rc-stream-")
    # two landed files
    write_delimited(party_small.filter("k < 700"), f"{base}/in/a", mode="overwrite")
    write_delimited(party_small.filter("k >= 700"), f"{base}/in/b", mode="overwrite")
    q = start_audit_stream(spark, f"{base}/in/*", f"{base}/out", f"{base}/ckpt", available_now=True,
                           keys=("k",))
    q.awaitTermination(300)
    got = spark.read.parquet(f"{base}/out").withColumn("k", F.col("k").cast("long"))
    want = Audit(party_small, keys=("k",)).summary()
    assert got.count() == 1500
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
