"""Where intermediate tables go."""

import tempfile
import uuid
from functools import cache


@cache
def _local_folder():
    return tempfile.mkdtemp(prefix="urbanstats-")


def scratch_path(spark, name):
    """A new path in the shared folder that ``spark.checkpoint.dir`` names.

    Where that is unset, a local session gets a temporary folder; on a cluster it
    raises, as executors do not share one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/urbanstats/{uuid.uuid4().hex}/{name}"
