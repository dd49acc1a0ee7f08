"""Where intermediate tables go."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where that is unset, a local session gets its own until it ends."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="chatloom-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return "file://" + _own[0]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/chatloom-{name}-{uuid4().hex}"
