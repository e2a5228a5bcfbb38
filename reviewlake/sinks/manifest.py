"""Committed steps: a job's parts that a rerun reads back instead of running again.

A step writes its results below its own folder and then commits a manifest
there, by renaming a finished file: a step is either committed whole or runs
again. The key in the manifest is a fingerprint of what the step was made from,
so results of other inputs or parameters are never read back. Folders lie in
shared storage: a new driver goes on where a lost one stopped.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from reviewlake.sinks.tables import _fs

MANIFEST = "manifest.json"


def fingerprint(spark: SparkSession, paths: list[str], **params) -> str:
    """Hex digest of all files below ``paths`` (name, length, time of change) and of ``params``.

    Reads file listings only. A table that is rewritten in place gets another
    fingerprint, as long as a file's name, length or time differs.
    """
    seen = []
    for path in paths:
        fs, p, _ = _fs(spark, path)
        files = fs.listFiles(p, True)
        while files.hasNext():
            st = files.next()
            seen.append([st.getPath().toString(), st.getLen(), st.getModificationTime()])
    return hashlib.sha256(json.dumps([sorted(seen), params], sort_keys=True, default=str).encode()).hexdigest()[:32]


def committed(spark: SparkSession, folder: str, key: str | None = None) -> dict | None:
    """The record committed in ``folder`` under ``key`` (any, if None), else None."""
    fs, p, jvm = _fs(spark, f"{folder.rstrip('/')}/{MANIFEST}")
    if not fs.exists(p):
        return None
    found = json.loads(spark.read.option("wholetext", True).text(p.toString()).first()[0])
    return found["record"] if key is None or found["key"] == key else None


def commit(spark: SparkSession, folder: str, record: dict, key: str = "") -> dict:
    """Make ``record`` the folder's manifest; an older one is replaced."""
    fs, final, jvm = _fs(spark, f"{folder.rstrip('/')}/{MANIFEST}")
    draft = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_{uuid.uuid4().hex}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps({"key": key, "record": record}).encode()))
    finally:
        out.close()
    if fs.exists(final):
        fs.delete(final, False)
    if not fs.rename(draft, final):
        raise OSError(f"could not commit {final}")
    return record


def step(spark: SparkSession, folder: str, key: str, run: Callable[[], dict]) -> dict:
    """The committed record of this step, or ``run()``'s, committed once it has returned.

    ``run`` writes below ``folder`` with overwrite and returns a JSON record; a
    run that dies leaves no manifest, so the next one starts the step anew.
    """
    done = committed(spark, folder, key)
    return done if done is not None else commit(spark, folder, run(), key)
