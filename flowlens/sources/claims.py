"""Claims on input files for batch runs (S3): each file is taken by one run.

The ledger is a folder that all runs share.  A run writes the files it wants
(a table of its own) and then commits a numbered manifest, if that number is
still free; when another run has taken it, its files are seen first and left
out.  So two runs at once share no file, without a lock.  How a run ends is one
more file, also written only if there is none: ``done`` (its files are consumed
for good), ``failed`` (they are free again), or ``expired``, which a later run
writes for one that has been silent longer than its lease.  A run that was
declared expired cannot finish: ``finish`` tells it so, and its output is not to
be kept.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import child_names, create_text, read_text

_FILES = "file string, modified timestamp, bytes long"


@dataclass
class Claim:
    """The files of one run, oldest first."""

    spark: SparkSession
    ledger: str
    run: str
    files: list[str]

    def _end(self, how: str) -> bool:
        return create_text(self.spark, f"{self.ledger}/ended/{self.run}", how)

    def finish(self) -> None:
        """Consumed for good; raises if the claim had expired."""
        if not self._end("done") and _ended(self.spark, self.ledger, self.run) != "done":
            raise TimeoutError(f"the claim of run {self.run} has expired; its files belong to another run")

    def release(self) -> None:
        """Free again."""
        self._end("failed")


def _ended(spark: SparkSession, ledger: str, run: str) -> str | None:
    return read_text(spark, f"{ledger}/ended/{run}") if run in child_names(spark, f"{ledger}/ended") else None


def _manifest(spark: SparkSession, path: str, patience: float = 10.0) -> dict | None:
    """A claim's manifest.  One that has no text yet is waited for, as its run
    may go on any moment; after ``patience`` seconds its run is taken to have
    died between the file's first and last byte."""
    until = time.time() + patience
    while True:
        try:
            return json.loads(read_text(spark, path))
        except ValueError:
            if time.time() > until:
                return None
            time.sleep(0.1)


def _held(spark: SparkSession, ledger: str, now_ms: int) -> tuple[int, list[str]]:
    """(the last manifest's number, runs whose files are taken): expired runs
    are declared so here."""
    numbers = sorted(int(n[:-5]) for n in child_names(spark, f"{ledger}/claims") if n.endswith(".json"))
    ended = set(child_names(spark, f"{ledger}/ended"))
    held = []
    for n in numbers:
        claim = _manifest(spark, f"{ledger}/claims/{n:020d}.json")
        if claim is None:
            continue
        run = claim["run"]
        if run not in ended and now_ms > claim["until_ms"]:
            create_text(spark, f"{ledger}/ended/{run}", "expired")
            ended.add(run)
        if run not in ended or _ended(spark, ledger, run) == "done":
            held.append(run)
    return numbers[-1] if numbers else 0, held


def claim_files(
    spark: SparkSession, input_dir: str, ledger: str, max_files: int = 10_000, lease_ms: int = 3_600_000, now_ms: int | None = None
) -> Claim:
    """Takes up to ``max_files`` of the input's ``*.parquet`` files that no run
    has consumed or holds (oldest first); names are all that reaches the driver."""
    run = uuid.uuid4().hex
    while True:
        now = int(time.time() * 1000) if now_ms is None else int(now_ms)
        last, held = _held(spark, ledger, now)
        listing = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true")
            .load(input_dir)
            .select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
        )
        if held:
            taken = spark.read.schema(_FILES).parquet(*[f"{ledger}/files/{r}" for r in held])
            listing = listing.join(taken.select("file", "modified", "bytes"), ["file", "modified", "bytes"], "left_anti")
        own = listing.orderBy("modified", "file").limit(int(max_files))
        own.write.mode("overwrite").parquet(f"{ledger}/files/{run}")
        text = json.dumps({"run": run, "until_ms": now + int(lease_ms)})
        if create_text(spark, f"{ledger}/claims/{last + 1:020d}.json", text):
            own = spark.read.schema(_FILES).parquet(f"{ledger}/files/{run}").orderBy("modified", "file")
            return Claim(spark, ledger, run, [r["file"] for r in own.select("file").collect()])


@contextmanager
def claimed_sessions(spark: SparkSession, input_dir: str, ledger: str, **options) -> Iterator[DataFrame]:
    """The records of the files this run has claimed.  Leaving the block
    consumes them, an error in it frees them."""
    from ..streaming.files import sessions_of

    claim = claim_files(spark, input_dir, ledger, **options)
    try:
        yield sessions_of(spark, claim.files)
    except BaseException:
        claim.release()
        raise
    claim.finish()
