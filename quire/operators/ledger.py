"""Calls that are paid for once: a ledger of replies by the content of the call.

A call's key is a hash of its parts and of the settings that its reply depends on. As soon as a call succeeds, its task writes
the reply under the key, first beside its place and then moved into it, so that a reader finds a whole entry or none.
A task that is run again asks the ledger before each call, so it repeats at most the calls that were open when it was lost. ``compact``
turns the entries into a table of runs; a later run takes replies from both by an anti-join before anything is called.

Failed calls are not entered: they are made again. Two tasks that make the same call at once (speculation) write the same key;
the later entry takes the place of the earlier one, and both have the same question.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import children, remove
from . import ocr

ENTRY = "call_key string, reply string, elapsed_time double, token_input long, token_output long"


def call_key(settings: str = "") -> F.Column:
    """Of a row's parts, and of what else decides the reply (the model's name, its temperature)."""
    return F.sha2(F.concat(F.lit(settings + "\n"), F.to_json("parts")), 256)


def recorder(path: str) -> Callable:
    """Made in a task: ``remember(key, ask)`` answers from the entries, or asks and enters a reply."""

    def make() -> Callable:
        files, root = fs.FileSystem.from_uri(path)

        def remember(key: str, ask: Callable[[], tuple]) -> tuple:
            place = f"{root}/{key}.json"
            if files.get_file_info(place).type == fs.FileType.File:
                with files.open_input_stream(place) as f:
                    e = json.loads(f.read())
                return e["reply"], None, e["elapsed_time"], e["token_input"], e["token_output"]
            reply, error, elapsed, n_in, n_out = ask()
            if error is None:
                entry = {"call_key": key, "reply": reply, "elapsed_time": elapsed, "token_input": n_in, "token_output": n_out}
                files.create_dir(root, recursive=True)
                beside = f"{root}/.{uuid.uuid4().hex}"
                with files.open_output_stream(beside) as f:
                    f.write(json.dumps(entry).encode())
                files.move(beside, place)
            return reply, error, elapsed, n_in, n_out

        return remember

    return make


class Ledger:
    """In ``path``, a folder that the driver and all executors share: ``open/`` has an entry a call, ``done/`` the compacted ones."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def known(self) -> DataFrame:
        """call_key, reply, elapsed_time, token_input, token_output of every call that succeeded, once."""
        there = children(self.spark, self.path)
        rows = [self.spark.read.schema(ENTRY).parquet(f"{self.path}/done")] if "done" in there else []
        rows += [self._entries(n) for n in there if n == "open" or n.startswith("moving-")]
        if not rows:
            return self.spark.createDataFrame([], ENTRY)
        return reduce(DataFrame.unionByName, rows).dropDuplicates(["call_key"])

    def _entries(self, name: str) -> DataFrame:
        return self.spark.read.schema(ENTRY).option("pathGlobFilter", "*.json").json(f"{self.path}/{name}")

    def call(self, batches: DataFrame, make: Callable[[], ocr.OcrClient], settings: str = "", **options) -> DataFrame:
        """As ``ocr.call``, with ``cached``: whether the reply was known before. Equal calls within the batches are made once.

        Write the result once and read that: the reply of an equal call goes to all who asked by a join on the key.
        """
        keyed = batches.withColumn("call_key", call_key(settings))
        known = self.known()
        fresh = keyed.join(known.select("call_key"), "call_key", "left_anti").dropDuplicates(["call_key"])
        made = ocr.call(fresh, make, record=recorder(f"{self.path}/open"), **options)
        usage = ["reply", "error", "elapsed_time", "token_input", "token_output"]
        answers = known.withColumn("error", F.lit(None).cast("string")).select("call_key", *usage, F.lit(True).alias("cached")).unionByName(made.select("call_key", *usage, F.lit(False).alias("cached")))
        return keyed.drop("parts").join(answers, "call_key").select("doc_id", "batch_no", "ids", *usage, "cached", "call_key")

    def compact(self) -> None:
        """Moves the entries into the table. Stopped at any point it loses none: they are set aside, go once the table has them, and count once if both have them."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        there = children(self.spark, self.path)
        if "open" in there:
            aside = f"moving-{uuid.uuid4().hex}"
            path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).rename(path(f"{self.path}/open"), path(f"{self.path}/{aside}"))
            there.append(aside)
        for name in [n for n in there if n.startswith("moving-")]:
            self._entries(name).write.mode("append").parquet(f"{self.path}/done")
            remove(self.spark, f"{self.path}/{name}")
