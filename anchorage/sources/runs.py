"""Runs of several stored steps that a lost driver does not lose.

A run has a folder with its steps' data and a ledger, one small file per finished step. A
step's entry is put there at once, after its data is whole; so a run that starts again
under the same name and signature takes finished steps from the ledger and makes the rest.
"""

import hashlib
import json
import time
import uuid

from pyspark.sql import types as T

from anchorage.sources import sinks, stores


class Run:
    """``with Run(spark, "cohort", {"inputs": ...}) as run: a = run.step("a", lambda: ...)``

    ``signature`` is all that the steps depend on, as JSON values: another signature is another
    run. Leaving the block in order deletes the run's folder; an error or a lost driver leaves
    it, so that the next run of the name goes on from there. ``keep`` leaves it in any case.
    A step's data is only there until the run ends: write the result elsewhere before.
    """

    def __init__(self, spark, name, signature=None, root=None, keep=False):
        body = json.dumps([name, signature or {}], sort_keys=True)
        root = root or sinks.scratch_root(spark)
        self.spark, self.name, self.keep = spark, name, keep
        self.folder = f"{root.rstrip('/')}/run-{name}-{hashlib.sha256(body.encode()).hexdigest()[:16]}"
        self.made, self.reused = [], []

    def _entry(self, step):
        return f"{self.folder}/ledger/{step}.json"

    def finished(self):
        """Entries of the ledger by step."""
        names = stores.children(self.spark, f"{self.folder}/ledger", folders=False)
        names = [n for n in names if n.endswith(".json") and not n.startswith(".")]
        return {n[: -len(".json")]: json.loads(stores.read_text(self.spark, self._entry(n[: -len(".json")]))) for n in names}

    def step(self, name, make):
        """The stored frame of a step; ``make()`` gives it if the ledger has none."""
        found = stores.read_text(self.spark, self._entry(name))
        if found is None:
            df = make()
            path = sinks.write(df, f"{self.folder}/data/{name}-{uuid.uuid4().hex}")
            found = json.dumps({"path": path, "schema": df.schema.jsonValue(), "finished": time.time()})
            stores.put_text(self.spark, self._entry(name), found)
            self.made.append(name)
        else:
            self.reused.append(name)
        entry = json.loads(found)
        return self.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(entry["path"])

    def sweep(self):
        """Remove data that no ledger entry names: what steps that were cut off have left."""
        named = {e["path"].rsplit("/", 1)[-1] for e in self.finished().values()}
        for name in stores.children(self.spark, f"{self.folder}/data"):
            if name not in named:
                stores.delete(self.spark, f"{self.folder}/data/{name}")

    def __enter__(self):
        self.sweep()
        return self

    def __exit__(self, kind, error, trace):
        if kind is None and not self.keep:
            stores.delete(self.spark, self.folder)
