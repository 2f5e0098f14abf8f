"""A data folder whose papers and caches change together: what counts is named by one small file.

commits/<number>.json names the parts of each cache and, while papers are being replaced, the folder of the new ones. A commit
is written under another name and renamed, so it is there whole or not at all, and of two writers of one number the
second fails. The steps of a change are: write new parts beside the old ones, commit, then bring the papers' folder up
to date. A run that ends between any two of them leaves either the state before or one that the next run completes;
papers() shows the new state from the commit on.

A cache is merged on read. Each change adds a part with the rows of that change alone, so what is written follows the
change and not the cache; of several rows of a key the newest part's counts. Parts of like size are merged (the older
under twice the newer), so a row is rewritten a number of times logarithmic in the number of changes, and reading meets
few parts.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.schemas import PAPER
from quire.plans import publish
from quire.sources import files

KEPT = 3  # commits whose parts stay, for those who still read them
NUMBER = r"/p-(\d+)-[0-9a-f]+/"


class Conflict(Exception):
    """Another run has published in the meantime."""


class Publication:
    """The published state of a data folder. A cache of the earlier form (folders v1, v2 ...) is its oldest part."""

    def __init__(self, spark: SparkSession, data: str):
        self.spark, self.data = spark, data.rstrip("/")
        self.state = self._read(self._commits()[-1]) if self._commits() else {"number": 0, "caches": {}, "staged": None, "queues": {}}

    def _commits(self) -> list[str]:
        return [n for n in files.names(self.spark, f"{self.data}/commits") if n.endswith(".json") and n[0] != "."]

    def _read(self, name: str) -> dict:
        return json.loads(self.spark.read.option("wholetext", True).text(f"{self.data}/commits/{name}").first()[0])

    def _commit(self, **change) -> None:  # noqa: ANN003
        state = self.state | change | {"number": self.state["number"] + 1}
        if not files.write_new(self.spark, f"{self.data}/commits/{state['number']:08d}.json", json.dumps(state, sort_keys=True)):
            raise Conflict(f"{self.data}: commit {state['number']} is there already")
        self.state = state

    # -- caches

    def parts(self, name: str) -> list[list]:
        """[folder, rows] of each part, oldest first."""
        return self.state["caches"].get(name, [])

    def _rows(self, name: str, parts: list[list], schema: str) -> DataFrame:
        paths = [f"{self.data}/{name}/{folder}" for folder, _ in parts]
        found = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        place = F.regexp_extract(F.col("_metadata.file_path"), NUMBER, 1).cast("long") if paths else F.lit(0)
        return found.withColumn("_place", place)

    def cache(self, name: str, schema: str, key: str = "doi_key") -> DataFrame:
        """One row a key: that of the newest part."""
        every = self._rows(name, self.parts(name), schema)
        if last := max(files.versions(self.spark, f"{self.data}/{name}"), default=0):
            every = every.unionByName(self.spark.read.schema(schema).parquet(f"{self.data}/{name}/v{last}").withColumn("_place", F.lit(-1)))
        return self._newest(every, key)

    @staticmethod
    def _newest(every: DataFrame, key: str) -> DataFrame:
        own = [c for c in every.columns if c != "_place"]
        return every.groupBy(key).agg(F.max_by(F.struct(*own), "_place").alias("_r")).select("_r.*")

    def answered(self, queue: str, unit: int) -> bool:
        """Whether the rows of that unit of a queue are in already."""
        return unit <= self.state["queues"].get(queue, -1)

    def _written(self, name: str, rows: DataFrame, number: int) -> list:
        folder = f"p-{number:08d}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(f"{self.data}/{name}/{folder}")
        return [folder, self.spark.read.parquet(f"{self.data}/{name}/{folder}").count()]

    def add(self, name: str, rows: DataFrame, queue: str | None = None, unit: int = 0, key: str = "doi_key") -> None:
        """A part of new rows (one a key), committed at once; queue and unit tell which requests it answers."""
        part = self._written(name, rows, self.state["number"] + 1)
        queues = self.state["queues"] | ({queue: unit} if queue else {})
        self._commit(caches=self.state["caches"] | {name: [*self.parts(name), *([part] if part[1] else [])]}, queues=queues)
        self.compact(name, rows.schema.simpleString()[len("struct<") : -1].replace(":", " "), key)

    def compact(self, name: str, schema: str, key: str = "doi_key") -> None:
        """Merges the newest parts while they are of like size."""
        while len(parts := self.parts(name)) > 1 and parts[-2][1] < 2 * parts[-1][1]:
            number = int(parts[-1][0].split("-")[1])
            merged = self._written(name, self._newest(self._rows(name, parts[-2:], schema), key), number)
            self._commit(caches=self.state["caches"] | {name: [*parts[:-2], merged]})

    # -- papers

    def papers(self) -> DataFrame:
        """The papers of the newest commit, whether or not their folder is up to date."""
        now = self.spark.read.schema(PAPER).parquet(f"{self.data}/papers")
        if not (staged := self.state["staged"]):
            return now
        fresh = self.spark.read.schema(PAPER).parquet(f"{self.data}/{staged['folder']}")
        return now.where(~F.col("jkey").isin(staged["journals"])).unionByName(fresh)

    def publish(self, papers: DataFrame, changed: DataFrame) -> None:
        """Replaces the papers of the journals in `changed` (jkey); the others' files stay as they are."""
        journals = sorted(r[0] for r in changed.select("jkey").distinct().collect())  # journals are a small dimension
        if journals:
            folder = f"staged/{self.state['number'] + 1:08d}-{uuid.uuid4().hex[:8]}"
            publish.write_papers(papers.where(F.col("jkey").isin(journals)), f"{self.data}/{folder}")
            self._commit(staged={"folder": folder, "journals": journals})
        self.settle()

    def settle(self) -> None:
        """Brings the papers' folder up to the commit, also for a run that ended before it could, and clears away what no
        recent commit names."""
        if staged := self.state["staged"]:
            publish.write_papers(self.spark.read.schema(PAPER).parquet(f"{self.data}/{staged['folder']}"), f"{self.data}/papers")
            self._commit(staged=None)
        recent = self._commits()[-KEPT:]
        named = {folder for n in recent for parts in self._read(n)["caches"].values() for folder, _ in parts}
        for name in self.state["caches"]:
            for folder in files.names(self.spark, f"{self.data}/{name}"):
                if folder.startswith("p-") and folder not in named:
                    files.remove(self.spark, f"{self.data}/{name}/{folder}")
        files.remove(self.spark, f"{self.data}/staged")
        for n in self._commits()[:-KEPT]:
            files.remove(self.spark, f"{self.data}/commits/{n}")
