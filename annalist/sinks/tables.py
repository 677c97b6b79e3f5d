"""History tables on plain Parquet: a folder per commit, the rows in force in parts by key.

A key's hash gives its part. A commit writes the rows in force of the parts its
keys fall in (``is_current=true/part=k``) and the rows it closed
(``is_current=false``), then a manifest that says which commit holds each part. The
manifest's marker is the switch: without it nothing of a commit counts, so a job
that dies half-way changes nothing, and an earlier commit can still be read. What a
commit costs follows the parts it touches, not the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.sinks.files import child_names, claim, exists, marked, remove

MANIFEST = "_parts"
#: Parts of a table that is new; a table keeps the number it began with.
PARTS = 16
#: What identifies a row, by the columns a table has.
KEYS = (["source", "source_id"], ["source", "dict_type", "entry_id"], ["version_id"], ["source"])
#: The manifest's part number for folders with closed rows.
CLOSED = -1


class HistoryTable:
    """``keys`` decide the part of a row; all rows of a key are in one part."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str] | None = None, parts: int = PARTS):
        self.spark = spark
        self.path = path
        self.schema = schema
        self.columns = [field.split()[0] for field in schema.split(", ")]
        self.keys = keys or next(k for k in KEYS if set(k) <= set(self.columns))
        self.parts = parts

    def commits(self) -> list[int]:
        return marked(self.spark, self.path, f"{MANIFEST}/_SUCCESS")

    def _manifest(self, upto: int | None = None) -> tuple[dict[int, int], list[int]]:
        """The commit that holds each part (at most ``parts``), and the commits that closed rows."""
        commits = [n for n in self.commits() if upto is None or n <= upto]
        if not commits:
            return {}, []
        rows = self.spark.read.schema("part INT, commit INT, parts INT").parquet(f"{self.path}/commit={commits[-1]}/{MANIFEST}").collect()
        # The table's own number of parts rules, whatever this object was made with.
        self.parts = rows[0]["parts"]
        return {r["part"]: r["commit"] for r in rows if r["part"] >= 0 and r["commit"]}, sorted(r["commit"] for r in rows if r["part"] == CLOSED and r["commit"])

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(f"{self.schema}, part INT, commit INT").option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{f}" for f in folders])

    def part_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    def read(self, upto: int | None = None) -> DataFrame:
        """All versions, also as of an earlier commit."""
        held, closed = self._manifest(upto)
        folders = [f"commit={n}/is_current=true/part={part}" for part, n in held.items()] + [f"commit={n}/is_current=false" for n in closed]
        return self._rows(folders).select(*self.columns)

    def current(self, only: list[int] | None = None) -> DataFrame:
        """The rows in force, of all parts or some; reads nothing else."""
        held, _ = self._manifest()
        folders = [f"commit={n}/is_current=true/part={part}" for part, n in held.items() if only is None or part in only]
        return self._rows(folders).filter("is_current").select(*self.columns)

    def current_for(self, batch: DataFrame) -> DataFrame:
        """The rows in force of the parts that the keys of ``batch`` fall in: all that a merge of it needs."""
        self._manifest()
        return self.current([r[0] for r in batch.select(self.part_of()).distinct().collect()])

    def commit(self, merged: DataFrame, number: int | None = None) -> int:
        """Store the result of a merge as one new folder.

        ``merged`` holds the rows in force of whole parts, those of :meth:`current`
        or :meth:`current_for`, and the rows just closed. Parts without a row in it
        stay as they are.

        Without ``number`` the next free one is claimed by a marker file before
        anything is written, so of two writers that chose the same one fails. A caller that numbers its commits itself, as a
        stream does, may write over the remains of its own failed attempt.
        """
        held, closed = self._manifest()
        mode = "error" if number is None else "overwrite"
        if number is None:
            claimed = [int(name) for name in child_names(self.spark, f"{self.path}/_claims") if name.isdigit()]
            folders = [int(n.removeprefix("commit=")) for n in child_names(self.spark, self.path) if n.startswith("commit=")]
            number = max([*folders, *claimed], default=0) + 1
            if not claim(self.spark, f"{self.path}/_claims/{number}"):
                raise ValueError(f"commit {number} is being written by another job")
        elif number in self.commits():
            raise ValueError(f"commit {number} is already stored")
        folder = f"{self.path}/commit={number}"
        rows = merged.select(*self.columns, self.part_of().alias("part")).hint("rebalance", "is_current", "part")
        rows.write.mode(mode).partitionBy("is_current", "part").parquet(folder)
        written = {state: [int(n.removeprefix("part=")) for n in child_names(self.spark, f"{folder}/is_current={state}") if n.startswith("part=")] for state in ("true", "false")}
        held = {k: n for k, n in held.items() if k not in written["false"]} | {k: number for k in written["true"]}
        closed = [*closed, *([number] if written["false"] else [])]
        # One row without a commit keeps the number of parts of an empty table.
        lines = [(CLOSED, 0), *held.items(), *[(CLOSED, n) for n in closed]]
        manifest = self.spark.createDataFrame([(part, n, self.parts) for part, n in lines], "part INT, commit INT, parts INT")
        manifest.coalesce(1).write.mode(mode).parquet(f"{folder}/{MANIFEST}")
        return number

    def remove_replaced(self, keep: int = 1, dry_run: bool = True) -> list[str]:
        """Folders of parts that none of the newest ``keep`` commits reads; deleted if not a dry run.

        Commits before these can no longer be read. Closed rows are never removed.
        """
        commits = self.commits()
        needed = {(part, n) for upto in commits[-keep:] for part, n in self._manifest(upto)[0].items()}
        gone = []
        for n in commits:
            folder = f"{self.path}/commit={n}/is_current=true"
            if n > commits[-1] or not exists(self.spark, folder):
                continue
            parts = [int(name.removeprefix("part=")) for name in child_names(self.spark, folder) if name.startswith("part=")]
            gone += [f"{folder}/part={part}" for part in parts if (part, n) not in needed]
        if not dry_run:
            for folder in gone:
                remove(self.spark, folder)
        return gone
