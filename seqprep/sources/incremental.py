"""Processed sets that follow their input files.

A manifest lists the input files (path, size, time, rows) a set was made from.
A later run lists the files again, encodes only the new and changed ones, and
drops the rows of those that are gone or changed; nothing else is read. Layout
below one folder:

* ``pieces/run=.../split=.../``: encoded rows with the key of their file;
* ``manifest/generation=.../``: one row per file, and one for the options. A
  generation counts once all of its rows are there, so a run that dies leaves
  the one before in force;
* ``vocabulary/``: the frozen vocabulary.

Rows of files that a generation does not list are not read; ``compact`` writes
the living rows anew and removes the rest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from seqprep.options import PrepOptions
from seqprep.session import remove_folder
from seqprep.sources.parallel import input_files

MANIFEST = "file string, path string, size long, modified timestamp, rows long, run string, options string, of long"

#: Options that change an encoded row; all others only choose among the rows.
ROW_OPTIONS = (
    "source_lang", "target_lang", "max_source_length", "max_target_length", "normalize", "padding", "tokenizer_name",
)


@dataclass(frozen=True)
class Changes:
    """What a run found: numbers of files."""

    kept: int
    encoded: int
    dropped: int


def row_options(opts: PrepOptions, vocabulary: str) -> str:
    """Everything but the input that an encoded row depends on."""
    return json.dumps({**{name: str(getattr(opts, name)) for name in ROW_OPTIONS}, "vocabulary": vocabulary}, sort_keys=True)


class IncrementalSet:
    """A processed set in ``folder`` that is brought up to date with ``update``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    # --- manifest ---------------------------------------------------------------

    def _generations(self) -> DataFrame:
        """Complete generations with their number; no row when there is none."""
        try:
            rows = self.spark.read.schema(f"{MANIFEST}, generation int").parquet(f"{self.folder}/manifest")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{MANIFEST}, generation int")
        whole = rows.groupBy("generation").agg(F.count("*").alias("n"), F.max("of").alias("of")).filter("n = of")
        return rows.join(whole.select("generation"), "generation", "left_semi")

    def generation(self) -> int:
        """The number of the last complete generation, 0 when there is none."""
        return self._generations().agg(F.coalesce(F.max("generation"), F.lit(0)).alias("g")).head()["g"]

    def manifest(self) -> DataFrame:
        """The files of the last complete generation."""
        return self._manifest(self.generation()).filter("file <> ''")

    def _manifest(self, generation: int) -> DataFrame:
        if not generation:
            return self.spark.createDataFrame([], MANIFEST)
        path = f"{self.folder}/manifest/generation={generation}"
        return self.spark.read.schema(MANIFEST).parquet(path)

    def _publish(self, files: DataFrame, options: str, generation: int) -> None:
        files = files.select("file", "path", "size", "modified", "rows", "run")
        note = self.spark.range(1).select(
            F.lit("").alias("file"), *[F.lit(None).cast(t).alias(c) for c, t in (("path", "string"), ("size", "long"), ("modified", "timestamp"))],
            F.lit(0).cast("long").alias("rows"), F.lit("").alias("run"),
        )
        rows = files.unionByName(note).withColumns({"options": F.lit(options), "of": F.lit(files.count() + 1).cast("long")})
        rows.write.mode("overwrite").parquet(f"{self.folder}/manifest/generation={generation}")

    # --- rows ---------------------------------------------------------------------

    def rows(self) -> DataFrame:
        """The encoded rows of the last complete generation."""
        living = self.manifest().filter("rows > 0").select("run", "file")
        pieces = self.spark.read.option("basePath", f"{self.folder}/pieces").parquet(*self._runs(living)) if not living.isEmpty() else None
        if pieces is None:
            raise ValueError(f"no rows in {self.folder}")
        return pieces.join(living, ["run", "file"], "left_semi").drop("run", "file")

    def _runs(self, living: DataFrame) -> list[str]:
        """Folders of the runs whose rows are still in use; one per update since the last compaction."""
        return [f"{self.folder}/pieces/run={r['run']}" for r in living.select("run").distinct().collect()]

    def update(self, path: str, encode: Callable[[Sequence[str] | None], DataFrame], options: str) -> Changes:
        """Follow the files below ``path``.

        ``encode`` gets the paths to read, or None for all, and returns encoded
        rows with a ``split`` and a ``file`` column. Other ``options`` than those
        of the last run make every file new.
        """
        last = self.generation()
        before = self._manifest(last).filter("file <> ''").filter(F.col("options") == options)
        old_files = self._manifest(last).filter("file <> ''")
        now = input_files(self.spark, path)
        kept = before.join(now.select("file"), "file", "left_semi")
        fresh = now.join(before.select("file"), "file", "left_anti")
        # Paths of the new files: Spark's own file index holds the same list on the driver.
        paths = [r["path"] for r in fresh.select("path").collect()]
        n_kept = kept.count()
        changes = Changes(n_kept, len(paths), old_files.count() - n_kept)
        known_options = self._manifest(last).filter(F.col("options") == options).isEmpty() is False
        if last and known_options and not paths and not changes.dropped:
            return changes
        run = uuid.uuid4().hex
        added = fresh.withColumns({"rows": F.lit(0).cast("long"), "run": F.lit(run)})
        if paths:
            piece = f"{self.folder}/pieces/run={run}"
            encode(paths if n_kept else None).write.partitionBy("split").parquet(piece)
            counts = self.spark.read.parquet(piece).groupBy("file").agg(F.count("*").alias("rows"))
            added = fresh.join(counts, "file", "left").withColumns({"rows": F.coalesce("rows", F.lit(0)), "run": F.lit(run)})
        columns = ["file", "path", "size", "modified", "rows", "run"]
        self._publish(kept.select(*columns).unionByName(added.select(*columns)), options, last + 1)
        return changes

    def compact(self) -> None:
        """Write the living rows as one run and remove everything else; no reader may be at work."""
        last = self.generation()
        manifest = self._manifest(last)
        note = manifest.filter("file = ''").head()
        if note is None:
            return
        run = uuid.uuid4().hex
        living = manifest.filter("rows > 0").select("run", "file")
        if not living.isEmpty():
            pieces = self.spark.read.option("basePath", f"{self.folder}/pieces").parquet(*self._runs(living))
            kept = pieces.join(living, ["run", "file"], "left_semi").drop("run")
            kept.write.partitionBy("split").parquet(f"{self.folder}/pieces/run={run}")
        self._publish(manifest.filter("file <> ''").withColumn("run", F.lit(run)), note["options"], last + 1)
        self._remove("pieces", f"run={run}")
        self._remove("manifest", f"generation={last + 1}")

    def _remove(self, kind: str, but: str) -> None:
        """Remove all sub-folders of a kind but one."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        top = hadoop(f"{self.folder}/{kind}")
        files = top.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        for status in files.listStatus(top) if files.exists(top) else ():
            if status.getPath().getName() != but:
                remove_folder(self.spark, status.getPath().toString())
