"""A raw text feed landed by one scan (A1, A8, B1): every line is read, split,
guarded and tagged with its outcome once; one partitioned write keeps them all,
and each output reads its own partitions.

Outcomes: ``good`` (every guard passes), ``flawed`` (the right width, but a
guard fails) and ``bad_line`` (any other width).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIELD_SEP
from ..operators.guards import FAILED, failed_guards
from ..session import stage
from .text import LAYOUTS, read_delimited, read_lines, split_fields

OUTCOME = "outcome"
GOOD, FLAWED, BAD_LINE = "good", "flawed", "bad_line"


def tag_lines(lines: DataFrame, name: str, sep: str = FIELD_SEP) -> DataFrame:
    """Lines as rows of the feed's fields with their outcome and failed guards;
    a line of the wrong width has no fields but its text in ``value``."""
    columns = LAYOUTS[name].columns()
    parts = lines.select("value", split_fields(lines, sep).alias("__f"))
    parts = parts.withColumn("__ok", F.size("__f") == len(columns))
    fields = parts.select(
        F.when(~F.col("__ok"), F.col("value")).alias("value"), "__ok",
        *(F.when(F.col("__ok"), F.get("__f", F.lit(i))).alias(c) for i, c in enumerate(columns)))
    fields = fields.withColumn(FAILED, F.when(F.col("__ok"), failed_guards(fields, name)))
    outcome = F.when(~F.col("__ok"), BAD_LINE).when(F.size(FAILED) > 0, FLAWED).otherwise(GOOD)
    return fields.select("value", *columns, FAILED, outcome.alias(OUTCOME))


class Landing:
    """A landed feed; its outcomes are partitions of one table."""

    def __init__(self, table: DataFrame, name: str):
        self.table, self.name = table, name

    @property
    def feed(self) -> DataFrame:
        """Every line of the right width, whatever guards it fails."""
        return self.table.filter(F.col(OUTCOME).isin(GOOD, FLAWED)).select(*LAYOUTS[self.name].columns())

    @property
    def good(self) -> DataFrame:
        """The lines that pass every guard."""
        return self.table.filter(F.col(OUTCOME) == GOOD).select(*LAYOUTS[self.name].columns())

    @property
    def rejects(self) -> DataFrame:
        """One record per row that fails a guard, with the list of them."""
        return self.table.filter(F.col(OUTCOME) == FLAWED).select(*LAYOUTS[self.name].columns(), FAILED)

    @property
    def bad_lines(self) -> DataFrame:
        return self.table.filter(F.col(OUTCOME) == BAD_LINE).select("value")


def land_lines(lines: DataFrame, name: str, sep: str = FIELD_SEP) -> Landing:
    """Land lines (column ``value``) of the feed ``name`` in the shared folder."""
    return Landing(stage(tag_lines(lines, name, sep), f"feed-{name}", partition_by=OUTCOME), name)


class TextFeeds(Mapping):
    """Raw feeds by name, each landed when it is first asked for and only then,
    so that every file is scanned at most once for all outputs."""

    def __init__(self, spark: SparkSession, paths: Mapping[str, str | Sequence[str]], sep: str = FIELD_SEP):
        self.spark, self.paths, self.sep = spark, dict(paths), sep
        self._landed: dict[str, Landing] = {}

    def __getitem__(self, name: str) -> Landing:
        if name not in self._landed:
            self._landed[name] = land_lines(read_lines(self.spark, self.paths[name]), name, self.sep)
        return self._landed[name]

    def bad_lines(self, name: str) -> DataFrame:
        """Lines of the wrong width: from the landed table if there is one,
        else by a scan that keeps nothing else."""
        if name in self._landed:
            return self._landed[name].bad_lines
        return read_delimited(self.spark, self.paths[name], LAYOUTS[name], self.sep)[1]

    def __iter__(self) -> Iterator[str]:
        return iter(self.paths)

    def __len__(self) -> int:
        return len(self.paths)
