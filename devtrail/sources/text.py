"""Delimited text at the edges (A1-A7): positional Ctrl-A feeds in, text or
Parquet out.

Inside the engine everything is typed and NULL means absent; the in-band
markers (``\\N`` for an absent joined column, ``NA`` for "not applicable")
exist only in rendered text.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIELD_SEP, NA_MARKER, NULL_MARKER


@dataclass(frozen=True)
class Layout:
    """A positional text feed: ``width`` fields, some of them named.
    Unnamed positions are opaque payload ``cNN``."""

    width: int
    names: Mapping[int, str] = field(default_factory=dict)

    def columns(self) -> list[str]:
        return [self.names.get(i, f"c{i:02d}") for i in range(self.width)]


# --- fixed values: positions of the fields the jobs read in each raw feed ---
LAYOUTS = {
    "shipment_orig": Layout(29, {3: "model", 4: "mfg_date", 9: "imei", 11: "shipment_date"}),
    "sdac_orig": Layout(7, {1: "imei", 4: "create_date"}),
    "uss_device": Layout(13, {3: "imei", 4: "imsi", 7: "model", 9: "first_ts", 10: "last_ts"}),
    "repair_orig": Layout(37, {0: "data_source", 4: "imei", 13: "claim_date", 14: "purchase_date", 27: "warranty_period"}),
    "shipment_model": Layout(2, {0: "imei", 1: "model"}),
    "exchange": Layout(6, {0: "uid", 1: "uidtype", 2: "imei", 3: "toimei", 4: "eventtype", 5: "eventdate"}),
    # derived tables written by the jobs (positions after the raw fields)
    "activation": Layout(4, {0: "imei", 1: "activation_date", 2: "first_checkin_date", 3: "checkin_count"}),
}
# --- end of fixed values ---


def _extend(base: Layout, extra: Mapping[int, str]) -> Layout:
    return Layout(base.width + len(extra), {**base.names, **extra})


def _prefixed(layout: Layout, prefix: str, offset: int) -> dict[int, str]:
    return {offset + i: prefix + c for i, c in enumerate(layout.columns())}


# shipment = raw shipment + two model dates; sdac = raw sdac + model date;
# repair = raw repair + two tags; new_shipment = shipment + sdac_* + act_* + launch date
LAYOUTS["shipment"] = _extend(LAYOUTS["shipment_orig"], {29: "first_mfg_date", 30: "first_shipment_date"})
LAYOUTS["sdac"] = _extend(LAYOUTS["sdac_orig"], {7: "first_sdac_date"})
LAYOUTS["repair"] = _extend(LAYOUTS["repair_orig"], {37: "failure_count", 38: "is_real_in_warranty"})
LAYOUTS["new_shipment"] = Layout(
    44,
    {
        **dict(enumerate(LAYOUTS["shipment"].columns())),
        **_prefixed(LAYOUTS["sdac"], "sdac_", 31),
        **_prefixed(LAYOUTS["activation"], "act_", 39),
        43: "first_launch_date",
    },
)

# The event tables share positions: header, new_shipment, xchg_*, rep_*, to_*.
# An event type fills a prefix of them; every table has them all by name.
LAYOUTS["timeline"] = Layout(
    135,
    {
        0: "eventtype",
        1: "eventdate",
        **_prefixed(LAYOUTS["new_shipment"], "", 2),
        **_prefixed(LAYOUTS["exchange"], "xchg_", 46),
        **_prefixed(LAYOUTS["repair"], "rep_", 52),
        **_prefixed(LAYOUTS["new_shipment"], "to_", 91),
    },
)
EVENT_WIDTHS = {"shipment": 46, "repair": 91, "move": 135}
OTHER_EVENT_WIDTH = 52  # cabandon, dabandon, swap
#: Field counts that a line of each event type may have when it is read.
READ_WIDTHS = {**{t: (n,) for t, n in EVENT_WIDTHS.items()}, **{t: (OTHER_EVENT_WIDTH,) for t in ("cabandon", "dabandon", "swap")}}
for _name, _width in (("new_shipment_events", 46), ("new_complex", 52), ("new_repair", 91), ("new_move", 135)):
    LAYOUTS[_name] = Layout(_width, dict(enumerate(LAYOUTS["timeline"].columns()[:_width])))


def event_width(eventtype: Column) -> Column:
    """Fields of a text line of each event type."""
    w = F.lit(OTHER_EVENT_WIDTH)
    for name, n in EVENT_WIDTHS.items():
        w = F.when(eventtype == name, F.lit(n)).otherwise(w)
    return w


def place_events(df: DataFrame, payload: Mapping[str, str] | None = None) -> DataFrame:
    """An event table in the constant positions of the timeline, whichever
    tables are written beside it.  ``payload`` names the columns that fill
    opaque positions (typed feeds); a column without a place is an error.  An
    opaque position of a group that the table has is empty, a group that it
    does not have is absent (NULL)."""
    have, names = set(df.columns), dict(payload or {})
    positions = LAYOUTS["timeline"].columns()
    source = {p: names.get(p, p) for p in positions}
    lost = have - set(source.values())
    if lost:
        raise ValueError(f"no position in the event layout for {sorted(lost)}")
    groups = ("xchg_", "rep_", "to_")
    group = lambda c: next((g for g in groups if c.startswith(g)), "")
    present = {group(c) for c in have}
    return df.select(*(
        (F.col(source[p]) if source[p] in have else F.lit("") if group(p) in present else F.lit(None).cast("string")).alias(p)
        for p in positions
    ))


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """A3: raw lines (column ``value``), one or several paths (A2)."""
    ps = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.text(ps)


def split_fields(lines: DataFrame, sep: str = FIELD_SEP) -> Column:
    """Fields of ``value``; trailing empty fields are kept (limit -1)."""
    return F.split(F.col("value"), re.escape(sep), -1)


def _apart(value: Column, cheap: Column) -> Column:
    """``value``, in a projection that Spark compiles by itself.  Within the code
    of a whole stage a projection of a hundred fields is one method, too long for
    the JVM to compile; alone it is split into short ones.  What keeps it alone is
    a higher-order function, here over one ``cheap`` value and always true."""
    return F.when(F.forall(F.array(cheap.isNull()), lambda x: x.isNotNull()), value)


def _fields(parts: DataFrame, names: Sequence[str], absent: Sequence[str]) -> DataFrame:
    """The fields ``__f`` by name, markers of absence as NULL.  Only the fields
    that are asked for are looked at."""
    at = [F.get("__f", F.lit(i)) for i in range(len(names))]
    known = [F.when(~x.isin(*absent), x) for x in at] if absent else at
    return parts.select(*(x.alias(c) for x, c in zip(known, names)))


def _split_once(lines: DataFrame, sep: str) -> DataFrame:
    """Lines with their fields ``__f``.  A filter on the fields stays behind this
    projection, else it would split each line a second time: the optimizer moves
    none past a column that counts rows, as this one does to no effect."""
    return lines.select("value", F.when(F.monotonically_increasing_id() >= 0, split_fields(lines, sep)).alias("__f"))


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    layout: Layout | Sequence[str],
    sep: str = FIELD_SEP,
    absent: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """A1/A2/B1: scan delimited lines into string columns named by position;
    fields that are one of ``absent`` become NULL.

    Lines with exactly ``layout.width`` fields are ``good``; all others go to
    ``rejects`` (column ``value``) instead of aborting the job.  The CSV reader
    is not used: its quoting and short-row filling would defeat the width
    guard."""
    cols = layout.columns() if isinstance(layout, Layout) else list(layout)
    lines = read_lines(spark, paths)
    parts, ok = _split_once(lines, sep), F.size("__f") == len(cols)
    return _fields(parts.filter(ok), cols, absent), parts.filter(~ok).select("value")


def read_ragged(
    spark: SparkSession,
    paths: str | Sequence[str],
    layout: Layout,
    widths: Mapping[str, Sequence[int]],
    sep: str = FIELD_SEP,
    absent: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """A3/A5: scan lines of several widths into the columns of ``layout``.  A
    line's first field names its kind, and ``widths`` the field counts that a
    line of that kind may have; the fields beyond its end, and those that are
    one of ``absent``, are NULL.
    Lines of an unknown kind or another width go to ``rejects`` (column
    ``value``)."""
    longest = max(n for ns in widths.values() for n in ns)
    if longest > layout.width:
        raise ValueError(f"a line of {longest} fields does not fit a layout of {layout.width}")
    lines = read_lines(spark, paths)
    parts = _split_once(lines, sep)
    kind, n = F.get("__f", F.lit(0)), F.size("__f")
    ok = F.lit(False)
    for width in sorted({n for ns in widths.values() for n in ns}):
        ok = ok | ((n == width) & kind.isin([k for k, ns in widths.items() if width in ns]))
    return _fields(parts.filter(ok), layout.columns(), absent), parts.filter(~ok).select("value")


def _texts(df: DataFrame, null_markers: Mapping[str, str | Column]) -> list[Column]:
    """Each column as text, NULL as its own marker if it has one."""
    out = []
    for name, dtype in df.dtypes:
        c = F.col(name)
        if dtype == "date":
            text = c.cast("string")
        else:
            text = F.array_join(c, ",") if dtype.startswith("array") else c.cast("string")
        m = null_markers.get(name)
        if m is not None:
            text = F.coalesce(text, m if isinstance(m, Column) else F.lit(m))
        out.append(text.alias(name))
    return out


def render(
    df: DataFrame,
    null_markers: Mapping[str, str | Column] | None = None,
    default_marker: str = NULL_MARKER,
) -> list[Column]:
    """A5: each column as text -- dates ``yyyy-MM-dd``, lists joined by commas,
    NULL as its marker (``null_markers[col]``, a literal or a per-row Column,
    else ``default_marker``)."""
    return [F.coalesce(c, F.lit(default_marker)).alias(name) for name, c in zip(df.columns, _texts(df, null_markers or {}))]


def to_lines(
    df: DataFrame,
    sep: str = FIELD_SEP,
    null_markers: Mapping[str, str | Column] | None = None,
    ragged_width: Column | None = None,
) -> DataFrame:
    """Render rows as one ``value`` text column.  With ``ragged_width`` only
    the first that-many fields are written (A5 ragged timeline).

    The default marker is set as the fields are joined, not field by field, and
    the projection is kept apart from the code of the join before it."""
    fields = F.array(*_texts(df, null_markers or {}))
    if ragged_width is not None:
        fields = F.slice(fields, F.lit(1), ragged_width)
    return df.select(_apart(F.array_join(fields, sep, NULL_MARKER), F.col(df.columns[0])).alias("value"))


def _sized(df: DataFrame, num_files: int | None, rows_per_file: int | None) -> tuple[DataFrame, dict[str, int]]:
    """G1: ``df`` dealt for its files, and the writer's options."""
    if num_files and rows_per_file:
        raise ValueError("either a number of files or rows per file")
    if rows_per_file:
        return df.hint("rebalance"), {"maxRecordsPerFile": rows_per_file}
    return (df.repartition(num_files) if num_files else df), {}


def write_delimited(
    df: DataFrame,
    path: str,
    num_files: int | None = None,
    sep: str = FIELD_SEP,
    mode: str = "overwrite",
    null_markers: Mapping[str, str | Column] | None = None,
    ragged_width: Column | None = None,
    rows_per_file: int | None = None,
    compression: str | None = None,
) -> None:
    """Write text lines.  G1: ``num_files`` deals the rows to so many
    files; ``rows_per_file`` evens out the partitions of a skewed table (AQE
    splits large and merges small ones) and closes a file after so many rows;
    without either AQE sizes the partitions.  ``mode`` is ``overwrite`` (A6) or
    ``errorifexists`` (A7).  ``compression`` names a codec of the files, which
    readers tell by their ending; the lines are the same."""
    lines, options = _sized(to_lines(df, sep, null_markers, ragged_width), num_files, rows_per_file)
    lines.write.mode(mode).options(**options).text(path, compression=compression)


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", num_files: int | None = None, rows_per_file: int | None = None
) -> None:
    """Default sink: Parquet (typed, columnar); files as in ``write_delimited``."""
    df, options = _sized(df, num_files, rows_per_file)
    df.write.mode(mode).options(**options).parquet(path)


def union_text(
    spark: SparkSession,
    paths: Sequence[str],
    out: str,
    mode: str = "overwrite",
    num_files: int | None = None,
    ordered: bool = True,
    compression: str | None = None,
) -> None:
    """F1/P10 on text: the lines of several tables, as they are, into one; no
    field is split or parsed, and every byte but the line breaks between lines
    is kept.

    ``ordered`` keeps the tables in their order, and each one's files and lines
    in theirs, over the files that are written: rows are dealt by ranges of
    (table, file, place) and sorted.  Without it nothing is shuffled unless
    ``num_files`` asks for it.  ``compression`` is the codec of the files written."""
    place = ["__table", "__file", "__block", "__line"]
    lines = None
    for i, path in enumerate(paths):
        table = spark.read.option("lineSep", "\n").text(path).select(
            "value", F.lit(i).alias("__table"), F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
            F.monotonically_increasing_id().alias("__line"))  # rises within a block
        lines = table if lines is None else lines.unionByName(table)
    if ordered:
        lines = lines.repartitionByRange(num_files, *place) if num_files else lines.repartitionByRange(*place)
        lines = lines.sortWithinPartitions(*place)
    elif num_files:
        lines = lines.repartition(num_files)
    lines.select("value").write.mode(mode).option("lineSep", "\n").text(out, compression=compression)


def file_rows(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """(file, n): rows of each file of a written table."""
    rows = spark.read.format(fmt).load(path).select(F.col("_metadata.file_path").alias("file"))
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))


# Column kinds of the derived text tables (everything else stays text).
_INT_COLUMNS = ("warranty_period",)
_BIGINT_COLUMNS = ("checkin_count", "act_checkin_count")
_MARKERS = (NULL_MARKER, NA_MARKER)


def read_table(spark: SparkSession, paths: str | Sequence[str], name: str, sep: str = FIELD_SEP) -> tuple[DataFrame, DataFrame]:
    """Scan a text table written by the jobs (``shipment``, ``sdac``,
    ``activation``, ``repair``, ``new_shipment``, ``exchange`` or one of the
    event tables) back into
    typed columns: the ``\\N``/``NA`` markers become NULL, ``*date`` columns
    are guarded dates (B2), counts and periods numbers.  Keys stay text.  Lines
    of the ``timeline`` have the width of their event type, and the fields
    beyond it are NULL.  Returns ``(table, rejects)`` like ``read_delimited``."""
    from ..functions.dates import valid_date

    if name == "timeline":
        good, rejects = read_ragged(spark, paths, LAYOUTS[name], READ_WIDTHS, sep, _MARKERS)
    else:
        good, rejects = read_delimited(spark, paths, LAYOUTS[name], sep, _MARKERS)
    dates = [c for c in good.columns if c.endswith("date")]
    if dates:  # parsed as one array: field by field they are more code than the JVM compiles
        good = good.withColumn("__dates", F.transform(F.array(*dates), lambda x: valid_date(x)))
    cols = []
    for c in good.columns:
        if c == "__dates":
            continue
        v = F.col(c)
        if c in dates:
            v = F.get("__dates", F.lit(dates.index(c)))
        elif c.removeprefix("rep_") in _INT_COLUMNS:
            v = v.try_cast("int")
        elif c.removeprefix("to_") in _BIGINT_COLUMNS:
            v = v.try_cast("bigint")
        cols.append(v.alias(c))
    return good.select(cols), rejects
