"""Stand-in feeds derived from the test tables (FIXTURES.md section 2).

Roles: device = ``part`` (imei = l_partkey), model = ``p_brand``, SIM =
``customer`` (imsi = o_custkey), SDAC device = ``events.user_id``.  The
builders only shape rows into the schemas the jobs expect -- dates stay
text so that the guards have work to do, and a few fields are blanked to
exercise absent dates.  They do none of the jobs' work.

Each view exists twice: as a DataFrame builder (``feeds``) and as DuckDB SQL
text (``VIEW_SQL``) for the oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = ("lineitem", "orders", "part", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day_text(ts: Column) -> Column:
    return F.to_date(ts).cast("string")


#: What the feeds ask of a line item besides its keys and its date.
OF_LINE: dict[str, Callable[[], Column]] = {
    "no_first": lambda: (F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "A"),
    "no_last": lambda: (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "A"),
    "no_mfg": lambda: (F.col("l_linenumber") == 2) & (F.col("l_linestatus") == "O"),
    "no_shipment": lambda: (F.col("l_linenumber") == 1) & (F.col("l_linestatus") == "O"),
    "claim": lambda: F.col("l_returnflag") == "R",
    "no_claim_date": lambda: (F.col("l_linenumber") == 3) & (F.col("l_linestatus") == "O"),
    "no_purchase": lambda: F.col("l_linenumber") % 2 == 0,
}
Asked = Callable[[str], Column]


def _of_line(name: str) -> Column:
    return OF_LINE[name]()


def _from_bits(name: str) -> Column:
    return F.col("l_asked").bitwiseAND(1 << list(OF_LINE).index(name)) != 0


def _joined(spark: SparkSession, sf_dir: str, li: DataFrame | None = None) -> DataFrame:
    li = table(spark, sf_dir, "lineitem") if li is None else li
    o = table(spark, sf_dir, "orders")
    p = table(spark, sf_dir, "part")
    return li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)


def uss_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check-in log: (imei, imsi, model, first_ts, last_ts) -- timestamps as text."""
    return _joined(spark, sf_dir).select(*_uss_columns())


def _uss_columns(asked: Asked = _of_line) -> list[Column]:
    lo_ts = F.least("o_orderdate", "l_shipdate").cast("string")
    hi_ts = F.greatest("o_orderdate", "l_shipdate").cast("string")
    return [
        F.col("l_partkey").alias("imei"),
        F.col("o_custkey").alias("imsi"),
        F.col("p_brand").alias("model"),
        F.when(asked("no_first"), F.lit("")).otherwise(lo_ts).alias("first_ts"),
        F.when(asked("no_last"), F.lit("")).otherwise(hi_ts).alias("last_ts"),
    ]


def shipment_orig(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factory shipments: (imei, model, mfg_date, shipment_date, order_id,
    plant_id, channel); every tenth part number is never shipped."""
    return _joined(spark, sf_dir).filter(_is_shipped()).select(*_shipment_columns())


def _is_shipped(asked: Asked = _of_line) -> Column:
    return F.col("l_partkey") % 10 != 0


def _shipment_columns(asked: Asked = _of_line) -> list[Column]:
    return [
        F.col("l_partkey").alias("imei"),
        F.col("p_brand").alias("model"),
        F.when(asked("no_mfg"), F.lit("")).otherwise(_day_text(F.col("o_orderdate"))).alias("mfg_date"),
        F.when(asked("no_shipment"), F.lit("")).otherwise(_day_text(F.col("l_shipdate"))).alias("shipment_date"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("plant_id"),
        F.col("o_orderpriority").alias("channel"),
    ]


def sdac_orig(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales-date activation records: (imei, event_id, create_date)."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    d = F.to_date("ts")
    uid3 = F.col("user_id") % 3
    create = (
        F.when(F.col("event_id") % 50 == 0, F.lit(""))
        .when(uid3 == 0, F.date_format(F.add_months(d, -264), "yyyy-MM-dd"))
        .when(uid3 == 1, F.date_format(F.add_months(d, -276), "yyyy-MM-dd"))
        .otherwise(F.date_format(F.add_months(d, -288), "yyyy-MM-dd"))
    )
    return e.select(F.col("user_id").alias("imei"), F.col("event_id"), create.alias("create_date"))


def repair_orig(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repair claims: (data_source, imei, claim_date, purchase_date,
    warranty_period, claim_id) -- period in months as text."""
    return _joined(spark, sf_dir).filter(_is_claim()).select(*_repair_columns())


def _is_claim(asked: Asked = _of_line) -> Column:
    return asked("claim")


def _repair_columns(asked: Asked = _of_line) -> list[Column]:
    return [
        F.concat(F.lit("SRC_"), (F.col("l_suppkey") % 8).cast("string")).alias("data_source"),
        F.col("l_partkey").alias("imei"),
        F.when(asked("no_claim_date"), F.lit(""))
        .otherwise(_day_text(F.col("l_shipdate"))).alias("claim_date"),
        F.when(asked("no_purchase"), F.lit("")).otherwise(_day_text(F.col("o_orderdate"))).alias("purchase_date"),
        (F.col("p_size") - 5).cast("string").alias("warranty_period"),
        F.col("l_orderkey").alias("claim_id"),
    ]


BUILDERS = {
    "uss_device": uss_device,
    "shipment_orig": shipment_orig,
    "sdac_orig": sdac_orig,
    "repair_orig": repair_orig,
}

#: The feeds that are rows of the same join: their column names, the columns and,
#: of those that do not take every row, the condition.
FROM_JOIN = {
    "uss_device": (("imei", "imsi", "model", "first_ts", "last_ts"), _uss_columns, None),
    "shipment_orig": (("imei", "model", "mfg_date", "shipment_date", "order_id", "plant_id", "channel"), _shipment_columns, _is_shipped),
    "repair_orig": (("data_source", "imei", "claim_date", "purchase_date", "warranty_period", "claim_id"), _repair_columns, _is_claim),
}


def joined_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the join with the columns of all feeds in ``FROM_JOIN``: a
    column ``in_<feed>`` tells the rows of a feed that does not take every row,
    and its own columns (imei and model are shared) are null in the others.

    Of a line item its keys, its date and a bit for each entry of ``OF_LINE`` go
    through the shuffles of the join."""
    li = table(spark, sf_dir, "lineitem")
    bits = reduce(Column.__add__, (F.when(c(), 1 << i).otherwise(0) for i, c in enumerate(OF_LINE.values())))
    li = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", bits.alias("l_asked"))
    out: dict[str, Column] = {}
    for feed, (names, columns, condition) in FROM_JOIN.items():
        if condition is not None:
            out[f"in_{feed}"] = condition(_from_bits)
        for n, c in zip(names, columns(_from_bits), strict=True):
            out.setdefault(n, c if condition is None else F.when(condition(_from_bits), c))
    return _joined(spark, sf_dir, li).select(*(c.alias(n) for n, c in out.items()))


def _feed_of(rows: DataFrame, name: str) -> DataFrame:
    names, _, condition = FROM_JOIN[name]
    return (rows if condition is None else rows.filter(f"in_{name}")).select(*names)


def feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All four stand-in feeds (lazy DataFrames)."""
    return {name: build(spark, sf_dir) for name, build in BUILDERS.items()}


#: Values that fail their guard, put into a feed where a condition on its keys
#: holds: field -> (condition, value), both read alike by Spark and DuckDB.
SPOILED = {
    "shipment_orig": {"mfg_date": ("order_id % 13 = 0", "'2014-02-31'"), "shipment_date": ("plant_id % 17 = 5", "'20X1-01-01'")},
    "sdac_orig": {"create_date": ("event_id % 9 = 0", "'1999-13-01'")},
    "uss_device": {
        "first_ts": ("imsi % 7 = 0 AND length(first_ts) > 10", "concat(substr(first_ts, 1, 5), '02-31', substr(first_ts, 11))"),
        "last_ts": ("imei % 11 = 3", "'not a timestamp'"),
    },
    "repair_orig": {"claim_date": ("imei % 19 = 4", "'0000-00-00'"), "purchase_date": ("claim_id % 8 = 1", "'n/a 2001-1'"),
                    "warranty_period": ("claim_id % 10 = 7", "'abc'")},
}


def spoil(feed: DataFrame, name: str) -> DataFrame:
    """A stand-in feed with impossible dates, for the guards."""
    put = SPOILED[name]
    return feed.select(*(F.expr(f"CASE WHEN {put[c][0]} THEN {put[c][1]} ELSE {c} END").alias(c) if c in put else F.col(c) for c in feed.columns))


_STORED: dict[tuple[str, str, str], tuple[str, StructType]] = {}
_WRITING: dict[tuple[str, str, str], Lock] = {}


def stored_feed(spark: SparkSession, sf_dir: str, name: str, among: bool = False) -> DataFrame:
    """The stand-in feed ``name`` as a Parquet table, written once per
    session and data folder to the shared checkpoint folder -- the jobs then
    scan a stored feed (with column pruning and filter pushdown) as they do in
    production, instead of re-deriving it from the test tables per consumer.
    Branches that are built side by side wait for the one that writes it.  The
    files are the partitions of the builder's join, not dealt anew.

    ``among`` is for a job that reads all feeds: those of ``FROM_JOIN`` that are
    not stored yet come from one table of the joined rows, so their join is
    shuffled and written once for all."""
    from ..session import session_id

    if among and name in FROM_JOIN and (session_id(spark), sf_dir.rstrip("/"), name) not in _STORED:
        return _feed_of(_stored(spark, sf_dir, "joined", joined_feeds), name)
    return _stored(spark, sf_dir, name, BUILDERS[name])


def _stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    from ..session import STAGED_CODEC, release, scratch_path, session_id

    key = (session_id(spark), sf_dir.rstrip("/"), name)
    with _WRITING.setdefault(key, Lock()):
        if key not in _STORED:
            path = scratch_path(spark, f"feed-{name}")
            df = build(spark, sf_dir)
            df.write.mode("errorifexists").parquet(path, compression=STAGED_CODEC)
            _STORED[key] = path, df.schema
            release(spark)  # the join's shuffles
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)


_J = (
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "JOIN part ON l_partkey = p_partkey"
)

# DuckDB text of the same four views (oracle side).
VIEW_SQL = {
    "uss_device": f"""
SELECT l_partkey AS imei, o_custkey AS imsi, p_brand AS model,
  CASE WHEN l_linenumber = 6 AND l_returnflag = 'A' THEN '' ELSE CAST(least(o_orderdate, l_shipdate) AS VARCHAR) END AS first_ts,
  CASE WHEN l_linenumber = 7 AND l_returnflag = 'A' THEN '' ELSE CAST(greatest(o_orderdate, l_shipdate) AS VARCHAR) END AS last_ts
{_J}""",
    "shipment_orig": f"""
SELECT l_partkey AS imei, p_brand AS model,
  CASE WHEN l_linenumber = 2 AND l_linestatus = 'O' THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS mfg_date,
  CASE WHEN l_linenumber = 1 AND l_linestatus = 'O' THEN '' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS shipment_date,
  l_orderkey AS order_id, l_suppkey AS plant_id, o_orderpriority AS channel
{_J} WHERE l_partkey % 10 <> 0""",
    "sdac_orig": """
SELECT user_id AS imei, event_id,
  CASE WHEN event_id % 50 = 0 THEN ''
       WHEN user_id % 3 = 0 THEN CAST(CAST(ts - INTERVAL 264 MONTH AS DATE) AS VARCHAR)
       WHEN user_id % 3 = 1 THEN CAST(CAST(ts - INTERVAL 276 MONTH AS DATE) AS VARCHAR)
       ELSE CAST(CAST(ts - INTERVAL 288 MONTH AS DATE) AS VARCHAR) END AS create_date
FROM events WHERE event_type = 'signup'""",
    "repair_orig": f"""
SELECT 'SRC_' || CAST(l_suppkey % 8 AS VARCHAR) AS data_source, l_partkey AS imei,
  CASE WHEN l_linenumber = 3 AND l_linestatus = 'O' THEN '' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS claim_date,
  CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS purchase_date,
  CAST(p_size - 5 AS VARCHAR) AS warranty_period, l_orderkey AS claim_id
{_J} WHERE l_returnflag = 'R'""",
}


def _spoiled_sql(name: str) -> str:
    put = ", ".join(f"CASE WHEN {when} THEN {value} ELSE {field} END AS {field}" for field, (when, value) in SPOILED[name].items())
    return f"SELECT * REPLACE ({put}) FROM {name}"


# The spoiled feeds, each over its view.
SPOILED_SQL = {f"{name}_spoiled": _spoiled_sql(name) for name in SPOILED}
