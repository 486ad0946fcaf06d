"""Station dimensions from TOML, and the older CSV layouts they replace."""

from __future__ import annotations

import datetime as dt
import tomllib
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fixwatch.functions.gnss_time import period_bounds
from fixwatch.operators.truth import ANCHOR
from fixwatch.schemas import ASSIGNMENTS, JUMPS, OUT_OF_SERVICE, STATION_PERIODS


def _toml(path: str) -> dict:
    """Hand-kept configuration of one network (some 1,300 stations); a missing file is empty."""
    file = Path(path)
    return tomllib.loads(file.read_text(encoding="utf-8")) if file.is_file() else {}


def _date(value: dt.date | str | None) -> dt.date | None:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    rows = [
        (station, info.get("netid"), bool(info.get("isinside", False)))
        for station, info in _toml(path).get("stations", {}).items()
    ]
    return spark.createDataFrame(rows, ASSIGNMENTS)


def read_periods(spark: SparkSession, path: str) -> DataFrame:
    rows = [
        (
            station,
            [(_date(p.get("from")), _date(p.get("to")), p.get("fy_label"), p.get("netid")) for p in info.get("periods", [])],
        )
        for station, info in _toml(path).get("stations", {}).items()
    ]
    return spark.createDataFrame(rows, STATION_PERIODS)


def read_out_of_service(spark: SparkSession, path: str) -> DataFrame:
    rows = [
        (station, info.get("reason"), _date(info.get("since")), _date(info.get("until")))
        for station, info in _toml(path).get("stations", {}).items()
    ]
    return spark.createDataFrame(rows, OUT_OF_SERVICE)


def read_jumps(spark: SparkSession, path: str) -> DataFrame:
    rows = [
        (
            _date(j["date"]),
            j.get("fixed_station_id", ANCHOR),
            j.get("reason", ""),
            str(j["recorded_at"]) if "recorded_at" in j else None,
        )
        for j in _toml(path).get("jumps", [])
    ]
    return spark.createDataFrame(rows, JUMPS)


def _optional_int(column):
    text = F.trim(column)
    return F.when(F.lower(text) != "nan", text).try_cast("double").cast("int")


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(file, value) of hand-kept files of a station-year or a network, small by definition."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")


# Rows end at line feeds outside quotes; inside them two quotes stand for one.
_ROW = r'(?:[^"\n]++|"(?:[^"]++|"")*+"|")++'
_CELL = r',(?:[^\S\n]*"(?:[^"]++|"")*+"[^,]*|[^,]*)'


def _cells(row: Column) -> Column:
    """The cells of a delimited row, trimmed, without their quotes."""

    def plain(cell: Column) -> Column:
        text = F.trim(F.substring(cell, 2, 2**31 - 1))
        inner = F.replace(F.regexp_extract(text, r'(?s)^"(.*)"[^"]*$', 1), F.lit('""'), F.lit('"'))
        return F.when(text.startswith('"') & text.rlike(r'(?s)^".*"[^"]*$'), inner).otherwise(text)

    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), row), F.lit(_CELL), F.lit(0)), plain)


def _records(texts: DataFrame) -> DataFrame:
    """(file, head, cells) of every row of delimited texts (file, value). Files differ in
    their columns, so each row keeps the header of its own file. Blank lines do not matter;
    quoted cells may hold commas, quotes and line feeds."""
    plain = F.regexp_replace(F.regexp_replace("value", "^\ufeff", ""), "\r\n?", "\n")
    found = F.regexp_extract_all(plain, F.lit(_ROW), F.lit(0))
    filled = texts.select("file", F.filter(found, lambda row: F.trim(row) != "").alias("f"))
    rows = filled.select("file", _cells(F.get("f", F.lit(0))).alias("head"), F.explode(F.slice("f", F.lit(2), F.size("f"))).alias("row"))
    return rows.select("file", "head", _cells(F.col("row")).alias("cells"))


def _cell(name: str) -> Column:
    """The cell below a header name; NULL where the file or the row lacks it."""
    return F.get("cells", (F.array_position("head", F.lit(name)) - 1).cast("int"))


def parse_eval_periods(texts: DataFrame) -> DataFrame:
    """Periods of `fy*_*_h.csv` texts (file, value); the label is the file name, `_perf_`
    files are left out and the network column may be nid or netid."""
    name = F.substring_index("file", "/", -1)
    start, end = period_bounds(_cell("from"), _cell("to"))
    netid = F.coalesce(F.nullif(_cell("nid"), F.lit("")), _cell("netid"))
    return _records(texts.where(~name.contains("_perf_"))).where(_cell("id") != "").select(
        _cell("id").alias("rinex_id"),
        start.alias("from"),
        end.alias("to"),
        F.regexp_replace(name, r"\.csv$", "").alias("fy_label"),
        _optional_int(netid).alias("netid"),
    )


def read_eval_period_csv(spark: SparkSession, path: str) -> DataFrame:
    return parse_eval_periods(_files(spark, path))


def collect_periods(periods: DataFrame) -> DataFrame:
    """Nested form: the periods of a station ordered by start and label."""
    entry = F.struct("from", "fy_label", "to", "netid")
    return periods.groupBy("rinex_id").agg(F.sort_array(F.collect_list(entry)).alias("p")).select(
        "rinex_id",
        F.transform(
            "p",
            lambda p: F.struct(
                p["from"].alias("from"), p["to"].alias("to"), p["fy_label"].alias("fy_label"), p["netid"].alias("netid")
            ),
        ).alias("periods"),
    )


def parse_station_ng(texts: DataFrame) -> DataFrame:
    """(year, rinex_id, netid, isinside) of `{year}/station_ng.csv` texts (file, value)."""
    return _records(texts).where(_cell("id") != "").select(
        F.regexp_extract("file", r"/(\d{4})/[^/]*$", 1).cast("int").alias("year"),
        _cell("id").alias("rinex_id"),
        _optional_int(_cell("netid")).alias("netid"),
        (F.lower(_cell("isinside")) == "true").alias("isinside"),
    )


def read_station_ng_csv(spark: SparkSession, path: str) -> DataFrame:
    return parse_station_ng(_files(spark, path))


def read_network_info_csv(spark: SparkSession, path: str) -> DataFrame:
    return parse_network_info(_files(spark, path))


def parse_network_info(texts: DataFrame) -> DataFrame:
    """Up to four grid rows per station from the wide columns inet_1..4, weight_1..4 and so
    on. A slot with a blank or nan inet, or with a number that does not parse, is skipped."""

    def slot(n: int):
        number = lambda c: _cell(f"{c}_{n}").try_cast("double")
        return F.struct(
            F.lit(n).alias("slot"),
            _optional_int(_cell(f"inet_{n}")).alias("inet"),
            number("weight").alias("weight"),
            number("lat").alias("lat"),
            number("lon").alias("lon"),
            number("dist").alias("dist_km"),
            _optional_int(_cell(f"index_{n}")).alias("index"),
            F.lower(F.coalesce(_cell(f"index_{n}"), F.lit(""))).alias("index_text"),
        )

    usable = F.col("inet").isNotNull() & (F.col("index").isNotNull() | F.col("index_text").isin("", "nan"))
    for c in ("weight", "lat", "lon", "dist_km"):
        usable = usable & F.col(c).isNotNull()
    return (
        _records(texts)
        .where(_cell("id") != "")
        .select(
            _cell("id").alias("rinex_id"),
            _optional_int(_cell("n_grids")).alias("n_grids"),
            F.explode(F.array(*[slot(n) for n in (1, 2, 3, 4)])).alias("g"),
        )
        .select("rinex_id", "n_grids", "g.*")
        .where(usable)
        .drop("index_text")
    )
