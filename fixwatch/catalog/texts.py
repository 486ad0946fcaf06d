"""Text grammars: sentences are written from the tables by Spark and parsed back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fixwatch import sinks
from fixwatch.catalog.inputs import landing, spread, table
from fixwatch.catalog.registry import query, tidy_sql
from fixwatch.functions import notices as fn
from fixwatch.sources import coords, logs, nmea, qc_text, registry
from fixwatch.sources import notices as notice_text

# --- position sentences --------------------------------------------------------------


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user one file. Every third event writes an RMC line before its GGA line; the
    other GGA lines take the date of the latest RMC, often from an earlier block."""
    event, user = F.col("event_id"), F.col("user_id")
    hms = F.date_format("ts", "HHmmss")
    lat = F.format_string("%02d%07.4f", user % 60, (event % 599_999) / 10_000)
    lon = F.format_string("%03d%07.4f", user % 180, (event % 499_999) / 10_000)
    quality = F.when(F.col("event_type") == "purchase", "4").when(F.col("event_type") == "view", "5").otherwise("1")
    rmc = F.concat_ws(",", F.lit("$GPRMC"), F.concat(hms, F.lit(".00")), F.lit("A"), lat, F.lit("N"), lon, F.lit("E"),
                      F.lit("0"), F.lit("0"), F.date_format("ts", "ddMMyy"), F.lit("*00"))
    empty_lat = F.when(event % 50 == 0, "").otherwise(lat)
    gga = F.concat_ws(",", F.lit("$GPGGA"), F.concat(hms, F.lit(".00")), empty_lat, F.when(event % 2 == 0, "N").otherwise("S"),
                      lon, F.when(event % 5 == 0, "W").otherwise("E"), quality, (event % 20).cast("string"), F.lit("1.0"),
                      F.format_string("%.2f", F.col("value")), F.lit("M"), F.when(event % 3 == 1, "36.5").otherwise(""),
                      F.lit("M,,*00"))
    both = F.array(
        F.struct(F.lit(0).alias("part"), F.when(event % 3 == 0, rmc).alias("value")),
        F.struct(F.lit(1).alias("part"), gga.alias("value")),
    )
    return (
        spread(table(spark, sf_dir, "events"), "event_id")
        .select(
            user.cast("string").alias("file"), F.floor(event / 1000).alias("block"), "event_id", F.explode(both).alias("l")
        )
        .select("file", "block", (event * 2 + F.col("l.part")).alias("line_no"), "l.value")
        .where(F.col("value").isNotNull())
    )


_SENTENCES = """sent AS (SELECT *, date_trunc('second', ts) AS t,
    last_value(CASE WHEN event_id % 3 = 0 THEN CAST(ts AS DATE) END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS rmc_date FROM events),
  q AS (SELECT *, CASE event_type WHEN 'purchase' THEN 4 WHEN 'view' THEN 5 ELSE 1 END AS quality,
    CAST(floor((hour(t) * 3600 + minute(t) * 60 + second(t) + 18) % 86400 / 30) AS BIGINT) AS epoch_idx FROM sent)"""


@query(
    "nmea_positions",
    tidy_sql(
        f"""WITH {_SENTENCES} SELECT CAST(user_id AS VARCHAR) AS file, event_id * 2 + 1 AS line_no, rmc_date + CAST(t AS TIME) AS time_utc,
        rmc_date + CAST(t AS TIME) + INTERVAL 18 SECOND AS time_gpst,
        (user_id % 60 + (event_id % 599999) / 10000.0 / 60) * CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END AS lat_deg,
        (user_id % 180 + (event_id % 499999) / 10000.0 / 60) * CASE WHEN event_id % 5 = 0 THEN -1 ELSE 1 END AS lon_deg,
        round(value, 2) + CASE WHEN event_id % 3 = 1 THEN 36.5 ELSE 0 END AS alt_m, quality, event_id % 20 AS num_sat, epoch_idx
        FROM q WHERE rmc_date IS NOT NULL AND event_id % 50 <> 0""",
        real=["lat_deg", "lon_deg", "alt_m"], whole=["quality"], time=["time_utc", "time_gpst"],
    ),
)
def nmea_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nmea.parse_positions(_sentences(spark, sf_dir)).drop("block")


@query(
    "nmea_quality",
    f"""WITH {_SENTENCES} SELECT CAST(user_id AS VARCHAR) AS file, epoch_idx, CAST(arg_max(quality, event_id) AS BIGINT) AS quality FROM q GROUP BY ALL""",
)
def nmea_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nmea.parse_qualities(_sentences(spark, sf_dir))


@query(
    "quality_histogram",
    f"WITH {_SENTENCES} SELECT CAST(user_id AS VARCHAR) AS file, CAST(quality AS BIGINT) AS quality, count(*) AS n FROM q GROUP BY ALL",
)
def quality_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nmea.quality_histogram(_sentences(spark, sf_dir))


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentences, some cut short, some with a letter in the latitude or in the hour."""
    event = F.floor(F.col("line_no") / 2)
    gga = F.col("value").startswith("$GPGGA")
    value = (
        F.when(gga & (event % 41 == 0), F.substring_index("value", ",", 9))
        .when(gga & (event % 43 == 0), F.regexp_replace("value", r"^(\$GPGGA,[^,]*,\d)", "$1x"))
        .when(gga & (event % 47 == 0), F.regexp_replace("value", r"^\$GPGGA,\d", r"\$GPGGA,x"))
    )
    return _sentences(spark, sf_dir).withColumn("value", F.coalesce(value, "value"))


@query(
    "position_rejects",
    f"""WITH {_SENTENCES}, judged AS (SELECT CAST(user_id AS VARCHAR) AS file, event_id * 2 + 1 AS line_no, CASE WHEN event_id % 41 = 0 THEN 'fields missing'
      WHEN rmc_date IS NULL THEN 'no date before it' WHEN event_id % 50 = 0 THEN 'field empty' WHEN event_id % 43 <> 0 AND event_id % 47 = 0 THEN 'bad date or time'
      WHEN event_id % 43 = 0 THEN 'bad number' END AS reason FROM q)
    SELECT file, coalesce(reason, 'good') AS reason, count(*) AS n, (SELECT count(*) FILTER (reason IS NULL) FROM judged) AS good, (SELECT count(reason) FROM judged) AS rejected
    FROM judged GROUP BY ALL""",
)
def position_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and rejected lines written in one pass, read back and counted, beside the counts
    that were taken on the way."""
    good, bad, counts = sinks.write_judged(nmea.judge_positions(_damaged(spark, sf_dir)), landing(spark, "positions"))
    both = good.select("file", F.lit("good").alias("reason")).unionByName(bad.select("file", "reason"))
    return both.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n")).withColumns({k: F.lit(v) for k, v in counts.items()})


# --- coordinate files ----------------------------------------------------------------


def _coordinate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text per supplier and year; suppliers ending in 9 lack the frame and give nothing."""
    day = F.to_date("l_shipdate")
    daily = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", day.alias("d"))
        .agg(F.max("l_extendedprice").alias("x"), F.max("l_quantity").alias("y"), F.count(F.lit(1)).alias("z"))
    )
    zero = F.lit("0.0")
    line = F.concat_ws("  ", F.date_format("d", " yyyy MM dd 12:00:00"), F.format_string("%.10E", "x"),
                       F.format_string("%.10E", -F.col("y")), F.format_string("%.10E", F.col("z").cast("double")), zero, zero, zero)
    # A station-year has at most 366 lines.
    texts = daily.groupBy("l_suppkey", F.year("d").alias("year")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    supplier = F.col("l_suppkey")
    head = F.concat(
        F.lit("+SITE/INF\n"), F.format_string(" ID           %06d\n RINEX        %04d\n J_NAME       Site %d\n", supplier, supplier, supplier),
        F.lit(" SOLUTION_ID  X(GPS)\n-SITE/INF\n"), F.when(supplier % 10 == 9, "").otherwise(" COORDINATE   ITRF2014\n"),
        F.lit("+DATA\n*yyyy mm dd\n*----+--\n"),
    )
    return texts.select(
        F.concat_ws("/", "year", "l_suppkey").alias("file"),
        F.concat(head, F.array_join("lines", "\n"), F.lit("\n*----\n-DATA\n")).alias("value"),
    )


@query(
    "station_coordinates",
    tidy_sql(
        """SELECT format('{:06d}', l_suppkey) AS f5_id, format('{:04d}', l_suppkey) AS rinex_id, 'Site ' || l_suppkey AS j_name, 'ITRF2014' AS frame,
        CAST(l_shipdate AS DATE) AS date, round(max(l_extendedprice), 2) AS x_m, -round(max(l_quantity), 2) AS y_m, round(count(*), 2) AS z_m
        FROM lineitem WHERE l_suppkey % 10 <> 9 GROUP BY ALL""",
        real=["x_m", "y_m", "z_m"], date=["date"],
    ),
)
def station_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _coordinate_files(spark, sf_dir)
    return coords.parse_coordinates(docs).select("f5_id", "rinex_id", "j_name", "frame", "date", "x_m", "y_m", "z_m")


@query(
    "coordinate_rejects",
    """WITH days AS (SELECT DISTINCT l_suppkey, CAST(l_shipdate AS DATE) AS d FROM lineitem),
    judged AS (SELECT year(d) || '/' || l_suppkey AS file, CASE WHEN month(d) = 2 AND day(d) = 3 THEN 'bad date' WHEN day(d) = 17 THEN 'bad number' END AS reason FROM days WHERE l_suppkey % 10 <> 9
      UNION ALL SELECT DISTINCT year(d) || '/' || l_suppkey, 'file lacks frame' FROM days WHERE l_suppkey % 10 = 9)
    SELECT file, coalesce(reason, 'good') AS reason, count(*) AS n, (SELECT count(*) FILTER (reason IS NULL) FROM judged) AS good, (SELECT count(reason) FROM judged) AS rejected
    FROM judged GROUP BY ALL""",
)
def coordinate_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that do not exist and coordinates that are no numbers, beside files without frame."""
    docs = _coordinate_files(spark, sf_dir)
    damaged = F.regexp_replace(F.regexp_replace("value", r"(?m)^ (\d{4}) 02 03 ", " $1 02 31 "), r"(?m)^( \d{4} \d\d 17 \S+  )", "$1x")
    good, bad, counts = sinks.write_judged(coords.judge_coordinates(docs.withColumn("value", damaged)), landing(spark, "coordinates"))
    both = good.select("file", F.lit("good").alias("reason")).unionByName(bad.select("file", "reason"))
    return both.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n")).withColumns({k: F.lit(v) for k, v in counts.items()})


# --- QC summaries --------------------------------------------------------------------


def _summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One summary per customer with one ION or MP12 and one SN1 block."""
    key = F.col("c_custkey")
    step = F.sequence(F.lit(0), F.lit(18))
    low = lambda i: F.when(i == 18, "    <  0").otherwise(F.format_string(" %2d - %2d", 85 - i * 5, 90 - i * 5))
    mp = F.transform(step, lambda i: F.concat(low(i), F.format_string("  %5d %4d %10.6f", key % 9000 + i, i, (key % 500 + i) / 1000)))
    sn = F.transform(step, lambda i: F.concat(low(i), F.format_string("  %5d %7.3f %8.3f ##|", key % 9000 + i, (i + 1) / 8, (key % 50) + i / 4)))
    slips = F.when(key % 2 == 0, "ION rms, m>").otherwise("MP12 rms, m>")
    text = F.concat(
        F.format_string("                    Quality Check (qc)\n4-character ID          : %04d\n", key % 10_000),
        F.format_string("Receiver type           : ACME R9 (# = %05d) (fw = 1.4.%d,02/Jan/2021)\n", key, key % 9),
        F.concat(F.lit("Antenna type            : "), "c_mktsegment", F.lit("    NONE\n")),
        F.format_string("  antenna WGS 84 (xyz)  : %.4f %.4f %.4f (m)\n", -F.col("c_acctbal"), F.col("c_acctbal"), key + 0.5),
        F.format_string("Epochs w/ observations  : %6d\n", key % 2881),
        F.format_string("Possible obs >  10.0 deg:%7d\nComplete obs >  10.0 deg:%7d\n", key % 7 * 1000, key % 7 * 900 + key % 7),
        F.lit("\nObservation interval :   30.000 sec\n\nelev (deg)  tot slps <"), slips, F.lit("        5=%       1|m\n"),
        F.array_join(mp, "\n"), F.lit("\n\nmean rms        :  0.123 m\n\nelev (deg)  tot SN1 sig    mean          2|0\n"),
        F.array_join(sn, "\n"), F.lit("\n"),
    )
    return spread(table(spark, sf_dir, "customer"), "c_custkey").select(key.cast("string").alias("file"), text.alias("value"))


@query(
    "qc_summary_header",
    tidy_sql(
        """SELECT CAST(c_custkey AS VARCHAR) AS file, format('{:04d}', c_custkey % 10000) AS station, 'ACME R9' AS rec_type,
        format('{:05d}', c_custkey) AS rec_num, '1.4.' || c_custkey % 9 || ',02/Jan/2021' AS rec_fw_ver, c_mktsegment || '    NONE' AS ant_type,
        -round(c_acctbal, 4) AS approx_pos_x, round(c_acctbal, 4) AS approx_pos_y, c_custkey + 0.5 AS approx_pos_z,
        CASE WHEN c_custkey % 7 = 0 THEN 0.0 ELSE (c_custkey % 7 * 900 + c_custkey % 7) / (c_custkey % 7 * 1000) END AS visibility,
        c_custkey % 2881 AS epochs_w_obs FROM customer""",
        real=["approx_pos_x", "approx_pos_y", "approx_pos_z", "visibility"],
    ),
)
def qc_summary_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc_text.parse_header(_summaries(spark, sf_dir))


@query(
    "qc_summary_blocks",
    tidy_sql(
        """WITH i AS (SELECT *, CASE WHEN i = 18 THEN '   <  0' ELSE lpad(CAST(85 - i * 5 AS VARCHAR), 2, ' ') || ' - ' || lpad(CAST(90 - i * 5 AS VARCHAR), 2, ' ') END AS bin_label,
          CASE WHEN i = 18 THEN -1 ELSE 85 - i * 5 END AS bin_lo FROM customer, range(19) AS r(i))
        SELECT CAST(c_custkey AS VARCHAR) AS file, CASE WHEN c_custkey % 2 = 0 THEN 'ION' ELSE 'MP12' END AS metric, bin_label, bin_lo,
          c_custkey % 9000 + i + 0.0 AS tot, i + 0.0 AS slps_or_sig, (c_custkey % 500 + i) / 1000.0 AS rms_or_mean FROM i
        UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'SN1', bin_label, bin_lo, c_custkey % 9000 + i + 0.0, (i + 1) / 8.0, c_custkey % 50 + i / 4.0 FROM i""",
        real=["tot", "slps_or_sig", "rms_or_mean"],
    ),
)
def qc_summary_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc_text.parse_blocks(_summaries(spark, sf_dir))


@query(
    "qc_failed_files",
    """SELECT '2024-05-06' AS date, CAST(c_custkey AS VARCHAR) AS file, CASE WHEN c_custkey % 6 = 0 THEN 2 ELSE 1 END AS n_bad_rows FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT '2024-05-07', CAST(c_custkey AS VARCHAR), 1 FROM customer WHERE c_custkey % 5 = 0""",
)
def qc_failed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of two days with numbers that do not parse. The first run of the second day
    has all files broken; the second run replaces it."""
    docs, path = _summaries(spark, sf_dir), landing(spark, "qc")
    key = F.col("file").cast("long")

    def broken(row: Column, header: Column) -> DataFrame:
        text = F.when(row, F.regexp_replace("value", r"(?m)^( 10 - 15  ) *\d+( +\d+ +\S+)$", "$1     x$2")).otherwise(F.col("value"))
        return docs.withColumn("value", F.when(header, F.regexp_replace(text, r"(Epochs w/ observations  : *)\d+", "$1many")).otherwise(text))

    runs = (
        (dt.date(2024, 5, 6), broken(key % 3 == 0, key % 6 == 0)),
        (dt.date(2024, 5, 7), broken(F.lit(True), F.lit(True))),
        (dt.date(2024, 5, 7), broken(F.lit(False), key % 5 == 0)),
    )
    for date, texts in runs:
        sinks.write_qc_summary(*qc_text.read_day(texts, F.lit(date)), path, date)
    return spark.read.parquet(f"{path}/failed").select("date", "file", "n_bad_rows")


@query(
    "qc_day_tables",
    tidy_sql(
        """WITH c AS (SELECT *, format('{:04d}', c_custkey % 10000) AS station FROM customer WHERE c_custkey % 3 <> 0)
        SELECT station, c_custkey % 2881 AS epochs_w_obs, CASE WHEN c_custkey % 2 = 0 THEN 'ION' ELSE 'MP12' END AS metric, 19 AS n_bins,
          sum(c_custkey % 9000 + i)::DOUBLE AS tot FROM c, range(19) AS r(i) GROUP BY ALL
        UNION ALL SELECT station, c_custkey % 2881, 'SN1', 19, sum(c_custkey % 9000 + i)::DOUBLE FROM c, range(19) AS r(i) GROUP BY c_custkey, station""",
        real=["tot"], whole=["epochs_w_obs", "n_bins"],
    ),
)
def qc_day_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header and long table of a day, every third file left out for a bad row."""
    docs = _summaries(spark, sf_dir)
    bad = F.regexp_replace("value", r"(?m)^( 10 - 15  ) *\d+", "$1     x")
    texts = docs.withColumn("value", F.when(F.col("file").cast("long") % 3 == 0, bad).otherwise(F.col("value")))
    header, long, _ = qc_text.day_tables(texts, F.lit(dt.date(2024, 5, 6)))
    sums = long.groupBy("file", "metric").agg(F.count(F.lit(1)).alias("n_bins"), F.sum("tot").alias("tot"))
    # Several files may name one station.
    return header.select("file", "station", "epochs_w_obs").join(sums, "file").drop("file")


# --- notices -------------------------------------------------------------------------


@query(
    "notice_parse",
    """WITH e AS (SELECT *, date_trunc('minute', ts) AS p, event_id % 366 + 1 AS d0, (event_id * 7) % 366 + 1 AS d1 FROM events)
    SELECT event_id, 'NANU ' || format('{:07d}', event_id) AS notice_id, upper(event_type) AS notice_type, 'SVN' || user_id AS subject,
      strftime(p, '%Y-%m-%d %H:%M:%S') AS published_at, CASE WHEN event_id % 3 > 0 THEN format('{:07d}', event_id - 1) END AS reference_id,
      CAST(CASE WHEN event_id % 4 > 0 THEN user_id END AS BIGINT) AS svn, CAST(user_id % 32 AS BIGINT) AS prn,
      strftime(TIMESTAMP '2024-01-01' + to_days(CAST(d0 - 1 AS INTEGER)) + to_hours(event_id % 24) + to_minutes(event_id % 60), '%Y-%m-%d %H:%M:%S') AS effective_at,
      strftime(TIMESTAMP '2024-01-01' + to_days(CAST(d1 - 1 AS INTEGER)) + INTERVAL 23 HOUR, '%Y-%m-%d %H:%M:%S') AS expires_at,
      'SATELLITE SVN' || user_id || chr(10) || '    WAS OUT: SVN: 99' AS condition, 'CIVILIAN' AS poc
    FROM e WHERE event_id % 11 <> 0""",
)
def notice_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notice texts with both line endings; every eleventh has an unknown header."""
    event, user = F.col("event_id"), F.col("user_id")
    dtg = F.upper(F.date_format("ts", "ddHHmm'Z' MMM yyyy"))
    title = F.when(event % 11 == 0, "NOTICE TO MARINERS ").otherwise("NOTICE ADVISORY TO NAVSTAR USERS (NANU) ")
    body = F.concat(
        title, F.format_string("%07d\n", event), F.format_string("SUBJ: SVN%d\n1.     NANU TYPE: ", user), F.upper("event_type"),
        F.format_string("\n       NANU NUMBER: %07d\n       NANU DTG: ", event), dtg, F.lit("\n       REFERENCE NANU: "),
        F.when(event % 3 == 0, "N/A").otherwise(F.format_string("%07d", event - 1)), F.lit("\n       REF NANU DTG: N/A\n       SVN: "),
        F.when(event % 4 == 0, "N/A").otherwise(user.cast("string")), F.format_string("\n       PRN: %03d", user % 32),
        F.format_string("\n       START JDAY: %03d\n       START TIME ZULU: %02d%02d", event % 366 + 1, event % 24, event % 60),
        F.format_string("\n       STOP JDAY: %03d\n       STOP TIME ZULU: 2300\n\n", (event * 7) % 366 + 1),
        F.format_string("2.  CONDITION: SATELLITE SVN%d\n    WAS OUT: SVN: 99\n\n3.  POC: CIVILIAN\n", user),
    )
    ended = F.when(event % 2 == 0, F.replace(body, F.lit("\n"), F.lit("\r\n"))).otherwise(body)
    parsed = notice_text.parse_navstar(spread(table(spark, sf_dir, "events"), "event_id").select("event_id", ended.alias("body_text")))
    return parsed.select(
        "event_id", "notice_id", "notice_type", "subject", "published_at", "reference_id", "svn", "prn", "effective_at", "expires_at",
        F.regexp_replace("condition", "^CONDITION: ", "").alias("condition"), F.regexp_replace("poc", "^POC: ", "").alias("poc"),
    )


@query(
    "nagu_parse",
    """SELECT o_orderkey, 'NAGU ' || format('{:07d}', o_orderkey) AS notice_id, o_orderpriority AS notice_type, 'USABLE & more' AS subject,
      CASE WHEN o_orderkey % 3 > 0 THEN format('{:07d}', o_orderkey - 1) END AS reference_id, 'GSAT' || o_custkey AS satellite_affected,
      CASE WHEN o_orderkey % 2 = 0 THEN 'ALL' ELSE 'E1, E5a' END AS signals_affected, CAST(o_custkey AS BIGINT) AS space_vehicle_id,
      strftime(o_orderdate + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS effective_at,
      CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS expires_at,
      strftime(o_orderdate + INTERVAL 10 HOUR, '%Y-%m-%d %H:%M:%S') AS published_at FROM orders WHERE o_orderkey % 13 <> 0""",
)
def nagu_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RSS items with escaped HTML; every thirteenth is about something else."""
    key = F.col("o_orderkey")
    title = F.when(key % 13 == 0, "News ").otherwise("NOTICE ADVISORY TO GALILEO USERS (NAGU) ")
    html = F.concat(
        F.lit("<p>NAGU TYPE: "), "o_orderpriority", F.format_string("<br>NAGU NUMBER: %07d<br>NAGU SUBJECT: USABLE &amp; more<br/>", key),
        F.lit("NAGU REFERENCED TO: "), F.when(key % 3 == 0, "N/A").otherwise(F.format_string('<a href="x">%07d</a>', key - 1)),
        F.lit("<br>START DATE EVENT (UTC): "), F.date_format("o_orderdate", "yyyy-MM-dd 08:00"), F.lit("<br>END DATE EVENT (UTC): "),
        F.when(key % 5 == 0, "N/A").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
        F.format_string("<br>SATELLITE AFFECTED: GSAT%d<br>SPACE VEHICLE ID: %d.<br>SIGNAL(S) AFFECTED: ", F.col("o_custkey"), F.col("o_custkey")),
        F.when(key % 2 == 0, "ALL").otherwise("E1, E5a"), F.lit("</p>"),
    )
    escaped = F.replace(F.replace(html, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    published = F.date_format("o_orderdate", "EEE, d MMM yyyy '12:00:00 +0200'")
    items = spread(table(spark, sf_dir, "orders"), "o_orderkey").select(
        "o_orderkey", F.concat(title, F.format_string("%07d", key)).alias("title"), F.lit("").alias("link"),
        published.alias("pubDate"), escaped.alias("description"),
    )
    return notice_text.parse_nagu(items).select(
        "o_orderkey", "notice_id", "notice_type", "subject", "reference_id", "satellite_affected", "signals_affected",
        "space_vehicle_id", "effective_at", "expires_at", "published_at",
    )


_ENTITIES = "html"
for _entity, _plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&nbsp;", "\u00a0"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7")):
    _ENTITIES = f"replace({_ENTITIES}, '{_entity}', '{_plain}')"
# Decoded last, so that what an ampersand starts is not decoded again; the semicolon may lack.
_ENTITIES = f"regexp_replace({_ENTITIES}, '&amp;?', '&', 'g')"
_TEXT = f"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({_ENTITIES}, '<br\\s*/?>', chr(10), 'g'),
  '</?p[^>]*>', chr(10), 'g'), '<[^>]+>', '', 'g'), '\\n\\s*\\n+', chr(10) || chr(10), 'g'), '^[\\s\\x{{a0}}]+|[\\s\\x{{a0}}]+$', '', 'g')"""


@query("html_to_text", f"SELECT page_id, {_TEXT} AS plain FROM pages")
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", fn.html_to_text(F.col("html")).alias("plain"))


# --- configuration, headers, inventories ---------------------------------------------


@query(
    "reset_period",
    """SELECT CAST(p_partkey AS VARCHAR) AS file, CASE WHEN p_partkey % 3 > 0 THEN p_size * 30 END AS reset_period_sec FROM part""",
)
def reset_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration of five lines per part; a third of them sets no reset."""
    key = F.col("p_partkey")
    lines = F.array(
        F.lit("pos1-posmode = kinematic"),
        F.when(key % 3 == 0, "# misc-regularly = 5").otherwise(F.format_string("  misc-regularly =%d # s", F.col("p_size") * 30)),
        F.lit("misc-timeinterp =on"),
        F.when(key % 3 == 0, "end").otherwise("misc-regularly = 1"),
    )
    texts = table(spark, sf_dir, "part").select(
        key.cast("string").alias("file"), F.lit(0).alias("block"), F.posexplode(lines).alias("line_no", "value")
    )
    return logs.reset_periods(texts)


@query(
    "equipment_headers",
    """SELECT CAST(p_partkey AS VARCHAR) AS file, rpad(p_type, 20, ' ') AS receiver, rpad(p_brand, 16, ' ') || 'NONE' AS antenna
    FROM part WHERE p_partkey % 4 > 0""",
)
def equipment_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers with a receiver line and, for three in four, an antenna line. A line behind
    the end of the header does not count."""
    pad = lambda c, n: F.rpad(c, n, " ")
    serial = pad(F.col("p_partkey").cast("string"), 20)
    antenna = F.concat(serial, pad(F.concat(pad(F.col("p_brand"), 16), F.lit("DOME")), 20), pad(F.lit(""), 20), F.lit("ANT # / TYPE"))
    lines = F.array(
        F.concat(serial, pad(F.col("p_type"), 20), pad(F.lit("5.2"), 20), F.lit("REC # / TYPE / VERS")),
        F.when(F.col("p_partkey") % 4 > 0, antenna).otherwise(""),
        F.concat(pad(F.lit(""), 60), F.lit("END OF HEADER")),
        antenna,
    )
    texts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("file"), F.lit(0).alias("block"), F.posexplode(lines).alias("line_no", "value")
    )
    return logs.equipment_headers(texts)


@query(
    "inventory_hash",
    "SELECT doc_id, octet_length(encode(text)) AS size_bytes, sha256(text) AS sha256 FROM documents",
)
def inventory_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.text_inventory(table(spark, sf_dir, "documents"), "doc_id", "text")


# --- registry files ------------------------------------------------------------------


ROWS_PER_FOLDER = 1_000


def _file_texts(rows: DataFrame, key: Column, folder: str, file: Column, head: Column, row: Column) -> DataFrame:
    """(file, value): one text per file, its header and then its rows. A folder takes a
    bounded range of keys, so a larger table makes more files, not larger ones."""
    part = F.floor(key / ROWS_PER_FOLDER).cast("string")
    path = F.concat(F.lit(f"{folder}/"), part, F.lit("/"), file)
    lines = rows.groupBy(path.alias("file"), head.alias("head")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return lines.select("file", F.concat_ws("\n", "head", "rows").alias("value"))


@query(
    "eval_period_files",
    tidy_sql(
        """SELECT CAST(s_suppkey AS VARCHAR) AS rinex_id,
        CASE WHEN s_suppkey % 5 = 0 THEN DATE '1970-01-01' ELSE DATE '2020-01-01' + CAST(s_suppkey % 300 AS INTEGER) END AS "from",
        CASE WHEN s_suppkey % 7 = 0 THEN DATE '9999-12-31' ELSE DATE '2020-06-29' + CAST(s_suppkey % 300 AS INTEGER) END AS "to",
        'fy' || (2000 + s_nationkey) || '_1st_h' AS fy_label, CASE WHEN s_suppkey % 11 <> 0 THEN s_suppkey % 13 END AS netid
        FROM supplier WHERE s_nationkey <> 24""",
        whole=["netid"], date=['"from"', '"to"'],
    ),
)
def eval_period_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per nation; files differ in column order and in the name of the network column."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    day = F.date_add(F.to_date(F.lit("2020-01-01")), (key % 300).cast("int"))
    start = F.when(key % 5 == 0, "").otherwise(F.date_format(day, "yyyy/MM/dd"))
    end = F.when(key % 7 == 0, "").otherwise(F.date_format(F.date_add(day, 180), "yyyy-MM-dd"))
    netid, station = F.when(key % 11 == 0, "nan").otherwise((key % 13).cast("string")), key.cast("string")
    odd = nation % 2 == 1
    texts = _file_texts(
        table(spark, sf_dir, "supplier"),
        key,
        "/registry",
        F.concat(F.lit("fy"), (nation + 2000).cast("string"), F.when(nation == 24, "_perf").otherwise(""), F.lit("_1st_h.csv")),
        F.when(odd, "netid,to,from,id").otherwise("\nid,from,to,nid"),
        F.when(odd, F.concat_ws(",", netid, end, start, station)).otherwise(F.concat_ws(",", station, start, end, netid)),
    )
    return registry.parse_eval_periods(texts)


@query(
    "station_grid_files",
    tidy_sql(
        """SELECT 2020 + c_custkey % 5 AS year, CAST(c_custkey AS VARCHAR) AS rinex_id,
        CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey END AS netid, c_acctbal > 0 AS isinside FROM customer""",
        whole=["year", "netid"],
    ),
)
def station_grid_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per year; odd years have another column order. Names hold commas and quotes."""
    key = F.col("c_custkey")
    name = F.format_string('"Post ""%d"", %s"', key, F.col("c_mktsegment"))
    year, station = key % 5 + 2020, key.cast("string")
    netid = F.when(key % 4 == 0, "").otherwise(F.col("c_nationkey").cast("string"))
    inside = F.when(F.col("c_acctbal") > 0, "True").otherwise("False")
    odd = year % 2 == 1
    texts = _file_texts(
        table(spark, sf_dir, "customer"),
        key,
        "/grid",
        F.concat(year.cast("string"), F.lit("/station_ng.csv")),
        F.when(odd, "isinside,name,id,netid").otherwise("id,name,netid,isinside"),
        F.when(odd, F.concat_ws(",", inside, name, station, netid)).otherwise(F.concat_ws(",", station, name, netid, inside)),
    )
    return registry.parse_station_ng(texts)


_GRID = ("inet", "weight", "lat", "lon", "dist", "index")


@query(
    "network_info_files",
    tidy_sql(
        """SELECT CAST(p_partkey AS VARCHAR) AS rinex_id, 4 AS n_grids, n AS slot, p_partkey % 20 AS inet, p_size / 64.0 AS weight,
        30.0 + p_partkey % 15 AS lat, 130.0 + n AS lon, p_partkey % 50 + 0.5 AS dist_km, CASE WHEN p_partkey % 2 = 1 THEN n END AS "index"
        FROM part CROSS JOIN range(1, 5) AS r(n) WHERE (p_partkey + n) % 3 <> 0 AND (p_partkey + n) % 7 <> 0""",
        real=["weight", "lat", "lon", "dist_km"], whole=["n_grids", "slot", "inet", '"index"'],
    ),
)
def network_info_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four slots a station; some lack the grid, some have a weight that is no number."""
    key = F.col("p_partkey")

    def slot(n: int) -> list[Column]:
        return [
            F.when((key + n) % 3 == 0, "nan").otherwise((key % 20).cast("string")),
            F.when((key + n) % 7 == 0, "x").otherwise((F.col("p_size") / 64).cast("string")),
            (key % 15 + 30).cast("string"),
            F.lit(str(130 + n)),
            F.format_string("%d.5", key % 50),
            F.when(key % 2 == 1, str(n)).otherwise(""),
        ]

    names = ["id", "n_grids", *[f"{c}_{n}" for n in (1, 2, 3, 4) for c in _GRID]]
    cells = [key.cast("string"), F.lit("4"), *[c for n in (1, 2, 3, 4) for c in slot(n)]]
    texts = _file_texts(
        table(spark, sf_dir, "part"),
        key,
        "/grid",
        F.concat(F.lit("network_"), (key % 100).cast("string"), F.lit(".csv")),
        F.when(key % 100 < 50, ",".join(names)).otherwise(",".join(reversed(names))),
        F.when(key % 100 < 50, F.concat_ws(",", *cells)).otherwise(F.concat_ws(",", *reversed(cells))),
    )
    return registry.parse_network_info(texts)
