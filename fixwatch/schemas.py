"""Declared schemas; nothing is inferred from data."""

from pyspark.sql import types as T

_STRING, _INT, _LONG, _DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_DATE, _TIME, _BOOL, _FLOAT, _BYTE = T.DateType(), T.TimestampType(), T.BooleanType(), T.FloatType(), T.ByteType()


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _same(names: str, kind: T.DataType) -> dict[str, T.DataType]:
    return dict.fromkeys(names.split(), kind)


QC_HEADER = _struct(
    _same("station rec_type rec_num rec_fw_ver ant_type", _STRING)
    | _same("approx_pos_x approx_pos_y approx_pos_z visibility", _DOUBLE)
    | {"epochs_w_obs": _INT, "date": _DATE, "source_file": _STRING}
)
QC_LONG = _struct(
    {"station": _STRING, "date": _DATE, "metric": _STRING, "bin_label": _STRING, "bin_lo": _INT}
    | _same("tot slps_or_sig rms_or_mean", _DOUBLE)
)
EXTRAS = _struct(
    _same("reference_id subject condition signals_affected naq_ss_signal event_description", _STRING)
    | {"space_vehicle_id": _INT}
)
RAW_NOTICES = _struct(
    {"notice_id": _STRING, "constellation": _STRING, "svn": _INT, "prn": _INT, "notice_type": _STRING}
    | _same("published_at effective_at expires_at", _TIME)
    | {"body_text": _STRING, "source_url": _STRING, "fetched_at": _TIME, "source_sha256": _STRING, "extras": EXTRAS}
)
EPOCH_ERRORS = _struct(
    {"date": _DATE, "station": _STRING, "mode": _STRING, "engine_version": _STRING, "epoch_idx": _INT}
    | {"time_utc": _TIME, "quality": _BYTE, "num_sat": _BYTE}
    | _same("e_m n_m u_m horizontal_m vertical_m", _FLOAT)
    | {"is_day": _BOOL}
)
ASSIGNMENTS = _struct({"rinex_id": _STRING, "netid": _INT, "isinside": _BOOL})
STATION_PERIODS = _struct(
    {
        "rinex_id": _STRING,
        "periods": T.ArrayType(_struct({"from": _DATE, "to": _DATE, "fy_label": _STRING, "netid": _INT})),
    }
)
OUT_OF_SERVICE = _struct({"rinex_id": _STRING, "reason": _STRING, "since": _DATE, "until": _DATE})
JUMPS = _struct({"date": _DATE, "fixed_station_id": _STRING, "reason": _STRING, "recorded_at": _STRING})
ACQUISITION_LOG = _struct(
    _same("source url path sha256", _STRING)
    | {"size_bytes": _LONG, "retrieved_at": _TIME, "skipped": _BOOL, "metadata": T.MapType(_STRING, _STRING)}
)
PROCESSING_LOG = _struct(
    _same("engine engine_version mode date", _STRING)
    | {"started_at": _TIME, "finished_at": _TIME, "wall_sec": _DOUBLE}
    | _same("n_stations n_succeeded n_skipped n_failed", _LONG)
    | _same("duration_total_sec duration_p50_sec duration_p95_sec", _DOUBLE)
    | {"failed_stations": T.ArrayType(_STRING)}
)
QC_LOG = _struct(
    {"target_date": _STRING, "tool": _STRING, "n_stations": _LONG, "n_failed": _LONG}
    | {"failed_files": T.ArrayType(_STRING), "parquet_path": _STRING, "generated_at": _TIME}
)
STATION_CONFIG_LOG = _struct(
    _same("station date mode engine receiver antenna", _STRING)
    | {"file_sha256": T.MapType(_STRING, _STRING), "recorded_at": _TIME}
)
NAQU_PAGE = _struct(
    {
        "JSON_CS_LIST": T.ArrayType(
            _struct(_same("MODAL_TEXT NAQ_NAQU_NUMBER NAQ_SS_SIGNAL NAQ_TYPE NAQ_CREATE_DATETIME", _STRING))
        ),
        "JSON_CS_PAGING": T.ArrayType(_struct({"DATA_MAX_PAGE": _STRING})),
    }
)
RSS_ITEM = _struct(_same("title link pubDate description", _STRING))
