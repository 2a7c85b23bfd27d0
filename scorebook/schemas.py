"""Declared shapes: the match document and the operational logs."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT = T.StringType()
_INT = T.IntegerType()
_TEXTS = T.ArrayType(_TEXT)

# Fixed field names of the published match-document format.
EXTRAS = _struct(wides=_INT, noballs=_INT, byes=_INT, legbyes=_INT, penalty=_INT)
WICKET = _struct(kind=_TEXT, player_out=_TEXT, fielders=T.ArrayType(_struct(name=_TEXT)))
DELIVERY = _struct(
    actual_delivery=_TEXT,
    batter=_TEXT,
    bowler=_TEXT,
    non_striker=_TEXT,
    runs=_struct(batter=_INT, extras=_INT, total=_INT),
    extras=EXTRAS,
    wickets=T.ArrayType(WICKET),
)
# ``first`` and ``index`` stand in texts that continue a match: the place of the first ball in its over, and of the innings.
OVER = _struct(over=_INT, deliveries=T.ArrayType(DELIVERY), first=_INT)
INNINGS = _struct(team=_TEXT, overs=T.ArrayType(OVER), index=_INT)
META = _struct(data_version=_TEXT, created=_TEXT, revision=_INT)
INFO = _struct(
    balls_per_over=_INT,
    city=_TEXT,
    dates=_TEXTS,
    event=_struct(name=_TEXT, match_number=_TEXT, stage=_TEXT, group=_TEXT),
    gender=_TEXT,
    match_type=_TEXT,
    outcome=_struct(
        winner=_TEXT,
        result=_TEXT,
        by=_struct(runs=_INT, wickets=_INT),
        eliminator=_TEXT,
        method=_TEXT,
    ),
    overs=_INT,
    player_of_match=_TEXTS,
    players=T.MapType(_TEXT, _TEXTS),
    registry=_struct(people=T.MapType(_TEXT, _TEXT)),
    officials=_struct(match_referees=_TEXTS, tv_umpires=_TEXTS, umpires=_TEXTS, reserve_umpire=_TEXT),
    season=_TEXT,
    team_type=_TEXT,
    teams=_TEXTS,
    toss=_struct(decision=_TEXT, winner=_TEXT),
    venue=_TEXT,
)
CORRUPT = "_corrupt_record"
DOCUMENT = _struct(meta=META, info=INFO, innings=T.ArrayType(INNINGS), **{CORRUPT: _TEXT})

# Fixed column names of the operational logs.
RUN_LOG = "run_id string, run_mode string, dry_run boolean, status string, started_at timestamp, completed_at timestamp, recorded_at timestamp"
TASK_LOG = (
    "run_id string, task_name string, run_mode string, status string, input_count bigint, output_count bigint, "
    "inserted_count bigint, updated_count bigint, deleted_count bigint, skipped_count bigint, quarantine_count bigint, "
    "error_message string, recorded_at timestamp, started_at timestamp, completed_at timestamp, duration_seconds double"
)
PROGRESS_LOG = (
    "run_id string, task_name string, current_item string, processed_count bigint, total_count bigint, "
    "percent_complete double, status string, message string, updated_at timestamp"
)
QUALITY_LOG = (
    "run_id string, check_name string, table_name string, severity string, status string, "
    "failed_record_count bigint, sample_failure_json string, checked_at timestamp"
)
TABLE_COUNT_LOG = "run_id string, table_name string, new_count bigint, old_count bigint, total_count bigint, recorded_at timestamp"
ARCHIVE_LOG = (
    "run_id string, zip_path string, zip_name string, zip_size_bytes bigint, zip_modified_at timestamp, zip_sha256 string, "
    "status string, json_file_count bigint, register_file_count bigint, invalid_file_count bigint, "
    "error_class string, error_message string, processed_at timestamp"
)
FILE_LOG = (
    "run_id string, zip_sha256 string, zip_path string, relative_member_path string, extracted_path string, "
    "source_filename string, file_extension string, file_size_bytes bigint, file_crc bigint, file_sha256 string, "
    "match_id_candidate string, extraction_status string, error_message string, processed_at timestamp"
)
TOUCHED_LOG = "run_id string, season string, match_bucket string"
FOCUS_CONFIG = "league_name string, enabled boolean, priority int, valid_from date, valid_to date"
