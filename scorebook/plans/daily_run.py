"""One run from arriving documents to serving tables.

Cost follows the batch: the raw tables are split by a hash of the match, the facts by season and that
hash, and a run reads and rewrites only the partitions its changed matches touch. Stages hand over
through tables, so a lost executor repeats tasks and a failed run can be started again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorebook import schemas
from scorebook.operators import documents as docs
from scorebook.operators import gold, quality, runlog, segments, upsert
from scorebook.operators.nested import unpivot_prefix
from scorebook.session import materialise
from scorebook.sources import archives as zips
from scorebook.sources.tables import Lake, empty_table, in_partitions, listed_partitions, outside_partitions

RAW = "bronze_raw_matches"
VERSIONS = "bronze_raw_match_versions"
#: Texts that continue a match: a long one arrives as its document and further texts.
CONTINUED = "bronze_continued_texts"
MATCHES = "silver_matches"
DELIVERIES = "silver_deliveries"
WICKETS = "silver_wickets"
TEAMS = "silver_match_teams"
REGISTRY = "silver_player_registry"
BATTING = "gold_player_batting_stats"
BOWLING = "gold_bowler_stats"
SUMMARY = "gold_team_match_summary"
LEAGUES = "gold_league_season_summary"
PLAYER_CARDS = "gold_ai_player_cards"
TEAM_CARDS = "gold_ai_team_season_cards"
FACTS = "gold_ai_match_facts"
CARDS = (FACTS, PLAYER_CARDS, TEAM_CARDS)
COUNTED = (RAW, MATCHES, DELIVERIES, WICKETS, BATTING, BOWLING, SUMMARY, LEAGUES, *CARDS)

TASKS = (
    ("Bronze", "extract_archives"),
    ("Bronze", "ingest_raw"),
    ("Silver", "build_facts"),
    ("Silver", "build_dimensions"),
    ("Silver", "validate_silver"),
    ("Gold", "refresh_gold"),
    ("Gold", "validate_gold"),
    ("Serving", "split_segments"),
)

BUCKET = "match_bucket"


@dataclass(frozen=True)
class Run:
    """Parameters of one run. ``leagues`` restricts the facts to listed competitions (scoped rebuild)."""

    run_id: str
    mode: str = "incremental"
    leagues: tuple[str, ...] = ()
    focus: str | None = None
    focus_match: str = "exact"
    null_safe: bool = False
    buckets: int = 16
    #: Earlier snapshots stay readable for so many days; partitions in more folders than ``folders`` are rewritten as one.
    keep_days: float = 7.0
    folders: int = 32

    @property
    def full(self) -> bool:
        return self.mode == "bootstrap"


def bucket_of(match_id: Column, buckets: int) -> Column:
    """Partition value that spreads matches evenly, whatever competition or season is large."""
    return F.format_string("%04d", F.pmod(F.xxhash64(match_id), F.lit(buckets)))


# ------------------------------------------------------------------ accounting


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def _log(lake: Lake, name: str, schema: str, **values: object) -> None:
    """Append one row to an operational log."""
    columns = [F.lit(values.get(field.name)).cast(field.dataType).alias(field.name) for field in T.StructType.fromDDL(schema)]
    lake.append(name, lake.spark.range(0, 1, 1, 1).select(*columns))


def _columns(schema: str) -> list[str]:
    return T.StructType.fromDDL(schema).fieldNames()


@contextmanager
def _task(lake: Lake, run: Run, name: str) -> Iterator[dict[str, int]]:
    """Record one task in the audit log, also when it fails."""
    started, counts, status, message = _now(), {}, "SUCCEEDED", None
    try:
        yield counts
    except Exception as error:
        status, message = "FAILED", str(error)[:1000]
        raise
    finally:
        done = _now()
        _log(
            lake, "task_log", schemas.TASK_LOG, run_id=run.run_id, task_name=name, run_mode=run.mode, status=status,
            error_message=message, started_at=started, completed_at=done, recorded_at=done,
            duration_seconds=max(0.0, (done - started).total_seconds()), **counts,
        )


# ---------------------------------------------------------------------- bronze


@dataclass(frozen=True)
class Extracted:
    """What new archives held: match documents, and the rows of the people and names files if there were any."""

    documents: DataFrame
    register: DataFrame | None
    names: DataFrame | None


def ingest_archives(lake: Lake, run: Run, folder: str) -> DataFrame:
    """Match documents of the archives not opened before, see ``open_archives``."""
    return open_archives(lake, run, folder).documents


def open_archives(lake: Lake, run: Run, folder: str) -> Extracted:
    """Open the archives not opened before; logs the task, its progress, archives and files.

    An archive counts as opened only if its run also took its documents into the history: archives of a
    run that failed before are opened again. Of several people or names files the one in the archive written last counts.
    """
    with _task(lake, run, "extract_archives") as counts:
        return _open_archives(lake, run, folder, counts)


def _open_archives(lake: Lake, run: Run, folder: str, counts: dict[str, int]) -> Extracted:
    ingested = lake.load_or_empty("task_log", schemas.TASK_LOG).where("task_name = 'ingest_raw' AND status = 'SUCCEEDED'")
    known = lake.load_or_empty("archive_log", schemas.ARCHIVE_LOG).join(ingested.select("run_id"), "run_id", "left_semi")
    hashed = materialise(zips.hash_archives(zips.list_archives(lake.spark, folder)), "archives")
    listed = zips.skip_processed(hashed, known)
    pending = listed.where(F.col("status") == "pending")
    # Contents are read once: progress, logs and the ingest all start from the written members.
    members = materialise(zips.explode_archives(pending), "members")
    earlier = lake.load_or_empty("file_log", schemas.FILE_LOG).where(F.col("extraction_status") == "extracted").join(ingested.select("run_id"), "run_id", "left_semi")
    named = zips.name_versions(members.drop("content"), earlier.select("source_filename", "file_sha256"))
    stamp = {"run_id": F.lit(run.run_id), "processed_at": F.current_timestamp()}
    files = named.where(F.col("member").isNotNull()).withColumns({
        **stamp,
        "extracted_path": F.col("final_name"),
        "match_id_candidate": F.when(F.col("file_extension") == ".json", F.regexp_replace("source_filename", r"\.[^.]*$", "")),
    })
    counted = members.groupBy("zip_path").agg(
        F.count_if((F.col("extraction_status") == "extracted") & (F.col("file_extension") == ".json")).alias("json_file_count"),
        F.count_if((F.col("extraction_status") == "extracted") & (F.col("file_extension") == ".csv")).alias("register_file_count"),
        F.count_if(F.col("extraction_status") == "invalid").alias("invalid_file_count"),
        F.max(F.struct("error_class", "error_message")).alias("fault"),
    )
    failed = F.coalesce(F.col("fault.error_class"), F.col("error_class"))
    opened = listed.join(counted, "zip_path", "left").withColumns({
        **stamp,
        "zip_name": F.regexp_extract("zip_path", "([^/]+)$", 1),
        "status": F.when(F.col("status") == "pending", F.when(failed.isNull(), "extracted").otherwise("failed")).otherwise(F.col("status")),
        "error_class": failed,
        "error_message": F.coalesce(F.col("fault.error_message"), F.col("error_message")),
    }).fillna(0, ["json_file_count", "register_file_count", "invalid_file_count"])
    progress = runlog.archive_progress(members.where(F.col("extraction_status") != "invalid")).select(
        F.lit(run.run_id).alias("run_id"), F.lit("extract_archives").alias("task_name"), F.col("zip_path").alias("current_item"),
        "processed_count", "total_count", "percent_complete", "status", F.lit(None).cast("string").alias("message"),
        F.current_timestamp().alias("updated_at"),
    )
    skipped = listed.where(F.col("status") == "skipped_already_processed").select(
        F.lit(run.run_id).alias("run_id"), F.lit("extract_archives").alias("task_name"), F.col("zip_path").alias("current_item"),
        F.lit(0).cast("bigint").alias("processed_count"), F.lit(0).cast("bigint").alias("total_count"),
        runlog.percent_complete(F.lit(0), F.lit(0), F.lit("SKIPPED")).alias("percent_complete"), F.lit("SKIPPED").alias("status"),
        F.lit("content of the archive was processed before").alias("message"), F.current_timestamp().alias("updated_at"),
    )
    lake.append("progress_log", progress.unionByName(skipped))
    lake.append("file_log", files.select(*_columns(schemas.FILE_LOG)))
    lake.append("archive_log", opened.select(*_columns(schemas.ARCHIVE_LOG)))
    seen = members.groupBy("extraction_status").count().collect()
    by = {row["extraction_status"]: row["count"] for row in seen}
    states = {row["status"]: row["count"] for row in listed.groupBy("status").count().collect()}
    counts.update(
        input_count=sum(states.values()), output_count=by.get("extracted", 0),
        skipped_count=states.get("skipped_already_processed", 0), quarantine_count=by.get("invalid", 0) + by.get("failed", 0),
    )
    register, other_names = (zips.newest_register(members, hashed, file) for file in ("people.csv", "names.csv"))
    return Extracted(zips.member_documents(members), register, other_names)


ROW = "row_id"


def _unknown(lake: Lake, run: Run, documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents that are not the standing version of their match, the ids of all, and those of the others.

    Texts are hashed first: the usual delivery repeats nearly all files, and what is repeated is neither parsed nor
    moved. The paths to parse are a written table, so the planner sees its size.
    """
    hashed = materialise(docs.identify(documents).withColumn(BUCKET, bucket_of(F.col("match_id"), run.buckets)), "hashed")
    if not lake.exists(RAW):
        return documents, hashed, hashed.limit(0)
    buckets = listed_partitions(hashed.select(BUCKET).distinct())
    keys = ["match_id", "source_file_sha256"]
    standing = in_partitions(lake.load(RAW), buckets).select(*keys)
    repeated = materialise(hashed.join(standing, keys, "left_semi"), "repeated")
    paths = materialise(hashed.join(standing, keys, "left_anti").select(F.col("source_path").alias("_path")).distinct(), "paths")
    return documents.join(paths, F.col("source_path").eqNullSafe(F.col("_path")), "left_semi"), hashed, repeated


def ingest_raw(lake: Lake, run: Run, documents: DataFrame) -> DataFrame:
    """Upsert documents; returns the parsed rows taken over.

    Everything that has to meet by key (newest per match, comparison with the standing version, history)
    works on narrow rows without text. The text is written to the history once and never rewritten, and
    the wide rows are only filtered by the usually few row numbers that are not wanted. A partition is rewritten only
    for a match that is new or revised.
    """
    with _task(lake, run, "ingest_raw") as counts:
        unknown, hashed, repeated = _unknown(lake, run, documents)
        parsed = docs.shape_raw(docs.parse_documents(unknown), run.run_id)
        numbered = parsed.withColumns({
            BUCKET: bucket_of(F.col("match_id"), run.buckets),
            ROW: F.monotonically_increasing_id(),
        })
        batch = materialise(numbered, "parsed")
        narrow = batch.drop("raw_json", *docs.PARSED)
        touched = listed_partitions(narrow.select(BUCKET).distinct())
        latest = in_partitions(lake.load_or_empty(RAW, narrow.drop(ROW).schema), touched)
        versions = in_partitions(lake.load_or_empty(VERSIONS, batch.drop(ROW, *docs.PARSED).schema), touched)
        added = materialise(upsert.new_versions(versions, narrow, "match_id", "source_file_sha256"), "added")
        valid = narrow.where(F.col("record_status") == "valid")
        classified = materialise(
            upsert.classify_batch(latest, valid, "match_id", "source_file_sha256", "source_revision"), "classified"
        )
        lake.append("field_warnings", docs.field_warnings(batch).withColumn("run_id", F.lit(run.run_id)))
        # Compared as unknown, stored as 0.
        shown = {"source_revision": F.coalesce("source_revision", F.lit(0))}
        taken = classified.where(F.col("change").isin("new", "revised"))
        if not lake.exists(VERSIONS) or not added.isEmpty():
            lake.append(VERSIONS, _only_rows(batch.drop(*docs.PARSED), narrow, added).drop(ROW).withColumns(shown), [BUCKET])
        changing = listed_partitions(taken.select(BUCKET).distinct())
        if changing or not lake.exists(RAW):
            standing = in_partitions(latest, changing)
            lake.replace_partitions(RAW, upsert.apply_merge(standing, taken.drop(ROW).withColumns(shown), "match_id"), [BUCKET], changing)
        change = upsert.change_counts(classified).first()
        same = repeated.select("match_id").distinct().join(classified.select("match_id"), "match_id", "left_anti").count()
        counts.update(
            input_count=hashed.count(),
            output_count=change["candidate_count"] + same,
            inserted_count=change["inserted_count"],
            updated_count=change["updated_count"],
            skipped_count=change["unchanged_count"] + change["older_count"] + same,
            quarantine_count=narrow.where(F.col("record_status") != "valid").count(),
        )
    return _only_rows(batch.drop("raw_json"), narrow, taken).drop(ROW)


def _only_rows(wide: DataFrame, narrow: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wide rows whose number is wanted, without moving the wide rows in the usual case.

    The unwanted numbers are written first, so the size of that table is known when the join is planned:
    broadcast if it is small, an ordinary join if it is not.
    """
    unwanted = materialise(narrow.select(ROW).join(wanted.select(ROW), ROW, "left_anti"), "unwanted")
    return wide.join(unwanted, ROW, "left_anti")


_TEXT = ["match_id", "part", "source_file_sha256"]


def _split(documents: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The documents of matches, and the texts that continue one, if ``part`` says which text of its match each is."""
    if "part" not in documents.columns:
        return documents, None
    later = F.coalesce("part", F.lit(0)) > 0
    return documents.where(~later).drop("part"), documents.where(later)


def ingest_continued(lake: Lake, run: Run, texts: DataFrame) -> None:
    """Keep the texts that continue a match, each content of a part once."""
    if texts.isEmpty():
        return
    parsed = docs.shape_raw(docs.parse_documents(texts, ["meta"]), run.run_id).drop("meta")
    numbered = parsed.withColumns({
        "source_revision": F.coalesce("source_revision", F.lit(0)),
        BUCKET: bucket_of(F.col("match_id"), run.buckets),
        ROW: F.monotonically_increasing_id(),
    })
    batch = materialise(numbered, "continued")
    narrow = batch.select(ROW, "source_path", *_TEXT)
    known = lake.load_or_empty(CONTINUED, batch.drop(ROW).schema).select(*_TEXT)
    added = upsert.latest_by_key(narrow, _TEXT, [F.col("source_path").asc()]).join(known, _TEXT, "left_anti")
    lake.append(CONTINUED, _only_rows(batch, narrow, added).drop(ROW), [BUCKET])


def _continued(lake: Lake, run: Run, matches: DataFrame) -> DataFrame | None:
    """Parsed texts that continue these matches: of each part the newest that has the revision of the match's document.

    Which they are is found on narrow rows. The texts of one long match are then spread by their part.
    """
    if not lake.exists(CONTINUED):
        return None
    heads = matches.select("match_id", F.coalesce("source_revision", F.lit(0)).alias("source_revision"), bucket_of(F.col("match_id"), run.buckets).alias(BUCKET))
    held = in_partitions(lake.load(CONTINUED), listed_partitions(heads.select(BUCKET).distinct())).where("record_status = 'valid'")
    standing = held.select(*_TEXT, "source_revision", "ingestion_timestamp").join(heads, ["match_id", "source_revision"], "left_semi")
    newest = [F.col("ingestion_timestamp").desc_nulls_last(), F.col("source_file_sha256").desc()]
    current = materialise(upsert.latest_by_key(standing, _TEXT[:2], newest).select(*_TEXT), "current")
    texts = held.join(current, _TEXT, "left_semi").drop("record_status", "parse_error", "part")
    return docs.parse_documents(texts).drop("raw_json")


COMPLETED = "COMPLETED"


def _pending(lake: Lake) -> list[str]:
    """Runs that neither succeeded nor were completed by a later one: what they changed still has to reach the facts."""
    history = runlog.run_history(lake.load_or_empty("run_log", schemas.RUN_LOG))
    rows = history.where(~F.col("status").isin("SUCCEEDED", COMPLETED)).select("run_id")
    return [row["run_id"] for row in rows.collect()]


def _settings(lake: Lake, run: Run, focus: DataFrame) -> bool:
    """Hold what the tables were made with; True if the serving tables were made with other settings.

    The number of buckets decides where a match stands, so another one is refused.
    """
    shape = "buckets int, null_safe boolean, focus_match string, focus array<string>"
    names = focus.agg(F.array_sort(F.collect_set("league_name")).alias("focus"))
    now = names.select(F.lit(run.buckets).alias("buckets"), F.lit(run.null_safe).alias("null_safe"), F.lit(run.focus_match).alias("focus_match"), "focus").first()
    stored = lake.load("settings", shape).first() if lake.exists("settings") else None
    if stored is not None and stored["buckets"] != run.buckets:
        raise ValueError(f"the tables have {stored['buckets']} buckets, not {run.buckets}")
    return stored is not None and tuple(stored) != tuple(now)


def _keep_settings(lake: Lake, run: Run, focus: DataFrame) -> None:
    names = focus.agg(F.array_sort(F.collect_set("league_name")).alias("focus"))
    rows = names.select(F.lit(run.buckets).alias("buckets"), F.lit(run.null_safe).alias("null_safe"), F.lit(run.focus_match).alias("focus_match"), "focus")
    lake.replace("settings", rows)


def _changed(lake: Lake, run: Run, taken: DataFrame, pending: list[str]) -> DataFrame:
    """Parsed matches whose facts have to be rebuilt, without their text."""
    current = lambda latest: docs.current_documents(latest, lake.load(VERSIONS))
    reparsed = lambda rows: docs.parse_documents(rows.drop("record_status", "parse_error")).drop("raw_json")
    if run.full:
        return materialise(reparsed(current(lake.load(RAW))), "changed")
    late = [docs.changed_in_run(lake.load(RAW), pending)] if pending else []
    if lake.exists(CONTINUED):
        # Matches whose document stood before, or was taken over by a run that broke off.
        arrived = docs.changed_in_run(lake.load(CONTINUED), [run.run_id, *pending])
        late += [] if arrived.isEmpty() else [arrived]
    if not late:
        return taken
    ids = reduce(DataFrame.unionByName, [rows.select("match_id") for rows in late]).distinct()
    behind = lake.load(RAW).join(ids, "match_id", "left_semi").join(taken.select("match_id"), "match_id", "left_anti")
    return materialise(taken.unionByName(reparsed(current(behind))), "changed")


# ---------------------------------------------------------------------- silver


FACT_PARTITION = ["season", BUCKET]


def build_facts(lake: Lake, run: Run, changed: DataFrame, pending: list[str]) -> list[dict[str, object]]:
    """Replace matches, deliveries and wickets of the changed matches; returns the touched seasons.

    Only partitions that hold a changed match already are rewritten. Rows of new matches elsewhere are
    appended, so a day of new matches costs as much as the day and not as its season.
    """
    with _task(lake, run, "build_facts") as counts:
        bucket = bucket_of(F.col("match_id"), run.buckets)
        wanted = docs.in_leagues(changed, run.leagues)
        later = _continued(lake, run, wanted)
        texts = wanted if later is None else wanted.unionByName(later, allowMissingColumns=True)
        balls = materialise(docs.build_deliveries(texts).withColumn(BUCKET, bucket), "deliveries")
        fresh = {
            MATCHES: materialise(docs.build_matches(wanted).withColumn(BUCKET, bucket), "matches"),
            DELIVERIES: balls,
            WICKETS: docs.build_wickets(balls).withColumn(BUCKET, bucket),
        }
        ids = changed.select("match_id", bucket.alias(BUCKET))
        targets = listed_partitions(fresh[MATCHES].select(*FACT_PARTITION).distinct())
        if run.full or not lake.exists(WICKETS):
            for name, rows in fresh.items():
                lake.replace(name, rows, FACT_PARTITION)
            dirty = []
        else:
            dirty = _dirty(lake, run, ids, targets, pending)
            for name, rows in fresh.items():
                standing = in_partitions(lake.load(name), dirty)
                if dirty:
                    after = upsert.replace_by_key(standing, in_partitions(rows, dirty), ["match_id"], ids)
                    lake.replace_partitions(name, after, FACT_PARTITION, dirty)
                lake.append(name, outside_partitions(rows, dirty), FACT_PARTITION)
        counts.update(output_count=balls.count(), updated_count=ids.count())
    return [{"season": season} for season in {part["season"] for part in [*dirty, *targets]}]


def _dirty(lake: Lake, run: Run, ids: DataFrame, targets: list[dict], pending: list[str]) -> list[dict[str, object]]:
    """Partitions with rows of the changed matches: those where the match table has them now, and those an
    unfinished run was about to change.

    The list is noted before anything changes. A run that repeats or completes a broken one could not find
    a partition any more that a match has left in between.
    """
    keys = ["match_id", BUCKET]
    standing = lake.load(MATCHES).select("match_id", *FACT_PARTITION).join(ids, keys, "left_semi").select(*FACT_PARTITION)
    log = lake.load_or_empty("touched_log", schemas.TOUCHED_LOG)
    noted = log.where(F.col("run_id").isin(*pending)).select(*FACT_PARTITION) if pending else standing.limit(0)
    dirty = listed_partitions(standing.unionByName(noted).distinct())
    rows = [(run.run_id, part["season"], part[BUCKET]) for part in [*dirty, *targets]]
    lake.append("touched_log", lake.spark.createDataFrame(rows, schemas.TOUCHED_LOG).distinct().coalesce(1))
    return dirty


def build_dimensions(lake: Lake, run: Run, changed: DataFrame, register: DataFrame | None, names: DataFrame | None = None) -> None:
    """Per-match records of the changed matches, then the dimensions over all matches."""
    with _task(lake, run, "build_dimensions") as counts:
        bucket = bucket_of(F.col("match_id"), run.buckets)
        ids = changed.select("match_id")
        fresh = {TEAMS: docs.match_teams(changed), REGISTRY: docs.build_person_registry(changed)}
        for name, rows in fresh.items():
            rows = rows.withColumn(BUCKET, bucket)
            if run.full or not lake.exists(name):
                lake.replace(name, rows, [BUCKET])
                continue
            parts = listed_partitions(ids.select(bucket.alias(BUCKET)).distinct())
            standing = in_partitions(lake.load(name), parts)
            lake.replace_partitions(name, upsert.replace_by_key(standing, rows, ["match_id"], ids), [BUCKET], parts)
        teams = lake.load(TEAMS)
        lake.replace("dim_team", docs.dim_team(teams))
        lake.replace("dim_venue", docs.dim_venue(teams))
        lake.replace("dim_competition", docs.dim_competition(teams))
        _people(lake, run, register, names)
        counts.update(output_count=ids.count())


def _people(lake: Lake, run: Run, register: DataFrame | None, names: DataFrame | None) -> None:
    """People tables from the register, and who of the matches is not in it."""
    if register is not None:
        lake.replace("dim_people", docs.people_dim(register))
        lake.replace("bridge_person_external_ids", external_ids(register))
    if names is not None:
        lake.replace("dim_person_names", docs.person_names(names))
    if lake.exists("dim_people") and lake.exists(REGISTRY):
        missing = docs.unresolved_people(lake.load(REGISTRY), lake.load("dim_people"))
        lake.replace("unresolved_people", missing.withColumn("run_id", F.lit(run.run_id)))


def external_ids(register: DataFrame) -> DataFrame:
    """Identifiers of other registers, one row per person and register."""
    long = unpivot_prefix(register, "key_", ["identifier"], "external_source", "external_id")
    return long.withColumnRenamed("identifier", "person_id")


# ------------------------------------------------------------------------ gold


def refresh_gold(lake: Lake, run: Run, touched: list[dict[str, object]], renewed: bool = False) -> list[dict[str, object]]:
    """Recompute the gold tables for the touched seasons, or for all where a table is missing.

    Cards start from the aggregates just written, not from the deliveries again.
    """
    with _task(lake, run, "refresh_gold") as counts:
        everything = renewed or run.full or not all(map(lake.exists, (BATTING, BOWLING, SUMMARY, LEAGUES, *CARDS)))
        pick = (lambda df: df) if everything else (lambda df: in_partitions(df, touched))

        def put(name: str, df: DataFrame) -> DataFrame:
            if everything:
                lake.replace(name, df, ["season"])
            else:
                lake.replace_partitions(name, df, ["season"], touched, reads_itself=False)
            return pick(lake.load(name))

        balls, matches = pick(lake.load(DELIVERIES)), pick(lake.load(MATCHES))
        batting = put(BATTING, gold.batting_stats(balls))
        bowling = put(BOWLING, gold.bowling_stats(balls, run.null_safe))
        summary = put(SUMMARY, gold.team_match_summary(balls))
        put(LEAGUES, gold.league_season_summary(matches, summary))
        put(PLAYER_CARDS, gold.player_cards(batting, bowling, run.null_safe))
        put(TEAM_CARDS, gold.team_season_cards(summary))
        put(FACTS, docs.match_facts(matches))
        counts.update(input_count=len(touched), output_count=4 + len(CARDS))
    return listed_partitions(lake.load(MATCHES).select("season").distinct()) if everything else touched


def split_tables(lake: Lake, run: Run, focus: DataFrame | list[str], touched: list[dict[str, object]]) -> None:
    """Focus and other tables of the three cards, for the touched seasons."""
    with _task(lake, run, "split_segments") as counts:
        for name in CARDS:
            for segment, rows in segments.split_segments(in_partitions(lake.load(name), touched), focus, run.focus_match).items():
                lake.replace_partitions(f"{name}_{segment}", rows, ["season"], touched, reads_itself=False)
        pick = lambda name: in_partitions(lake.load(name), touched)
        parts = lambda name: [pick(f"{name}_{segment}") for segment in (segments.FOCUS, segments.OTHER)]
        checks = [quality.check_split(pick(name), parts(name), f"serving_{name}_complete", name) for name in CARDS]
        results = materialise(quality.run_checks(checks, run.run_id), "quality")
        lake.append("quality_log", results)
        counts.update(input_count=len(CARDS), output_count=2 * len(CARDS))
        quality.gate(results, "serving")


# ------------------------------------------------------------------ validation


def validate(lake: Lake, run: Run, layer: str, touched: list[dict[str, object]]) -> None:
    """Checks of one layer over the touched seasons; results are saved before a failure is raised."""
    with _task(lake, run, f"validate_{layer}") as counts:
        pick = lambda name: in_partitions(lake.load(name), touched)
        if layer == "silver":
            arrived = docs.changed_in_run(lake.load(RAW), [run.run_id])
            entries = [quality.delivery_entries(pick(DELIVERIES), gold=False), *quality.silver_entries(pick(MATCHES), pick(WICKETS))]
            checks = list(quality.SILVER)
            if lake.exists("dim_people"):
                named = lake.load(REGISTRY).join(arrived.select("match_id"), "match_id", "left_semi")
                entries += quality.register_entries(named, lake.load("dim_people"))
                checks += quality.REGISTER
            found = [quality.fused_results(entries, checks), quality.check_latest_revision(arrived, lake.load(VERSIONS), "bronze_current_is_newest", RAW)]
        else:
            checks = list(quality.GOLD)
            found = [quality.fused_results([quality.season_entries(pick(DELIVERIES)), *quality.gold_entries(pick(BATTING), pick(BOWLING), pick(SUMMARY))], checks)]
        results = materialise(quality.run_checks(found, run.run_id), "quality")
        lake.append("quality_log", results)
        counts.update(input_count=len(checks) + len(found) - 1, output_count=len(checks) + len(found) - 1)
        quality.gate(results, layer)


# ------------------------------------------------------------------------- run


def run_lake(
    lake: Lake,
    run: Run,
    documents: DataFrame | None = None,
    register: DataFrame | None = None,
    focus_config: DataFrame | None = None,
    names: DataFrame | None = None,
    archives: str | None = None,
) -> DataFrame:
    """The whole run; returns its one-row summary. Starting a failed run again completes it.

    ``documents`` are scanned match documents, with their lineage if ``docs.attach_lineage`` has added it. A column ``part`` above
    0 marks texts that continue the match named by their ``match_id_candidate``; they may arrive before or after its document. ``register`` and
    ``names`` are the rows of the people and names files, if they arrived. ``archives`` is a folder of zips whose members
    are taken in as well; a register given apart goes before one in an archive.
    """
    spark = lake.spark
    started = _now()
    pending = _pending(lake)
    _log(lake, "run_log", schemas.RUN_LOG, run_id=run.run_id, run_mode=run.mode, status="RUNNING", started_at=started, recorded_at=started)
    if focus_config is None:
        focus_config = empty_table(spark, schemas.FOCUS_CONFIG)
    try:
        documents, register, names = _arrived(lake, run, documents, register, names, archives)
        focus = materialise(segments.focus_leagues(focus_config, run.focus), "focus")
        renewed = _settings(lake, run, focus)
        documents, later = _split(documents)
        taken = ingest_raw(lake, run, documents)
        if later is not None:
            ingest_continued(lake, run, later)
        changed = _changed(lake, run, taken, pending)
        unchanged = changed.isEmpty()
        if unchanged and not (renewed and lake.exists(FACTS)):
            for _, task in TASKS[2:]:
                with _task(lake, run, task):
                    if task == "build_dimensions":
                        _people(lake, run, register, names)
        else:
            touched = build_facts(lake, run, changed, pending)
            build_dimensions(lake, run, changed, register, names)
            validate(lake, run, "silver", touched)
            refreshed = refresh_gold(lake, run, touched, renewed)
            validate(lake, run, "gold", refreshed)
            split_tables(lake, run, focus, refreshed)
        _keep_settings(lake, run, focus)
    except Exception:
        _close(lake, run, started, "FAILED")
        raise
    summary = close_run(lake, run)
    status = summary.first()["status"]
    _close(lake, run, started, status)
    if status == "SUCCEEDED":
        for behind in pending:
            if behind != run.run_id:
                _close(lake, replace(run, run_id=behind), started, COMPLETED)
        tidy(lake, run)
    return summary


def _arrived(
    lake: Lake, run: Run, documents: DataFrame | None, register: DataFrame | None, names: DataFrame | None, archives: str | None
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """What was handed over and what the archives hold."""
    if archives is not None:
        found = open_archives(lake, run, archives)
        documents = found.documents if documents is None else documents.unionByName(found.documents, allowMissingColumns=True)
        return documents, register if register is not None else found.register, names if names is not None else found.names
    if documents is None:
        raise ValueError("neither documents nor archives")
    recorded = runlog.latest_task_rows(lake.load_or_empty("task_log", schemas.TASK_LOG), run.run_id)
    if recorded.where("task_name = 'extract_archives'").isEmpty():  # a caller may have opened archives for this run
        with _task(lake, run, "extract_archives"):
            pass
    return documents, register, names


def tidy(lake: Lake, run: Run) -> None:
    """Join what appends have scattered, and let old snapshots go."""
    for name in lake.tables():
        lake.compact(name, run.folders)
        lake.expire(name, run.keep_days * 86_400)


def _close(lake: Lake, run: Run, started: datetime, status: str) -> None:
    done = _now()
    _log(
        lake, "run_log", schemas.RUN_LOG, run_id=run.run_id, run_mode=run.mode, status=status,
        started_at=started, completed_at=done, recorded_at=done,
    )


def close_run(lake: Lake, run: Run) -> DataFrame:
    """Append table counts and the run summary."""
    spark = lake.spark
    count_log = lake.load_or_empty("table_count_log", schemas.TABLE_COUNT_LOG)
    tables = {name: lake.load(name) for name in COUNTED if lake.exists(name)}
    counted = runlog.table_counts(tables, count_log, run.run_id).withColumn("recorded_at", F.current_timestamp())
    lake.append("table_count_log", materialise(counted, "counts"))
    audit = lake.load("task_log", schemas.TASK_LOG)
    tasks = runlog.task_status(spark.createDataFrame(list(TASKS), "layer string, task_name string"), audit, run.run_id)
    summary = runlog.run_summary(
        lake.load_or_empty("archive_log", schemas.ARCHIVE_LOG),
        lake.load_or_empty("file_log", schemas.FILE_LOG),
        audit, tasks, run.run_id, "ingest_raw",
    )
    saved = materialise(summary.withColumn("recorded_at", F.current_timestamp()), "summary")
    lake.append("run_summaries", saved)
    return saved
