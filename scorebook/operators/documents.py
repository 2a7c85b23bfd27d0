"""Raw documents: shaping, parsing and the silver facts and dimensions."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorebook.functions import identity, names
from scorebook.operators.nested import Level, explode_map, explode_path
from scorebook.operators.upsert import latest_by_key, latest_where_repeated
from scorebook.schemas import CORRUPT, DOCUMENT

DIMS = ["league_group", "league_name", "gender", "season"]

_LINEAGE = ("zip_path", "zip_sha256", "file_sha256", "match_id_candidate")

PARSED = ["meta", "info", "innings"]

# Fixed column names and order of the published fact table.
MATCH_FACT_COLUMNS = [
    "match_id", *DIMS, "match_date", "match_type", "venue", "city", "team_1", "team_2", "toss_winner",
    "toss_decision", "winner", "win_by_runs", "win_by_wickets", "result", "players_of_match",
]


# ---------------------------------------------------------------- raw layer


def attach_lineage(documents: DataFrame, manifest: DataFrame) -> DataFrame:
    """Left join of scanned files with their manifest row on the path without its scheme."""
    wanted = manifest.select("extracted_path", *[c for c in _LINEAGE if c in manifest.columns])
    one_each = latest_by_key(wanted, ["extracted_path"], [F.col(c).desc_nulls_last() for c in wanted.columns[1:]])
    keyed = documents.withColumn("extracted_path", identity.strip_scheme(F.col("source_path")))
    return keyed.join(one_each, "extracted_path", "left").drop("extracted_path")


BROKEN, UNFIT = "text is not a match document", "fields that do not fit their types are NULL"


def parse_documents(documents: DataFrame, fields: Sequence[str] = PARSED) -> DataFrame:
    """Parse ``raw_json`` once into ``meta``, ``info``, ``innings``, or into those of them that are wanted.

    Text that is no JSON object is marked malformed, not dropped. In a valid document a field that does not fit its type is
    NULL and everything else stays; ``parse_error`` says so, and ``field_warnings`` which fields they are. Only texts that
    did not parse in full are looked at twice, to tell the two apart.
    """
    shape = T.StructType([DOCUMENT[name] for name in (*fields, CORRUPT)])
    record = F.from_json("raw_json", shape, {"columnNameOfCorruptRecord": CORRUPT})
    amiss = F.col(f"record.{CORRUPT}").isNotNull()
    whole = F.coalesce(F.schema_of_variant(F.try_parse_json(F.col("raw_json"))).startswith("OBJECT"), F.lit(False))
    broken = F.when(F.col("record").isNull(), True).when(amiss, ~whole).otherwise(False)
    # One step after the parse, so that text and record are copied once.
    return documents.select("*", record.alias("record")).select(
        *documents.columns,
        F.when(broken, "malformed").otherwise("valid").alias("record_status"),
        F.when(broken, F.lit(BROKEN)).when(amiss, F.lit(UNFIT)).alias("parse_error"),
        *[F.when(~broken, F.col(f"record.{name}")).alias(name) for name in fields],
    )


_WARNING = "match_id string, source_file_sha256 string, path string, expected string, value string"


Unfit = Callable[[object, list], None]


def _unfit(kind: T.DataType, path: str = "") -> Unfit | None:
    """What adds (path, type, value) of all in a value that does not fit ``kind``; anything can be read as text, and null fits all."""
    if isinstance(kind, T.StringType):
        return None
    if isinstance(kind, T.StructType):
        named = [(field.name, _unfit(field.dataType, f"{path}.{field.name}" if path else field.name)) for field in kind.fields]
        return _nested(path, "object", dict, [(name, look) for name, look in named if look])
    if isinstance(kind, T.ArrayType):
        return _nested(path, "list", list, _unfit(kind.elementType, path))
    if isinstance(kind, T.MapType):
        return _nested(path, "object", dict, _unfit(kind.valueType, path))
    shown = kind.simpleString()

    def number(value: object, found: list) -> None:
        if value is not None and (type(value) is not int or not -(2**31) <= value < 2**31):
            found.append((path, shown, value))

    return number


def _nested(path: str, shown: str, kind: type, inner: Unfit | list[tuple[str, Unfit]] | None) -> Unfit:
    def look(value: object, found: list) -> None:
        if value is None:
            return
        if not isinstance(value, kind):
            found.append((path, shown, value))
        elif isinstance(inner, list):
            for name, test in inner:
                if name in value:
                    test(value[name], found)
        elif inner is not None:
            for item in value if kind is list else value.values():
                inner(item, found)

    return look


def _warn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [name.split()[0] for name in _WARNING.split(", ")]
    look = _unfit(DOCUMENT)
    for batch in batches:
        rows = []
        for match_id, digest, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            found: list[tuple[str, str, object]] = []
            look(json.loads(text, strict=False), found)
            rows.extend((match_id, digest, path, kind, json.dumps(value)[:200]) for path, kind, value in found)
        yield pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], pa.string()) for i in range(len(names))], names=names)


def field_warnings(raw: DataFrame) -> DataFrame:
    """One row per field that did not fit its type: ``match_id``, ``source_file_sha256``, ``path``, ``expected``, ``value``.

    ``raw`` has the shaped rows with their text; only those marked by ``parse_documents`` are read again.
    """
    marked = raw.where((F.col("record_status") == "valid") & (F.col("parse_error") == UNFIT))
    return marked.select("match_id", "source_file_sha256", "raw_json").mapInArrow(_warn, _WARNING)


def _with_lineage(documents: DataFrame) -> DataFrame:
    absent = {name: F.lit(None).cast("string") for name in _LINEAGE if name not in documents.columns}
    return documents.withColumns(absent) if absent else documents


def identify(documents: DataFrame) -> DataFrame:
    """``source_path``, ``match_id``, ``source_file_sha256`` of each document, from its text and without parsing it whole."""
    raw = F.col("raw_json")
    named = F.coalesce(F.col("match_id_candidate"), F.col("source_path"))
    return _with_lineage(documents).select(
        "source_path", identity.stable_id(raw, named)["match_id"].alias("match_id"), F.coalesce("file_sha256", F.sha2(raw, 256)).alias("source_file_sha256")
    )


def shape_raw(parsed: DataFrame, run_id: str) -> DataFrame:
    """Parsed documents ``(source_path, raw_json[, lineage][, part])`` -> raw records with id, hash, revision and
    run columns, followed by the part of the match a text is, if that is told, and the parsed structs."""
    parsed = _with_lineage(parsed)
    raw = F.col("raw_json")
    named = F.coalesce(F.col("match_id_candidate"), F.col("source_path"))
    return parsed.withColumn("id", identity.stable_id(raw, named)).select(
        F.col("id.match_id").alias("match_id"),
        F.col("id.match_id_rule").alias("match_id_rule"),
        "raw_json",
        identity.file_name(F.col("source_path")).alias("source_file"),
        "source_path",
        "zip_path",
        "zip_sha256",
        F.coalesce("file_sha256", F.sha2(raw, 256)).alias("source_file_sha256"),
        # Unknown stays unknown here: it is not an older revision than any other.
        F.col("meta.revision").alias("source_revision"),
        F.col("meta.data_version").alias("data_version"),
        F.col("meta.created").try_cast("date").alias("source_created_date"),
        F.lit(run_id).alias("ingestion_run_id"),
        F.lit(run_id).alias("pipeline_run_id"),
        F.current_timestamp().alias("ingestion_timestamp"),
        F.current_date().alias("ingestion_date"),
        "record_status",
        "parse_error",
        *[name for name in ("part", *PARSED) if name in parsed.columns],
    )


def current_documents(latest: DataFrame, versions: DataFrame) -> DataFrame:
    """Rows with text of the current version of each match."""
    return versions.join(latest.select("match_id", "source_file_sha256"), ["match_id", "source_file_sha256"], "left_semi")


def changed_in_run(df: DataFrame, run_ids: Sequence[str]) -> DataFrame:
    """Rows written by the given runs: the change feed of the raw layer."""
    return df.where(F.col("pipeline_run_id").isin(*run_ids))


def in_leagues(parsed: DataFrame, leagues: Sequence[str]) -> DataFrame:
    """Keep listed competitions, tested on the parsed struct before anything is exploded."""
    return parsed.where(F.col("info.event.name").isin(*leagues)) if leagues else parsed


# ------------------------------------------------------------ silver facts


def _first_date() -> Column:
    return F.try_element_at("info.dates", F.lit(1)).try_cast("date")


def _shared() -> dict[str, Column]:
    league = F.col("info.event.name")
    return {
        # An empty season is stored as no season; saying so here keeps partitions and their rows in step.
        "season": F.nullif(F.col("info.season"), F.lit("")),
        "league_name": league,
        "league_group": names.bucket_by_rules(league),
        "gender": F.col("info.gender"),
        "match_date": _first_date(),
        "venue": F.col("info.venue"),
    }


# Fixed column names and order of the published match table, after its id and before its league group.
def _match_columns() -> dict[str, Column]:
    shared = _shared()
    return {
        "source_file": F.col("source_file"),
        "data_version": F.col("meta.data_version"),
        "source_created_date": F.col("meta.created").try_cast("date"),
        "source_revision": F.col("meta.revision"),
        "match_date": shared["match_date"],
        "season": shared["season"],
        "league_name": shared["league_name"],
        "event_match_number": F.col("info.event.match_number"),
        "match_type": F.col("info.match_type"),
        "gender": shared["gender"],
        "city": F.col("info.city"),
        "venue": shared["venue"],
        "teams": F.col("info.teams"),
        "team_1": F.try_element_at("info.teams", F.lit(1)),
        "team_2": F.try_element_at("info.teams", F.lit(2)),
        "toss_winner": F.col("info.toss.winner"),
        "toss_decision": F.col("info.toss.decision"),
        "winner": F.col("info.outcome.winner"),
        "win_by_runs": F.col("info.outcome.by.runs"),
        "win_by_wickets": F.col("info.outcome.by.wickets"),
        "result": F.col("info.outcome.result"),
        "players_of_match": F.col("info.player_of_match"),
        "pipeline_run_id": F.col("pipeline_run_id"),
        "ingestion_timestamp": F.col("ingestion_timestamp"),
        # Hash of the file, taken when it arrived: the text itself need not be read again.
        "match_record_hash": F.col("source_file_sha256"),
        "league_group": shared["league_group"],
    }


def build_matches(parsed: DataFrame) -> DataFrame:
    """One row per match with its competition, teams, toss and outcome."""
    rows = parsed.select("match_id", *[value.alias(name) for name, value in _match_columns().items()])
    newest = [F.col(c).desc_nulls_last() for c in ("source_revision", "ingestion_timestamp", "match_record_hash")]
    return latest_where_repeated(rows, ["match_id"], newest)


def build_deliveries(parsed: DataFrame) -> DataFrame:
    """One row per ball. Matches, innings and overs without balls stay visible as one row of NULLs.

    Numbers go by position; a text that continues a match carries those it goes on from.
    """
    league = F.col("info.event.name")
    head = parsed.select(
        "match_id",
        "pipeline_run_id",
        *[expr.alias(name) for name, expr in _shared().items()],
        league.alias("competition_name"),
        "innings",
    )
    balls = explode_path(
        head,
        [
            Level("innings", "inning", {"batting_team": "team", "carried_index": "index"}),
            Level("inning.overs", "over", {"over_number": "over", "carried_first": "first"}),
            Level("over.deliveries", "delivery"),
        ],
    )
    same_name = ("actual_delivery", "batter", "bowler", "non_striker", "extras", "wickets")
    scores = {"batter_runs": "batter", "extras_runs": "extras", "total_runs": "total"}
    return (
        balls.withColumnRenamed("inning_index", "innings_index")
        .withColumns({
            "innings_index": F.coalesce("carried_index", "innings_index"),
            "delivery_index": F.col("delivery_index") + F.coalesce("carried_first", F.lit(0)),
        })
        .withColumns({
            "innings_number": F.col("innings_index") + 1,
            "delivery_sequence": F.col("delivery_index") + 1,
            **{name: F.col(f"delivery.{name}") for name in same_name},
            **{name: F.col(f"delivery.runs.{source}") for name, source in scores.items()},
        })
        .drop("over_index", "delivery", "carried_index", "carried_first")
    )


def build_wickets(deliveries: DataFrame) -> DataFrame:
    """One row per dismissal; ``wicket_index`` completes the key."""
    at = ["match_id", "pipeline_run_id", *DIMS, "competition_name", "match_date", "innings_index", "innings_number"]
    ball = ["batting_team", "over_number", "delivery_index", "delivery_sequence", "actual_delivery", "batter", "bowler"]
    fallen = explode_path(
        deliveries.select(*at, *ball, "wickets"),
        [Level("wickets", "wicket", {"wicket_kind": "kind", "player_out": "player_out", "fielders": "fielders"})],
        outer=False,
    )
    return fallen.where(F.col("wicket").isNotNull()).drop("wicket")


def match_facts(matches: DataFrame) -> DataFrame:
    return matches.select(*MATCH_FACT_COLUMNS)


# -------------------------------------------------- silver dimensions, people


def match_teams(parsed: DataFrame) -> DataFrame:
    """One row per match: competition, place, dates and team arrays."""
    info = parsed.select("match_id", "source_file", "info.*").withColumn("league_name", F.col("event.name"))
    return info.select("match_id", "league_name", "gender", "season", "venue", "city", "dates", "teams", "source_file")


def build_dim(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """True dimension: one row per natural key with first and last season and its match count."""
    return records.groupBy(*keys).agg(
        F.min("season").alias("first_season"),
        F.max("season").alias("last_season"),
        F.count_distinct("match_id").alias("matches"),
    )


def dim_team(teams: DataFrame) -> DataFrame:
    rows = teams.select("match_id", "season", F.explode("teams").alias("team_name"))
    return build_dim(rows, ["team_name"])


def dim_venue(teams: DataFrame) -> DataFrame:
    return build_dim(teams.where(F.col("venue").isNotNull()), ["venue", "city"])


def dim_competition(teams: DataFrame) -> DataFrame:
    return build_dim(teams.where(F.col("league_name").isNotNull()), ["league_name", "gender"])


def build_person_registry(parsed: DataFrame) -> DataFrame:
    """One row per person named in a match registry."""
    people = parsed.select("match_id", "source_file", F.col("info.registry.people").alias("people"))
    return explode_map(people, "people", "person_name", "person_id").withColumn("source_role", F.lit("registry"))


def people_dim(register: DataFrame) -> DataFrame:
    """Register rows with the complete row archived as JSON."""
    archived = F.to_json(F.struct(*[F.col(f"`{name}`") for name in register.columns]))
    return register.select("identifier", "name", "unique_name", "source_file", archived.alias("raw_json"))


def person_names(listed: DataFrame) -> DataFrame:
    """Other names of people as the register lists them: all columns, equal rows once."""
    return listed.distinct()


def unresolved_people(registry: DataFrame, people: DataFrame) -> DataFrame:
    """Registry entries whose id the people dimension does not know."""
    known = people.select(F.col("identifier").alias("person_id"))
    return registry.join(known, "person_id", "left_anti").select("match_id", "person_name", "source_role", "source_file")
