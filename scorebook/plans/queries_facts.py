"""Queries over raw documents, silver facts, dimensions and people."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.functions import identity, names, rules
from scorebook.operators import documents as docs
from scorebook.operators import gold
from scorebook.operators.nested import unpivot_prefix
from scorebook.operators.upsert import latest_by_key
from scorebook.plans import oracle as sql
from scorebook.plans import workload
from scorebook.plans.daily_run import DELIVERIES, MATCHES, WICKETS
from scorebook.plans.registry import query
from scorebook.session import materialise
from scorebook.plans.workload import RUN_ID, demo_lake, table
from scorebook.sources import files


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workload.texts(demo_lake(spark, sf_dir))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed again from the text, so that the query covers the JSON path itself."""
    return docs.shape_raw(docs.parse_documents(_texts(spark, sf_dir)), RUN_ID)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows for readers of what a document says of its match."""
    return workload.parsed(demo_lake(spark, sf_dir), fields=["meta", "info"])


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demo_lake(spark, sf_dir).load(DELIVERIES)


def big(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("bigint") for name in columns})


def nested_sum(of: str, column: str = "innings"):
    """Sum over all balls of a document without exploding it."""
    balls = F.flatten(F.flatten(F.transform(column, lambda i: F.transform(i["overs"], lambda o: o["deliveries"]))))
    pick = {"balls": lambda b: F.lit(1), "runs": lambda b: b["runs"]["total"]}[of]
    return F.aggregate(balls, F.lit(0).cast("bigint"), lambda total, ball: total + pick(ball))


# ---------------------------------------------------------------- raw documents


@query(f"""
{sql.with_(sql.BALLS)}
SELECT m.match_id, 'filename_stem' AS match_id_rule, m.match_id || '.json' AS source_file, 1::BIGINT AS source_revision,
  '1.1.0' AS data_version, m.match_date AS source_created_date, 'valid' AS record_status,
  {sql.big('count(d.match_id)', 'balls')}, {sql.big('coalesce(sum(d.total_runs), 0)', 'runs')}
FROM m LEFT JOIN d ON d.match_id = m.match_id GROUP BY m.match_id, m.match_date
""")
def raw_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to record: ids, revision, status, and the contents counted inside the nested value."""
    return _parsed(spark, sf_dir).select(
        "match_id", "match_id_rule", "source_file", F.col("source_revision").cast("bigint").alias("source_revision"),
        "data_version", "source_created_date", "record_status",
        nested_sum("balls").alias("balls"), nested_sum("runs").alias("runs"),
    )


@query(f"""
{sql.with_(sql.BALLS)},
n AS (SELECT m.match_id, CAST(m.match_id AS BIGINT) AS key, count(d.match_id) AS balls FROM m LEFT JOIN d ON d.match_id = m.match_id GROUP BY m.match_id),
w AS (
  SELECT 'innings.overs.deliveries.runs.total' AS path, 'int' AS expected, balls AS fields, balls FROM n WHERE key % 5 = 0 AND balls > 0
  UNION ALL SELECT 'meta.revision', 'int', 1, balls FROM n WHERE key % 7 = 0
  UNION ALL SELECT 'info.teams', 'list', 1, balls FROM n WHERE key % 11 = 0
)
SELECT path, expected, {sql.big('sum(fields)', 'warnings')}, {sql.big('count(*)', 'matches')}, {sql.big('sum(balls)', 'balls')} FROM w GROUP BY path, expected
""")
def field_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with fields of another type: which fields, in how many matches, and the balls these keep in the facts.

    Texts that continue a match repeat what its document says of it, so of their fields only those of the innings count.
    """
    lake, text, key = demo_lake(spark, sf_dir), F.col("raw_json"), F.col("key")
    for divisor, found, put in ((5, '"total":([0-9]+)', '"total":$1.5'), (7, '"revision":1', '"revision":"one"'), (11, '"teams":\\[[^\\]]*\\]', '"teams":"two"')):
        text = F.when(key % divisor == 0, F.regexp_replace(text, found, put)).otherwise(text)

    def marked(part: str) -> DataFrame:
        """Only marked texts have warnings, and balls that are asked for. Told apart in one look: a filter would parse them twice."""
        changed = lake.load(workload.PARTS).where(part).select("source_path", text.alias("raw_json"), F.when(F.col("part") > 0, key.cast("string")).alias("match_id_candidate"))
        raw = docs.shape_raw(docs.parse_documents(changed), RUN_ID)
        return materialise(raw.select(F.inline(F.when(F.col("parse_error") == docs.UNFIT, F.array(F.struct(*raw.columns))))), "warned")

    own, later = marked("part = 0"), marked("part > 0")
    found = docs.field_warnings(own).unionByName(docs.field_warnings(later).where(F.col("path").startswith("innings")))
    warned = found.groupBy("path", "expected", "match_id").agg(F.count("*").alias("fields"))
    balls = docs.build_deliveries(own.unionByName(later)).groupBy("match_id").agg(F.count("batter").alias("balls"))
    return warned.join(balls, "match_id", "left").groupBy("path", "expected").agg(
        F.sum("fields").alias("warnings"), F.count("*").alias("matches"), F.sum(F.coalesce("balls", F.lit(0))).alias("balls")
    )


@query(f"""
{sql.with_(sql.MATCHES)},
j AS (
  SELECT match_id, '{{"city":"' || city || '","data_version":"1.1.0","dates":["' || strftime(match_date, '%Y-%m-%d') || '"],"event":'
    || CASE WHEN league_name IS NULL THEN 'null' ELSE '{{"match_number":"' || match_id || '","name":"' || league_name || '"}}' END
    || ',"teams":["' || team_1 || '","' || team_2 || '"],"venue":"' || venue || '"}}' AS attributes
  FROM m
)
SELECT match_id AS number, 'fallback_' || substr(sha256(attributes), 1, 32) AS fallback_id, match_id AS stem_id FROM j
""")
def stable_id_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both id rules on every document: a numeric file name, and a name that says nothing."""
    hashed = identity.stable_id(F.col("raw_json"), F.lit("scoresheet.json"))
    numbered = identity.stable_id(F.col("raw_json"), F.col("source_path"))
    return _texts(spark, sf_dir).select(
        identity.file_stem(F.col("source_path")).alias("number"),
        hashed["match_id"].alias("fallback_id"),
        numbered["match_id"].alias("stem_id"),
    )


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One extracted file per finished or open order, listed once per priority mark of the order."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    repeats = F.explode(F.sequence(F.lit(1), F.substring("o_orderpriority", 1, 1).cast("int")))
    key = F.col("o_orderkey").cast("string")
    return orders.select("*", repeats.alias("copy")).select(
        F.concat(F.lit("/landing/"), key, F.lit(".json")).alias("extracted_path"),
        F.concat(F.lit("/zips/"), F.col("o_custkey"), F.lit(".zip")).alias("zip_path"),
        F.concat(F.lit("z"), F.col("o_custkey")).alias("zip_sha256"),
        F.concat(F.lit("h"), key).alias("file_sha256"),
        F.concat(key, F.lit(".json")).alias("match_id_candidate"),
        F.lit(".json").alias("file_extension"),
        F.concat(key, F.lit(".json")).alias("source_filename"),
        F.when(F.col("o_orderstatus") == "F", "extracted").otherwise("failed").alias("extraction_status"),
        F.concat(F.lit("run-"), F.date_format("o_orderdate", "yyyy")).alias("run_id"),
    )


@query("""
SELECT 'file:/landing/' || o_orderkey || '.json' AS source_path,
  CASE WHEN o_orderstatus <> 'P' THEN '/zips/' || o_custkey || '.zip' END AS zip_path,
  CASE WHEN o_orderstatus <> 'P' THEN 'h' || o_orderkey END AS file_sha256
FROM orders
""")
def lineage_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scanned files with their manifest row, where there is one."""
    joined = docs.attach_lineage(_texts(spark, sf_dir).select("source_path"), _manifest(spark, sf_dir))
    return joined.select("source_path", "zip_path", "file_sha256")


@query("""
SELECT '/landing/' || o_orderkey || '.json' AS extracted_path FROM orders
WHERE o_orderstatus = 'F' AND strftime(o_orderdate, '%Y') = '1998'
""")
def select_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct extracted documents of one run."""
    return files.select_inputs(_manifest(spark, sf_dir), "run-1998")


# ------------------------------------------------------------------------ facts


@query(f"""
{sql.with_(sql.MATCHES)}
SELECT match_id, match_id || '.json' AS source_file, '1.1.0' AS data_version, match_date AS source_created_date,
  1::BIGINT AS source_revision, match_date, season, league_name, CASE WHEN league_name IS NOT NULL THEN match_id END AS event_match_number,
  match_type, gender, city, venue, team_1 || '|' || team_2 AS teams, team_1, team_2, toss_winner, toss_decision, winner,
  {sql.big('win_by_runs', 'win_by_runs')}, {sql.big('win_by_wickets', 'win_by_wickets')}, result, players_of_match, league_group
FROM m
""")
def match_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = docs.build_matches(_parsed(spark, sf_dir)).drop("pipeline_run_id", "ingestion_timestamp", "match_record_hash")
    joined = {name: F.array_join(name, "|") for name in ("teams", "players_of_match")}
    return big(flat.withColumns(joined), "source_revision", "win_by_runs", "win_by_wickets")


@query(f"""
{sql.with_(sql.MATCHES)}
SELECT match_id, {sql.DIMS}, match_date, match_type, venue, city, team_1, team_2, toss_winner, toss_decision, winner,
  {sql.big('win_by_runs', 'win_by_runs')}, {sql.big('win_by_wickets', 'win_by_wickets')}, result, players_of_match
FROM m
""")
def match_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = docs.match_facts(demo_lake(spark, sf_dir).load(MATCHES))
    facts = facts.withColumn("players_of_match", F.array_join("players_of_match", "|"))
    return big(facts, "win_by_runs", "win_by_wickets")


@query(f"""
{sql.with_(sql.MATCHES)}
SELECT league_name, league_group, {sql.big('count(*)', 'matches')} FROM m GROUP BY 1, 2
""")
def league_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = demo_lake(spark, sf_dir).load(MATCHES).select("league_name")
    grouped = names.bucket_by_rules(F.col("league_name")).alias("league_group")
    return matches.select("league_name", grouped).groupBy("league_name", "league_group").agg(F.count("*").alias("matches"))


@query(f"""
{sql.with_(sql.MATCHES)}
SELECT match_id, CASE WHEN league_name LIKE 'The Hundred%' THEN 'The Hundred' WHEN league_name LIKE '%Big Bash%' THEN 'Big Bash League'
    ELSE coalesce(league_name, 'Unknown') END AS bucket,
  coalesce(league_name <> 'County Cup', false) AS is_focus
FROM m
""")
def competition_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-way containment of normalised names against the default focus list."""
    matches = demo_lake(spark, sf_dir).load(MATCHES)
    found = names.competition_bucket(F.col("league_name"), names.DEFAULT_FOCUS)
    return matches.select("match_id", found.alias("found")).select("match_id", "found.bucket", "found.is_focus")


@query("""
SELECT doc_id, md5(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) AS digest FROM documents
""")
def name_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name normaliser on whole document texts."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(names.normalise_name(F.col("text"))).alias("digest"))


_BALL = """match_id, season, league_name, league_group, gender, match_date, venue, batting_team, over_number, delivery_index,
  innings_number, delivery_sequence, actual_delivery, batter, bowler, non_striker, batter_runs, extras_runs, total_runs, wides, noballs, legbyes, kinds"""
_BALL_INTS = (
    "over_number", "delivery_index", "innings_number", "delivery_sequence", "batter_runs", "extras_runs", "total_runs",
    "wides", "noballs", "legbyes",
)


@query(f"""
{sql.with_(sql.BALLS)}
SELECT match_id, season, league_name, league_group, gender, match_date, venue, batting_team, actual_delivery, batter, bowler, non_striker,
  {', '.join(sql.big('delivery_sequence - 1' if c == 'delivery_index' else c, c) for c in _BALL_INTS)},
  CASE WHEN fallen = 1 THEN wicket_kind || ':' || batter || ':' || fielder END AS kinds
FROM d
""")
def deliveries_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to balls: parse, three positional explodes, every field of every ball."""
    balls = gold.real_balls(docs.build_deliveries(_parsed(spark, sf_dir)))
    fallen = F.transform("wickets", lambda w: F.concat_ws(":", w["kind"], w["player_out"], F.array_join(w["fielders"]["name"], "+")))
    flat = balls.select("*", "extras.*").withColumn("kinds", F.array_join(fallen, "|"))
    return big(flat.select(*[c.strip() for c in _BALL.split(",")]), *_BALL_INTS)


@query(f"""
{sql.with_(sql.BALLS)}
SELECT match_id, {sql.DIMS}, match_date, batting_team, batter, bowler, wicket_kind, batter AS player_out, fielder AS fielders,
  {', '.join(sql.big(c, c) for c in ('innings_number', 'over_number', 'delivery_sequence'))}, 0::BIGINT AS wicket_index
FROM d WHERE fallen = 1
""")
def wickets_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    fallen = docs.build_wickets(docs.build_deliveries(_parsed(spark, sf_dir)))
    shown = fallen.withColumn("fielders", F.array_join("fielders.name", "+")).select(
        "match_id", *docs.DIMS, "match_date", "batting_team", "batter", "bowler", "wicket_kind", "player_out", "fielders",
        "innings_number", "over_number", "delivery_sequence", "wicket_index",
    )
    return big(shown, "innings_number", "over_number", "delivery_sequence", "wicket_index")


@query(f"""
{sql.with_(sql.BALLS)}
SELECT match_id, {sql.big('innings_number', 'innings_number')}, {sql.big('over_number', 'over_number')},
  {sql.big('max(delivery_sequence)', 'last_sequence')}, {sql.big('count(*)', 'balls')}
FROM d GROUP BY match_id, innings_number, over_number
""")
def delivery_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = gold.real_balls(_deliveries(spark, sf_dir)).groupBy("match_id", "innings_number", "over_number")
    counted = numbered.agg(F.max("delivery_sequence").alias("last_sequence"), F.count("*").alias("balls"))
    return big(counted, "innings_number", "over_number", "last_sequence")


@query(f"""
{sql.with_(sql.MATCHES)}
SELECT match_id, season, league_name FROM m WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = m.k)
""")
def phantom_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches that the outer explode keeps although they have no ball."""
    return _deliveries(spark, sf_dir).where(F.col("delivery_index").isNull()).select("match_id", "season", "league_name")


@query(f"""
{sql.with_(sql.BALLS)}
SELECT {sql.DIMS}, {sql.big('sum(legal)', 'legal')}, {sql.big('sum(1 - legal)', 'illegal')} FROM d GROUP BY {sql.DIMS}
""")
def legal_ball_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    legal = rules.is_legal_ball(F.col("extras"))
    balls = gold.real_balls(_deliveries(spark, sf_dir)).groupBy(*docs.DIMS)
    return balls.agg(F.count_if(legal).alias("legal"), F.count_if(~legal).alias("illegal"))


@query(f"""
{sql.with_(sql.BALLS)}
SELECT bowler, {sql.big('sum(total_runs)', 'total')}, {sql.big('sum(total_runs - coalesce(legbyes, 0))', 'charged')} FROM d GROUP BY bowler
""")
def runs_charged(spark: SparkSession, sf_dir: str) -> DataFrame:
    balls = gold.real_balls(_deliveries(spark, sf_dir)).groupBy("bowler")
    charged = rules.runs_charged(F.col("total_runs"), F.col("extras"))
    return balls.agg(F.sum("total_runs").alias("total"), F.sum(charged).alias("charged"))


# ------------------------------------------------------------ dimensions, people


@query(f"""
{sql.with_(sql.MATCHES)}
SELECT match_id, league_name, gender, season, venue, city, strftime(match_date, '%Y-%m-%d') AS dates, team_1 || '|' || team_2 AS teams,
  match_id || '.json' AS source_file
FROM m
""")
def match_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _teams(spark, sf_dir)
    return rows.withColumns({name: F.array_join(name, "|") for name in ("dates", "teams")})


def _dimension(keys: str, source: str = "m", where: str = "true") -> str:
    return f"""
{sql.with_(sql.MATCHES)},
t AS (SELECT *, unnest([team_1, team_2]) AS team_name FROM m)
SELECT {keys}, min(season) AS first_season, max(season) AS last_season, {sql.big('count(DISTINCT match_id)', 'matches')}
FROM {source} WHERE {where} GROUP BY {keys}
"""


def _teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.match_teams(_raw(spark, sf_dir))


@query(_dimension("team_name", "t"))
def dim_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.dim_team(_teams(spark, sf_dir))


@query(_dimension("venue, city", where="venue IS NOT NULL"))
def dim_venue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.dim_venue(_teams(spark, sf_dir))


@query(_dimension("league_name, gender", where="league_name IS NOT NULL"))
def dim_competition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.dim_competition(_teams(spark, sf_dir))


_PEOPLE_SQL = f"""
{sql.with_(sql.MATCHES)},
p AS (SELECT match_id, match_id || '.json' AS source_file, buyer, unnest([0, 1, 2, 3]) AS i FROM m),
r AS (SELECT match_id, source_file, 'Person ' || buyer || ' ' || i AS person_name, 'id' || (buyer * 4 + i) AS person_id, 'registry' AS source_role FROM p)
"""


@query(f"{_PEOPLE_SQL} SELECT * FROM r")
def person_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.build_person_registry(_raw(spark, sf_dir))


def _register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as a people register, with some external keys blank or missing."""
    who = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return who.select(
        F.concat(F.lit("id"), key).alias("identifier"),
        F.col("c_name").alias("name"),
        F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")")).alias("unique_name"),
        F.when(key % 3 == 0, key.cast("string")).otherwise("  ").alias("key_alpha"),
        F.when(key % 2 == 0, F.concat(F.lit("b"), key)).alias("key_beta"),
        F.col("c_nationkey").cast("string").alias("key_gamma"),
        F.lit("people.csv").alias("source_file"),
    )


@query("""
WITH c AS (SELECT 'id' || c_custkey AS person_id, c_custkey AS k, c_nationkey AS n FROM customer)
SELECT person_id, 'alpha' AS external_source, CAST(k AS VARCHAR) AS external_id FROM c WHERE k % 3 = 0
UNION ALL SELECT person_id, 'beta', 'b' || k FROM c WHERE k % 2 = 0
UNION ALL SELECT person_id, 'gamma', CAST(n AS VARCHAR) FROM c
""")
def unpivot_external_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = unpivot_prefix(_register(spark, sf_dir), "key_", ["identifier"], "external_source", "external_id")
    return long.withColumnRenamed("identifier", "person_id")


@query("""
SELECT 'id' || c_custkey AS identifier, c_name AS name, c_name || ' (' || c_mktsegment || ')' AS unique_name, 'people.csv' AS source_file,
  '{"identifier":"id' || c_custkey || '","name":"' || c_name || '","unique_name":"' || c_name || ' (' || c_mktsegment || ')","key_alpha":"'
  || CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE '  ' END || '"'
  || CASE WHEN c_custkey % 2 = 0 THEN ',"key_beta":"b' || c_custkey || '"' ELSE '' END
  || ',"key_gamma":"' || c_nationkey || '","source_file":"people.csv"}' AS raw_json
FROM customer
""")
def people_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.people_dim(_register(spark, sf_dir))


@query(f"""{_PEOPLE_SQL}
SELECT match_id, person_name, source_role, source_file FROM r
WHERE person_id NOT IN (SELECT 'id' || c_custkey FROM customer WHERE c_acctbal >= 0)
""")
def unresolved_people_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against a register that does not list customers in debt."""
    owing = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0).select(F.concat(F.lit("id"), "c_custkey").alias("identifier"))
    people = docs.people_dim(_register(spark, sf_dir)).join(owing, "identifier", "left_anti")
    return docs.unresolved_people(docs.build_person_registry(_raw(spark, sf_dir)), people)


# --------------------------------------------------------- other given tables


@query("""
SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(count(*) AS BIGINT) AS events FROM events GROUP BY 1, 2
""")
def props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field of a JSON text column, grouped."""
    k = F.get_json_object("props", "$.k").try_cast("bigint").alias("k")
    return table(spark, sf_dir, "events").groupBy("event_type", k).agg(F.count("*").alias("events"))


@query("""
SELECT min(doc_id) AS doc_id, sha256(text) AS sha256 FROM documents GROUP BY 2
""")
def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per content hash, the lowest id of each group of copies."""
    hashed = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return latest_by_key(hashed, ["sha256"], [F.col("doc_id").asc()])


@query(f"""
{sql.with_(sql.BALLS)}
SELECT match_id, innings_number::BIGINT AS innings_number, over_number::BIGINT AS over_number, delivery_sequence::BIGINT AS delivery_sequence,
  batter, bowler, wicket_kind, 0::BIGINT AS wicket_index
FROM d WHERE fallen = 1 AND innings_number = 1
  AND match_id = (SELECT match_id FROM d WHERE fallen = 1 AND innings_number = 1 GROUP BY match_id ORDER BY count(*) DESC, match_id LIMIT 1)
""")
def innings_wickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dismissals of the first innings with the most of them, in playing order."""
    wickets = demo_lake(spark, sf_dir).load(WICKETS)
    first = wickets.where(F.col("innings_number") == 1).groupBy("match_id").count()
    chosen = first.orderBy(F.col("count").desc(), "match_id").select("match_id").first()["match_id"]
    rows = gold.innings_wickets(wickets, chosen, 1).select(
        "match_id", "innings_number", "over_number", "delivery_sequence", "batter", "bowler", "wicket_kind", "wicket_index"
    )
    return big(rows, "innings_number", "over_number", "delivery_sequence", "wicket_index")
