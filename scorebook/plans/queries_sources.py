"""Queries over file scans, register files, appended tables, the change feed and the gold refresh."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.functions import names
from scorebook.operators import documents as docs
from scorebook.operators import upsert
from scorebook.plans import daily_run, workload
from scorebook.plans import oracle as sql
from scorebook.plans.queries_runs import _KEY, _delivered
from scorebook.plans.registry import ORACLES, query
from scorebook.plans.workload import demo_lake, table, write_archives, write_files
from scorebook.session import shared_dir
from scorebook.sources import archives, files
from scorebook.sources.tables import Lake, ensure_columns
from scorebook.streaming.ingest import ingest_stream, stream_batch

#: Most documents in one file of a stream.
FILE_ROWS = 250_000


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/scorebook/{name}-{uuid.uuid4().hex}"


@query("""
SELECT page_id, sha256(html) AS sha256, CAST(length(html) AS BIGINT) AS n_chars, page_id || '.html' AS file_name FROM pages
""")
def file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a file of its own in hashed folders, scanned whole: name, digest and length of each."""
    folder = _folder(spark, "files")
    write_files(table(spark, sf_dir, "pages").select(F.concat("page_id", F.lit(".html")).alias("name"), F.col("html").alias("text")), folder)
    scanned = files.read_documents(spark, f"{folder}/*")
    name = F.element_at(F.split("source_path", "/"), -1)
    return scanned.select(
        F.regexp_extract(name, "^([0-9]+)", 1).cast("bigint").alias("page_id"), F.sha2("raw_json", 256).alias("sha256"),
        F.length("raw_json").cast("bigint").alias("n_chars"), name.alias("file_name"),
    )


@query(f"""
{sql.with_(sql.BALLS)}
SELECT m.match_id, 1::BIGINT AS revision, count(d.match_id) AS balls, coalesce(sum(d.total_runs), 0)::BIGINT AS runs FROM m LEFT JOIN d ON d.match_id = m.match_id GROUP BY m.match_id
""")
def stream_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts of the matches through the stream in bounded batches, the first one handed over again: the facts of one whole run."""
    base = _folder(spark, "stream")
    texts = workload.every_text(demo_lake(spark, sf_dir))
    # Four files or as many as the data asks for, taken in by two batches.
    most = min(FILE_ROWS, max(1, -(-texts.count() // 4)))
    texts.write.option("maxRecordsPerFile", most).option("compression", "zstd").parquet(f"{base}/landing")
    landed = spark.read.parquet(f"{base}/landing").select(F.col("_metadata.file_path").alias("file")).agg(F.count_distinct("file")).first()[0]
    lake = Lake(spark, f"{base}/lake")
    ingest_stream(lake, f"{base}/landing", f"{base}/checkpoint", max_files=-(-landed // 2), form="parquet", buckets=2).awaitTermination()
    stream_batch(lake, f"{base}/checkpoint", "stream", {})(texts.limit(0), 0)
    balls = lake.load(daily_run.DELIVERIES).groupBy("match_id").agg(F.count("batter").alias("balls"), F.coalesce(F.sum("total_runs"), F.lit(0)).cast("bigint").alias("runs"))
    return lake.load(daily_run.RAW).select("match_id", F.col("source_revision").cast("bigint").alias("revision")).join(balls, "match_id")


@query("""
SELECT 'id' || c_custkey AS identifier, c_name || ', "' || c_mktsegment || '"' AS name, 'people.csv' AS source_file FROM customer
""")
def register_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A register file with commas and doubled quotes inside its values."""
    folder = _folder(spark, "register")
    name = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"'))
    who = table(spark, sf_dir, "customer").select(F.concat(F.lit("id"), "c_custkey").alias("identifier"), name.alias("name"))
    who.write.csv(folder, header=True, escape='"', quoteAll=True)
    return files.read_register(spark, folder, "people.csv")


def _register_archives(spark: SparkSession, rows: DataFrame, member: str) -> DataFrame:
    """``(slice, header, line)`` rows as CSV members of zips, one file for each slice; returns the extracted members."""
    folder = _folder(spark, "register-zips")
    text = F.concat(F.first("header"), F.lit("\r\n"), F.array_join(F.collect_list("line"), "\r\n"), F.lit("\r\n"))
    files_of = rows.groupBy("slice", "header").agg(text.alias("text"))
    write_archives(files_of.select(F.concat(F.lit("register/"), "slice", F.lit(f"/{member}")).alias("member"), "text"), folder)
    return archives.explode_archives(archives.hash_archives(archives.list_archives(spark, folder)))


def _quoted(*values: Column) -> Column:
    """A CSV line; every value is quoted but an absent one."""
    return F.concat_ws(",", *[F.coalesce(F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")) for v in values])


@query("""
SELECT 'id' || c_custkey AS identifier, c_name || ', "' || c_mktsegment || '"' || chr(10) || 'x' AS name, CASE WHEN c_custkey % 3 = 0 THEN 'p' || c_custkey END AS key_phone,
  CASE WHEN c_custkey // 1000 % 2 = 1 THEN 'n' || c_nationkey END AS key_nation, 'people.csv' AS source_file FROM customer
""")
def archive_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People files inside zips, each with a header of its own: quotes, commas and line breaks in values, absent values.

    The second header stands in files of every other thousand customers only; without one its column is NULL.
    """
    key = F.col("c_custkey")
    who = table(spark, sf_dir, "customer").withColumn("slice", F.floor(key / 1000))
    name = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"\nx'))
    phone, nation = F.when(key % 3 == 0, F.concat(F.lit("p"), key)), F.concat(F.lit("n"), "c_nationkey")
    odd = F.col("slice") % 2 == 1
    header = F.when(odd, "key_nation,identifier,name,key_phone").otherwise("identifier,name,key_phone")
    ident = F.concat(F.lit("id"), key)
    line = F.when(odd, _quoted(nation, ident, name, phone)).otherwise(_quoted(ident, name, phone))
    members = _register_archives(spark, who.select("slice", header.alias("header"), line.alias("line")), "people.csv")
    people = archives.register_table(archives.register_rows(members, "people.csv"), "people.csv")
    return ensure_columns(people, {name: "string" for name in ("identifier", "name", "key_phone", "key_nation")})


@query("""
SELECT DISTINCT 'id' || o_custkey AS identifier, o_orderpriority || ' "x"' AS name, 'names.csv' AS source_file FROM orders
""")
def person_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other names of people from names files inside zips; equal rows count once."""
    named = table(spark, sf_dir, "orders")
    line = _quoted(F.concat(F.lit("id"), "o_custkey"), F.concat("o_orderpriority", F.lit(' "x"')))
    rows = named.select(F.floor(F.col("o_orderkey") / 1000).alias("slice"), F.lit("identifier,name").alias("header"), line.alias("line"))
    members = _register_archives(spark, rows, "names.csv")
    return docs.person_names(archives.register_table(archives.register_rows(members, "names.csv"), "names.csv"))


@query("""
SELECT event_type, CASE WHEN value >= 50 THEN 'high' END AS note, count(*) AS n FROM events GROUP BY 1, 2
""")
def append_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows appended with a column the table did not have: earlier rows read NULL."""
    lake = Lake(spark, _folder(spark, "append"))
    events = table(spark, sf_dir, "events")
    low = F.coalesce(F.col("value") < 50, F.lit(True))
    lake.append("events", events.where(low).select("event_type"))
    lake.append("events", events.where(~low).select("event_type", F.lit("high").alias("note")))
    return lake.load("events").groupBy("event_type", "note").agg(F.count("*").alias("n"))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS match_id FROM orders WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM')
""")
def changed_in_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest rows that the second delivery wrote."""
    current, batch = _delivered(spark, sf_dir, once=False)
    latest = upsert.merge_by_key(current, current, batch, *_KEY).latest
    return docs.changed_in_run(latest, ["load-2"]).select("match_id")


@query("""
SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(setting, ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS listed
FROM (SELECT p_partkey, ' ' || p_name || ' ,, ' || p_brand || ',' || CASE WHEN p_size % 2 = 0 THEN p_type ELSE ' ' END AS setting FROM part)
""")
def config_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma-separated settings as lists."""
    last = F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(" ")
    setting = F.concat(F.lit(" "), "p_name", F.lit(" ,, "), "p_brand", F.lit(","), last)
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(names.config_list(setting), "|").alias("listed"))


@query(ORACLES["team_season_cards"])
def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refresh of a run: all gold tables once, then one season again in place."""
    lake = demo_lake(spark, sf_dir)
    run = daily_run.Run("gold")
    daily_run.refresh_gold(lake, run, [], renewed=True)
    daily_run.refresh_gold(lake, run, [{"season": "1997"}])
    return lake.load(daily_run.TEAM_CARDS)
