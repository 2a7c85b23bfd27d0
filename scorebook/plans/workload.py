"""Match documents made from the order tables, and the silver tables parsed from them.

An order is a match, its line items are the balls, and customer, nation and region give competition and
place. The documents go through the real path (text, parse, explode), once per session and data folder.
"""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorebook.operators import documents as docs
from scorebook.operators.numbering import positions
from scorebook.plans.daily_run import DELIVERIES, MATCHES, RAW, WICKETS
from scorebook.session import materialise, shared_dir
from scorebook.sources.tables import Lake

RUN_ID = "load-1"
#: What the second delivery says of its matches, where it is written.
SECOND = "second_delivery"
#: Balls in one text of a match, and the table of the texts that continue one.
PART = 1024
PARTS = "document_parts"
LATER = "bronze_later_parts"

# Market segment -> competition; a segment that is not listed has no competition.
COMPETITIONS = {
    "BUILDING": "Indian Premier League",
    "AUTOMOBILE": "Women's Big Bash League",
    "FURNITURE": "The Hundred Men's Competition",
    "HOUSEHOLD": "County Cup",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def competition() -> Column:
    named = F.lit(None).cast("string")
    for segment, title in COMPETITIONS.items():
        named = F.when(F.col("c_mktsegment") == segment, title).otherwise(named)
    return named


def played(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer and place: one narrow row per match, as it is to be moved."""
    read = lambda name: table(spark, sf_dir, name)
    place = F.broadcast(read("nation").join(F.broadcast(read("region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name"))
    buyers = read("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = read("orders").select(F.col("o_orderkey").alias("key"), "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    known = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    return known.join(place, F.col("c_nationkey") == F.col("n_nationkey")).drop("c_nationkey", "n_nationkey")


def _heads() -> dict[str, Column]:
    """What a document says of its match, from a row of ``played``."""
    key, buyer = F.col("key"), F.col("o_custkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    home, away = F.concat("n_name", F.lit(" A")), F.concat("n_name", F.lit(" B"))
    winner = F.when(buyer % 10 == 0, None).when(buyer % 2 == 0, home).otherwise(away)
    by = F.struct(
        F.when(winner.isNotNull() & (key % 2 == 0), buyer % 50 + 1).cast("int").alias("runs"),
        F.when(winner.isNotNull() & (key % 2 == 1), buyer % 10).cast("int").alias("wickets"),
    )
    result = F.when(winner.isNull(), F.when(key % 2 == 0, "tie").otherwise("no result"))
    info = F.struct(
        F.lit(6).alias("balls_per_over"),
        F.col("r_name").alias("city"),
        F.array(day).alias("dates"),
        F.when(
            competition().isNotNull(), F.struct(competition().alias("name"), key.cast("string").alias("match_number"))
        ).alias("event"),
        F.col("o_orderstatus").alias("gender"),
        F.col("o_orderpriority").alias("match_type"),
        F.struct(winner.alias("winner"), result.alias("result"), by.alias("by")).alias("outcome"),
        F.array(F.concat(F.lit("P"), buyer % 40)).alias("player_of_match"),
        F.struct(
            F.map_from_arrays(
                F.transform(F.array(*[F.lit(i) for i in range(4)]), lambda i: F.concat(F.lit("Person "), buyer, F.lit(" "), i)),
                F.transform(F.array(*[F.lit(i) for i in range(4)]), lambda i: F.concat(F.lit("id"), buyer * 4 + i)),
            ).alias("people")
        ).alias("registry"),
        F.date_format("o_orderdate", "yyyy").alias("season"),
        F.array(home, away).alias("teams"),
        F.struct(
            F.when(key % 3 == 0, "bat").otherwise("field").alias("decision"),
            F.when(key % 2 == 0, home).otherwise(away).alias("winner"),
        ).alias("toss"),
        F.col("n_name").alias("venue"),
    )
    meta = F.struct(F.lit("1.1.0").alias("data_version"), day.alias("created"), F.lit(1).alias("revision"))
    return {"meta": meta, "info": info}


def _ball(item: Column, over: Column) -> Column:
    part, supp, flag, line = item["l_partkey"], item["l_suppkey"], item["l_returnflag"], over + 1
    hit = (item["l_quantity"].cast("int") % 7).alias("batter")
    wide = F.when((flag == "R") & (part % 10 == 0), 1)
    noball = F.when((flag == "N") & (part % 25 == 0), 1)
    legbye = F.when((flag == "A") & (part % 10 == 3), 1)
    more = F.coalesce(wide, F.lit(0)) + F.coalesce(noball, F.lit(0)) + F.coalesce(legbye, F.lit(0))
    batter = F.concat(F.lit("P"), (supp * 7 + line) % 40)
    wicket = F.struct(
        F.when(supp % 4 == 0, "run out").otherwise("caught").alias("kind"),
        batter.alias("player_out"),
        F.array(F.struct(F.concat(F.lit("P"), supp % 40).alias("name"))).alias("fielders"),
    )
    return F.struct(
        F.concat(over, F.lit("."), part % 6 + 1).alias("actual_delivery"),
        batter.alias("batter"),
        F.concat(F.lit("P"), 20 + part % 60).alias("bowler"),
        F.concat(F.lit("P"), (supp * 7 + line + 1) % 40).alias("non_striker"),
        F.struct(hit, more.alias("extras"), (hit + more).alias("total")).alias("runs"),
        F.when(more > 0, F.struct(wide.alias("wides"), noball.alias("noballs"), legbye.alias("legbyes"))).alias("extras"),
        F.when(item["l_discount"] == 0.1, F.array(wicket)).alias("wickets"),
    )


#: The order of balls within an over, and all that a ball is made of besides its over.
ITEM = ["l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag"]


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the innings and over they belong to; the ball itself is made where it is written."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"), F.col("l_linestatus").alias("side"), (F.col("l_linenumber") - 1).alias("over"), *ITEM
    )


def _innings(rows: DataFrame, by: list[str]) -> DataFrame:
    """Items nested into overs and innings, one row for each text; moved once and narrow. A text has at most ``PART`` items."""
    overs = rows.repartition(*by).groupBy(*by, "side", "over").agg(F.sort_array(F.collect_list(F.struct("nth", *ITEM))).alias("held"))
    first = F.get("held", F.lit(0))["nth"].cast("int")
    over = F.struct("over", "held", F.when(first > 0, first).alias("first"))
    return overs.groupBy(*by, "side").agg(F.sort_array(F.collect_list(over)).alias("overs"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source_path, raw_json, key, part)``: the texts of each match, also of orders without items.

    Every match is cut after each ``PART`` balls, so no text grows with a match; nearly all have one part. Part 0 is the
    match's document. The others continue it: they say which innings of the match theirs are, and which ball of its over
    the first of a cut over is. Only matches of several parts need their balls numbered over ranges; the others are nested
    from one exchange of their items, and the text is made after the last one.
    """
    rows, matches = items(spark, sf_dir), played(spark, sf_dir)
    # At most one key for each PART items.
    several = materialise(rows.groupBy("key").count().where(F.col("count") > PART).select("key"), "several_parts")
    whole = lambda matches, rows: _texts(matches.join(_one_part(rows).hint("merge"), "key", "left"), _joined_balls(), F.lit(0).cast("long"))
    if several.isEmpty():
        return whole(matches, rows)
    numbered = positions(rows.join(several, "key", "left_semi"), {"at": ["key"], "nth": ["key", "side", "over"]}, ["key", "side", "over", *ITEM])
    cut = numbered.withColumn("part", F.floor(F.col("at") / PART))
    ranked = numbered.select("key", "side").distinct().withColumn("index", F.row_number().over(Window.partitionBy("key").orderBy("side")) - 1)
    ranked = ranked.select(F.col("key").alias("_key"), F.col("side").alias("_side"), "index")
    placed = _innings(cut, ["key", "part"]).join(ranked, (F.col("key") == F.col("_key")) & F.col("side").eqNullSafe(F.col("_side")))
    placed = placed.withColumn("index", F.when(F.col("part") > 0, F.col("index")))
    parts = placed.groupBy("key", "part").agg(F.sort_array(F.collect_list(F.struct("side", "overs", "index"))).alias("sides"))
    others = whole(matches.join(several, "key", "left_anti"), rows.join(several, "key", "left_anti"))
    return others.unionByName(_texts(matches.join(parts, "key"), _nested_sides(), F.col("part")))


def _one_part(rows: DataFrame) -> DataFrame:
    """Matches of one text with their items in order, each as the text of its ball; moved once and narrow, gathered once."""
    balls = rows.repartition("key").withColumn("ball", F.to_json(_ball(F.struct(*ITEM), F.col("over"))))
    return balls.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("side", "over", *ITEM, "ball"))).alias("held"))


def _joined_balls() -> Column:
    """Text of the innings of ``held``: what opens and closes innings and overs goes between the texts of the balls."""
    def innings(mark: str) -> Column:
        team = F.to_json(F.array(F.concat("n_name", F.lit(mark))))
        named = F.when(F.col("n_name").isNotNull(), F.concat(F.lit('"team":'), F.substring(team, F.lit(2), F.length(team) - 2), F.lit(",")))
        return F.concat(F.lit("{"), F.coalesce(named, F.lit("")), F.lit('"overs":['))

    def ball(one: Column, at: Column) -> Column:
        before = F.get("held", at - 1)
        over = F.concat(F.lit("{"), F.coalesce(F.concat(F.lit('"over":'), one["over"], F.lit(",")), F.lit("")), F.lit('"deliveries":['))
        side = F.concat(F.when(one["side"] == "F", innings(" A")).otherwise(innings(" B")), over)
        opened = F.when(at == 0, F.concat(F.lit("["), side)).when(~before["side"].eqNullSafe(one["side"]), F.concat(F.lit("]}]},"), side))
        return F.concat(opened.when(~before["over"].eqNullSafe(one["over"]), F.concat(F.lit("]},"), over)).otherwise(","), one["ball"])

    return F.when(F.size("held") > 0, F.concat(F.array_join(F.transform("held", ball), ""), F.lit("]}]}]"))).otherwise("[]")


def _nested_sides() -> Column:
    """Text of the innings of ``sides``, the nested items of one text of a match of several."""
    def over(one: Column) -> Column:
        return F.struct(one["over"].alias("over"), F.transform(one["held"], lambda item: _ball(item, one["over"])).alias("deliveries"), one["first"].alias("first"))

    def shape(one: Column) -> Column:
        team = F.concat("n_name", F.when(one["side"] == "F", " A").otherwise(" B"))
        return F.struct(team.alias("team"), F.transform(one["overs"], over).alias("overs"), one["index"].alias("index"))

    return F.to_json(F.transform("sides", shape))


def _texts(rows: DataFrame, innings: Column, part: Column) -> DataFrame:
    """The texts of matches with the text of their innings."""
    name = F.concat(F.lit("file:/landing/"), "key", F.when(part > 0, F.concat(F.lit("-"), part)).otherwise(""), F.lit(".json"))
    heads = [piece for field, value in _heads().items() for piece in (F.lit(f'"{field}":'), F.to_json(value), F.lit(","))]
    text = F.concat(F.lit("{"), *heads, F.lit('"innings":'), innings, F.lit("}"))
    return rows.select(name.alias("source_path"), text.alias("raw_json"), "key", part.alias("part"))


def of_type(name: str = "") -> Column:
    """Texts of matches of this type, or with any: told from the text itself, without parsing it.

    The texts are made by Spark, without spaces, and a quote within a value has a backslash before it.
    """
    return F.col("raw_json").contains(f'"match_type":"{name}"' if name else '"match_type":"')


def revised_documents(texts: DataFrame) -> DataFrame:
    """Second delivery of the matches, by match type: changed with a higher revision (and moved to another
    season), changed with a lower one, exact copies, and matches the first delivery leaves out."""
    text = F.col("raw_json")
    set_revision = lambda n: F.replace(text, F.lit('"revision":1'), F.lit(f'"revision":{n}'))
    moved = F.regexp_replace(set_revision(2), '"season":"[0-9]{4}"', '"season":"1990"')
    changed = F.when(of_type("1-URGENT"), moved).when(of_type("5-LOW"), set_revision(0)).otherwise(text)
    return texts.where(of_type() & ~of_type("4-NOT SPECIFIED")).withColumn("raw_json", changed)


_LAKES: dict[tuple[str, str], Lake] = {}


@dataclass
class Workload(Lake):
    """A lake that writes each table of the workload when it is first loaded: a query pays for those it reads."""

    sf_dir: str = ""

    def load(self, name: str, schema: str | None = None, number: int | None = None) -> DataFrame:
        if name in TABLES and not self.exists(name):
            self.replace(name, _table(self, name, self.sf_dir))
        return super().load(name, schema, number)


def demo_lake(spark: SparkSession, sf_dir: str) -> Workload:
    """Lake with the documents of a data folder and their raw and silver tables, each written on first use in a session."""
    key = (spark.conf.get("spark.app.id"), sf_dir)
    if key not in _LAKES:
        tag = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
        _LAKES[key] = Workload(spark, f"{shared_dir(spark)}/scorebook/workload-{key[0]}-{tag}", sf_dir=sf_dir)
    return _LAKES[key]


def texts(lake: Lake) -> DataFrame:
    """The documents of the matches: ``source_path`` and ``raw_json``."""
    return lake.load(PARTS).where("part = 0").select("source_path", "raw_json")


def _later_texts(lake: Lake) -> DataFrame:
    """The texts that continue a match; each belongs to the match that its name begins with."""
    return every_text(lake).where("part > 0")


def every_text(lake: Lake) -> DataFrame:
    """All texts, the documents and those that continue one; ``match_id_candidate`` names the match of the latter, ``part`` is above 0."""
    return lake.load(PARTS).select("source_path", "raw_json", F.when(F.col("part") > 0, F.col("key").cast("string")).alias("match_id_candidate"), "part")


def _shaped(documents: DataFrame, run_id: str, fields: Sequence[str] = docs.PARSED) -> DataFrame:
    """Raw rows without their text, which stands once in the documents."""
    return docs.shape_raw(docs.parse_documents(documents, fields), run_id).drop("raw_json", "part")


def parsed(lake: Lake, name: str = RAW, fields: Sequence[str] = docs.PARSED) -> DataFrame:
    """Raw rows with the parsed ``fields``: as they are written, or else straight from the texts, for readers of one pass."""
    if lake.exists(name):
        return lake.load(name)
    return _shaped(texts(lake) if name == RAW else _later_texts(lake), RUN_ID, fields)


def all_parts(lake: Lake, fields: Sequence[str] = docs.PARSED, absent: str | None = None) -> DataFrame:
    """Raw rows of all texts, those that continue a match with them; without the matches of the type ``absent``."""
    if lake.exists(RAW) and lake.exists(LATER):
        rows = lake.load(RAW).unionByName(lake.load(LATER))
        return rows if absent is None else rows.where(~F.col("info.match_type").eqNullSafe(F.lit(absent)))
    held = every_text(lake)
    return _shaped(held if absent is None else held.where(~of_type(absent)), RUN_ID, fields)


#: Tables of the workload, each after those it may be made from.
TABLES = (PARTS, RAW, LATER, MATCHES, DELIVERIES, WICKETS)


def _table(lake: Lake, name: str, sf_dir: str = "") -> DataFrame:
    """Rows of one table. Silver tables keep the order of the raw rows; nothing reads them by season often enough to move them all for it."""
    if name == PARTS:
        return documents(lake.spark, sf_dir)
    if name in (RAW, LATER):
        return parsed(lake, name)
    if name == MATCHES:
        return docs.build_matches(parsed(lake, fields=["meta", "info"]))
    return docs.build_deliveries(all_parts(lake)) if name == DELIVERIES else docs.build_wickets(lake.load(DELIVERIES))


def build_raw(lake: Lake, sf_dir: str) -> None:
    lake.replace(PARTS, documents(lake.spark, sf_dir))
    for name, held in ((RAW, texts(lake)), (LATER, _later_texts(lake))):
        lake.replace(name, _shaped(held, RUN_ID))


def second_delivery(lake: Lake, fields: Sequence[str] = docs.PARSED) -> DataFrame:
    """Raw rows of the second delivery, straight from its texts.

    With the innings it has a row for every text of a match; without them one for its document, which says the rest.
    """
    return _shaped(revised_documents(every_text(lake) if "innings" in fields else texts(lake)), "load-2", fields)


def build_silver(lake: Lake) -> None:
    for name in (MATCHES, DELIVERIES, WICKETS):
        lake.replace(name, _table(lake, name))


def write_archives(texts: DataFrame, folder: str, limit: int = 8 << 20) -> None:
    """Pack ``(member, text)`` rows into zips of about ``limit`` bytes below ``folder``.

    Names come from the task and a counter, so a repeated task writes the same files again.
    """
    local = "/" + folder.removeprefix("file:").lstrip("/") if folder.startswith(("file:", "/")) else None

    def pack(batches):
        filesystem, base = (fs.LocalFileSystem(), local) if local else fs.FileSystem.from_uri(folder)
        filesystem.create_dir(base, recursive=True)
        task, number = TaskContext.get().partitionId(), 0
        buffer, archive, held = None, None, 0

        def store() -> pa.RecordBatch:
            archive.close()
            path = f"{base}/{task:05d}-{number:05d}.zip"
            with filesystem.open_output_stream(path) as sink:
                sink.write(buffer.getvalue())
            return pa.RecordBatch.from_pylist([{"path": path}])

        for batch in batches:
            for row in batch.to_pylist():
                if archive is None:
                    buffer = io.BytesIO()
                    archive, held, number = zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED), 0, number + 1
                archive.writestr(row["member"], row["text"])
                held += len(row["text"])
                if held >= limit:
                    yield store()
                    archive = None
        if archive is not None:
            yield store()

    texts.select("member", "text").mapInArrow(pack, "path string").write.mode("overwrite").parquet(f"{folder}/_packed")


def write_files(texts: DataFrame, folder: str) -> None:
    """Write ``(name, text)`` rows as a file each below ``folder``, in sub-folders by a hash of the name.

    The number of sub-folders follows the number of files: about a thousand in each. A repeated task writes the same files.
    """
    local = "/" + folder.removeprefix("file:").lstrip("/") if folder.startswith(("file:", "/")) else None
    shards = max(1, texts.count() // 1000)

    def put(batches):
        filesystem, base = (fs.LocalFileSystem(), local) if local else fs.FileSystem.from_uri(folder)
        made = set()
        for batch in batches:
            for name, text, shard in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if shard not in made:
                    filesystem.create_dir(f"{base}/{shard:05d}", recursive=True)
                    made.add(shard)
                with filesystem.open_output_stream(f"{base}/{shard:05d}/{name}") as sink:
                    sink.write(text.encode())
            yield pa.RecordBatch.from_pydict({"files": [batch.num_rows]})

    rows = texts.select("name", "text", F.pmod(F.xxhash64("name"), F.lit(shards)).cast("int").alias("shard"))
    rows.mapInArrow(put, "files bigint").agg(F.sum("files")).collect()
