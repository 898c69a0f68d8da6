"""Domain-shaped views derived from the TPC-H-like test tables.

The jobs are written for football events, line-ups, sales, images and sensor
series. The test folders hold ``orders``, ``lineitem``, ``customer``,
``nation``, ``region``, ``part`` and ``documents`` instead, so these functions
re-shape those tables into inputs of the same schema (rules in FIXTURES.md §2).
Everything is a Spark job over the whole tables: the views grow with the data.

Fixed rules of the derivation (must equal the DuckDB oracle views):

* a match is an order; home team = the customer's nation, away team = nation
  ``(c_nationkey + 5 * (1 + o_orderkey % 4)) % 25`` (same region),
  competition = region name, season = order year as text;
* one event per line item plus one closing second-half event per order;
* players: 14 per nation, ids ``100 * n_nationkey + slot``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.calendar import calendar_columns
from touchline.sources.readers import read_table

# Fixed values of the derivation.
SAVE_ATTEMPT = "Save attempt"
PASS = "Pass"
CLOSING_EVENT = "Others"
GOAL_TAG = "Goal"
ACCURATE_TAG = "Accurate"
PLAYER_SLOTS = 14
LARGE = (1500, 1100)  # height and width of the largest pictures
# Role of each squad slot 1..14, in slot order.
SLOT_ROLES = {
    1: "Goalkeeper", 2: "Defender", 3: "Defender", 4: "Defender", 5: "Defender",
    6: "Midfielder", 7: "Midfielder", 8: "Midfielder", 9: "Midfielder",
    10: "Forward", 11: "Forward", 12: "Goalkeeper", 13: "Defender", 14: "Midfielder",
}


def match_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: matchId, competition, season, teams and their nation keys.

    ``nation`` and ``region`` are fixed 25- and 5-row dimensions; Spark's
    size-checked auto-broadcast picks them up, while ``orders x customer``
    stays a shuffle join at scale.
    """
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    home = nation.select(
        F.col("n_nationkey").alias("home_nk"),
        F.col("n_name").alias("homeTeam"),
        F.col("n_regionkey").alias("regionkey"),
    )
    away = nation.select(F.col("n_nationkey").alias("away_nk"), F.col("n_name").alias("awayTeam"))
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .select(
            F.col("o_orderkey").alias("matchId"),
            F.col("o_orderdate"),
            F.col("c_nationkey").alias("home_nk"),
            ((F.col("c_nationkey") + 5 * (1 + F.col("o_orderkey") % 4)) % 25).cast("int").alias("away_nk"),
        )
        .join(home, "home_nk")
        .join(away, "away_nk")
        .join(region.withColumnRenamed("r_regionkey", "regionkey"), "regionkey")
        .select(
            "matchId",
            F.col("r_name").alias("competition"),
            F.year("o_orderdate").cast("string").alias("season"),
            "homeTeam",
            "awayTeam",
            "home_nk",
            "away_nk",
            "o_orderdate",
        )
    )


def _typed_null(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``f_events``: line items as events plus one closing event per match."""
    base = match_base(spark, sf_dir).drop("home_nk", "away_nk", "o_orderdate")
    items = read_table(
        spark,
        sf_dir,
        "lineitem",
        [
            "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        ],
    )
    returned = F.col("l_returnflag") == "R"
    position = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
    empty_tags = F.array().cast("array<string>")
    item_events = items.join(base, items.l_orderkey == base.matchId).select(
        "competition",
        "season",
        "matchId",
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("eventId"),
        "homeTeam",
        "awayTeam",
        F.when(returned, F.lit(SAVE_ATTEMPT)).otherwise(F.lit(PASS)).alias("event"),
        _typed_null(T.StringType()).alias("subEvent"),
        F.when(F.col("l_linestatus") == "O", F.col("homeTeam")).otherwise(F.col("awayTeam")).alias("eventTeam"),
        _typed_null(T.LongType()).alias("eventPlayerId"),
        F.when(F.col("l_tax") < 0.04, F.lit("1H")).otherwise(F.lit("2H")).alias("eventPeriod"),
        (
            (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_partkey") * 31) % 2900
        ).cast("double").alias("eventTime"),
        F.when(returned & (F.col("l_quantity") > 25), F.array(F.lit(GOAL_TAG)))
        .when(~returned & (F.col("l_discount") < 0.05), F.array(F.lit(ACCURATE_TAG)))
        .otherwise(empty_tags)
        .alias("tags"),
        _typed_null(position).alias("startPosition"),
        _typed_null(position).alias("enPosition"),
    )
    closing = base.select(
        "competition",
        "season",
        "matchId",
        _typed_null(T.LongType()).alias("eventId"),
        "homeTeam",
        "awayTeam",
        F.lit(CLOSING_EVENT).alias("event"),
        _typed_null(T.StringType()).alias("subEvent"),
        F.col("homeTeam").alias("eventTeam"),
        _typed_null(T.LongType()).alias("eventPlayerId"),
        F.lit("2H").alias("eventPeriod"),
        (2700 + (F.col("matchId") * 37) % 240).cast("double").alias("eventTime"),
        empty_tags.alias("tags"),
        _typed_null(position).alias("startPosition"),
        _typed_null(position).alias("enPosition"),
    )
    return item_events.unionByName(closing)


def _team_data(side: int) -> Column:
    nk = F.col("home_nk" if side == 0 else "away_nk")
    team = F.col("homeTeam" if side == 0 else "awayTeam")
    b = nk.cast("long") * 100
    k = F.col("matchId") + 3 * side

    def sub(player_in: Column, player_out: Column, minute: Column) -> Column:
        return F.struct(
            player_in.alias("playerIn"),
            player_out.alias("playerOut"),
            minute.cast("int").alias("minute"),
        )

    return F.struct(
        team.alias("team"),
        _typed_null(T.LongType()).alias("coachId"),
        F.sequence(b + 1, b + 11).alias("lineup"),
        F.sequence(b + 12, b + 14).alias("bench"),
        sub(b + 12, b + 1 + k % 11, 40 + k % 50).alias("substitution1"),
        F.when(k % 3 != 0, sub(b + 13, b + 1 + (k + 4) % 11, 46 + (k * 7) % 44)).alias("substitution2"),
        F.when(k % 5 == 0, sub(b + 14, b + 12, F.lit(90))).alias("substitution3"),
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``f_matches``: one row per match with both team structs."""
    return match_base(spark, sf_dir).select(
        "matchId",
        "competition",
        "season",
        _typed_null(T.LongType()).alias("roundId"),
        _typed_null(T.IntegerType()).alias("gameWeek"),
        F.to_date("o_orderdate").alias("date"),
        F.lit("Played").alias("status"),
        _team_data(0).alias("homeTeamData"),
        _team_data(1).alias("awayTeamData"),
    )


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``f_players``: 14 players per nation (25 x 14 rows at every scale)."""
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    role = F.create_map(*[F.lit(x) for kv in SLOT_ROLES.items() for x in kv])
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey)
        .select("n_nationkey", "n_name", "r_name", F.explode(F.sequence(F.lit(1), F.lit(PLAYER_SLOTS))).alias("slot"))
        .select(
            (F.col("n_nationkey").cast("long") * 100 + F.col("slot")).alias("playerId"),
            F.concat(F.lit("P"), F.col("slot").cast("string")).alias("firstName"),
            F.col("n_name").alias("lastName"),
            F.col("r_name").alias("birthArea"),
            role[F.col("slot")].alias("role"),
            F.lit("right").alias("foot"),
        )
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``f_sales``: one row per line item, brand as publisher, money as decimal(18,2)."""
    items = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_extendedprice", "l_returnflag", "l_shipdate"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
    money = F.col("l_extendedprice").cast(T.DecimalType(18, 2))
    return items.join(part, items.l_partkey == part.p_partkey).select(
        F.col("p_brand").alias("publisher"),
        F.to_date("l_shipdate").alias("release_date"),
        F.when(F.col("l_returnflag") == "R", money).alias("na_sales"),
        money.alias("total_sales"),
    )


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``f_images``: an 8x8 BGRA image struct per document, bytes from md5 digests."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id"])
    doc = F.col("doc_id").cast("string")
    digests = F.transform(
        F.sequence(F.lit(0), F.lit(15)),
        lambda i: F.md5(F.concat_ws("-", doc, i.cast("string"))),
    )
    return docs.select(
        F.struct(
            F.concat(F.lit("file:/x/"), doc, F.lit(".png")).alias("origin"),
            F.lit(8).alias("height"),
            F.lit(8).alias("width"),
            F.lit(4).alias("nChannels"),
            F.lit(24).alias("mode"),
            F.unhex(F.concat_ws("", digests)).alias("data"),
        ).alias("image")
    )


def pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``f_pictures``: one picture for every 16 consecutive document ids, from
    1 x 1 to ``LARGE`` pixels, of 3 or 4 channels, its bytes repeating the digest
    of its ids' count, least and greatest; every 20th is no picture at all."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id"])
    album = F.expr("doc_id div 16")
    made = docs.groupBy(album.alias("a")).agg(
        F.md5(F.concat_ws("-", F.count("doc_id").cast("string"), F.min("doc_id").cast("string"), F.max("doc_id").cast("string"))).alias("seed")
    )
    a = F.col("a")
    one, large = a % 25 == 1, a % 100 == 3
    height = F.when(one, 1).when(large, LARGE[0]).otherwise(1 + (a * 7) % 48).cast("int")
    width = F.when(one, 1).when(large, LARGE[1]).otherwise(1 + (a * 13) % 64).cast("int")
    channels = F.when(a % 3 == 0, 3).otherwise(4).cast("int")
    # the rows are small now, the pictures made from them aren't: deal them out
    made = made.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "a")
    sized = made.select(a, "seed", height.alias("height"), width.alias("width"), channels.alias("nChannels"))
    size = F.col("height") * F.col("width") * F.col("nChannels")
    data = F.unhex(F.substring(F.repeat("seed", F.ceil(size / 16).cast("int")), F.lit(1), 2 * size))
    broken = F.encode(F.concat(F.lit("no picture "), F.col("seed")), "utf-8")
    return sized.select(
        F.concat(F.lit("album "), a.cast("string")).alias("name"),
        "height",
        "width",
        "nChannels",
        F.when(a % 20 == 19, broken).otherwise(data).alias("data"),
    )


def image_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``f_image_meta``: hexcode, annotation and group per document."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "source"])
    return docs.select(
        F.col("doc_id").cast("string").alias("hexcode"),
        F.concat(F.lit("doc: "), F.col("doc_id").cast("string")).alias("annotation"),
        F.col("source").alias("group"),
    )


def image_meta_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``f_image_meta`` as text: a JSON line a document; every 50th line is cut
    in the middle and every 70th has a number where its group's list should end."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "source"])
    doc = F.col("doc_id").cast("string")
    line = F.format_string('{"hexcode":"%s","annotation":"doc: %s","group":"%s"}', doc, doc, F.coalesce("source", F.lit("")))
    cut = F.format_string('{"hexcode":"%s","annotation":"doc', doc)
    odd = F.format_string('{"hexcode":"%s","annotation":"doc: %s","group":[7}', doc, doc)
    return docs.select(F.when(F.col("doc_id") % 50 == 7, cut).when(F.col("doc_id") % 70 == 9, odd).otherwise(line).alias("value"))


def power(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``f_power``: one sensor row per order with the series schema."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice", "o_orderdate"])
    key = F.col("o_orderkey")
    timed = orders.select(
        key,
        "o_totalprice",
        (
            F.unix_date(F.to_date("o_orderdate")).cast("long") * 86400 + (key * 3607) % 86400
        ).alias("time"),
    )
    cal = calendar_columns("time")
    m, h = cal["month"], cal["hour"]
    return timed.select(
        "time",
        F.when(key % 97 != 0, 15 - 3 * F.abs(m - 7) + key % 5).cast("double").alias("temperature"),
        (50 + key % 40).cast("double").alias("humidity"),
        ((7 * key) % 13).cast("double").alias("wind_speed"),
        (1000 + 100 * (12 - F.abs(h - 12)) + key % 50).cast("double").alias("power_tenants"),
        (500 + 10 * m).cast("double").alias("power_maintenance"),
        (100 * F.greatest(F.lit(0), 6 - F.abs(h - 12))).cast("double").alias("power_solar_panels"),
        F.when(key % 89 != 0, F.col("o_totalprice") / 1000).alias("electricity_price"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``f_pred``: fixed hour predictions with a 24-class probability vector."""
    from pyspark.ml.functions import array_to_vector

    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    key = F.col("o_orderkey")
    timed = orders.select(
        key,
        (F.unix_date(F.to_date("o_orderdate")).cast("long") * 86400 + (key * 3607) % 86400).alias("time"),
    )
    hour = calendar_columns("time")["hour"]
    labelled = timed.select("time", hour.alias("hour"), F.pmod(hour + key % 5 - 2, F.lit(24)).alias("pred"))
    probability = F.transform(
        F.sequence(F.lit(0), F.lit(23)),
        lambda i: F.when(i == F.col("pred"), F.lit(0.6)).otherwise(F.lit(0.4) / 23),
    )
    return labelled.select(
        "time",
        "hour",
        F.col("pred").cast("double").alias("prediction"),
        array_to_vector(probability).alias("probability"),
    )
