"""The given tables in the roles of ladder data.

Documents are put together from one row each, or from a block of rows with
consecutive unique keys, so no document grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rungworks.functions import filenames
from rungworks.functions.scalars import micros

# Fixed values of the roles.
AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-01-30 23:57:12"
MATCH_DAYS = 365
DOCUMENT_BLOCK = 32


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt over the shuffle's partitions, as documents of a large lake are over its files.

    The given tables are one file each, whose documents would all be built and parsed by one task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def floor_long(value: Column) -> Column:
    return F.floor(value).cast("bigint")


# ------------------------------------------------------------------ documents


def league_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structure documents as JSON text: customers of a nation as divisions, in rating tiers.

    One document per nation and block of customer keys; a document holds at most
    ``DOCUMENT_BLOCK`` divisions.
    """
    band = floor_long(F.col("c_acctbal") / 2500)
    division = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_custkey").cast("string").alias("ladder_id"),
        floor_long(F.col("c_acctbal") / 100).alias("member_count"),
    )
    tiers = (
        read(spark, sf_dir, "customer")
        .select(
            F.col("c_nationkey").alias("league"),
            floor_long(F.col("c_custkey") / DOCUMENT_BLOCK).alias("block"),
            band.alias("band"),
            division.alias("division"),
        )
        .groupBy("league", "block", "band")
        .agg(F.sort_array(F.collect_list("division")).alias("division"))
    )
    tier = F.struct(
        F.col("band").alias("id"),
        (F.col("band") * 2500).alias("min_rating"),
        (F.col("band") * 2500 + 2499).alias("max_rating"),
        "division",
    )
    docs = tiers.groupBy("league", "block").agg(F.sort_array(F.collect_list(tier)).alias("tier"))
    key = F.struct(
        (F.col("block") + 1).alias("season_id"),
        (F.col("league") + 100).alias("queue_id"),
        (F.col("block") % 2).alias("team_type"),
        F.col("league").alias("league_id"),
    )
    taken = F.expr("TIMESTAMP_NTZ'2020-01-01 04:40:00'") + F.make_dt_interval(mins=F.col("block"))
    return docs.select(
        filenames.document_name(F.lit("league_raw"), F.col("league"), taken).alias("file_name"),
        F.to_json(F.struct(key.alias("key"), "tier")).alias("payload"),
    )


def modern_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ladder documents as JSON text, one per order: three teams, the second without members."""
    number = F.col("o_orderkey")

    def member(id_: Column, name: Column, races: Column) -> Column:
        return F.struct(
            F.struct(id_.alias("id"), F.lit(1).alias("realm"), name.alias("name")).alias("legacy_link"),
            F.struct(F.concat(name, F.lit("#"), number.cast("string")).alias("battle_tag")).alias(
                "character_link"
            ),
            races.alias("played_race_count"),
        )

    def race(name: Column, count: Column) -> Column:
        return F.struct(F.struct(name.alias("en_US")).alias("race"), count.alias("count"))

    def team(id_: Column, rating: Column, members: Column) -> Column:
        return F.struct(
            id_.alias("id"),
            rating.alias("rating"),
            F.month("o_orderdate").alias("wins"),
            F.dayofmonth("o_orderdate").alias("losses"),
            F.quarter("o_orderdate").alias("ties"),
            floor_long(F.col("o_totalprice") / 100).alias("points"),
            F.dayofyear("o_orderdate").alias("longest_win_streak"),
            F.month("o_orderdate").alias("current_win_streak"),
            F.dayofyear("o_orderdate").alias("current_rank"),
            F.dayofmonth("o_orderdate").alias("highest_rank"),
            F.year("o_orderdate").alias("previous_rank"),
            floor_long(micros(F.col("o_orderdate")) / 1_000_000).alias("join_time_stamp"),
            F.lit(None).cast("bigint").alias("last_played_time_stamp"),
            members.alias("member"),
        )

    races = F.array(race(F.col("o_orderpriority"), F.col("o_custkey")), race(F.lit("Random"), F.lit(1)))
    none = F.slice(races, 1, 0)  # a filter by lambda would put all members together by interpretation
    nobody = F.lit(None).cast("bigint")
    players = F.array(
        member(F.col("o_custkey"), F.col("o_orderstatus"), races), member(number, F.lit("second"), none)
    )
    teams = F.array(
        team(number.cast("string"), floor_long(F.col("o_totalprice")), players),
        team(number.cast("string"), nobody, F.slice(players, 1, 0)),
        team(F.lit("18446744073709551615"), nobody, F.array(member(nobody, F.lit("guest"), none))),
    )
    named = F.when(F.col("o_orderstatus") != "P", F.length("o_orderpriority").cast("string"))
    file_name = F.concat(
        F.concat_ws(
            "_",
            F.lit("modern_ladders_raw"),
            named,
            F.date_format("o_orderdate", filenames.STAMP_FORMAT),
        ),
        F.lit(".json"),
    )
    told = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice"]
    orders = dealt(read(spark, sf_dir, "orders").select(told), "o_orderkey")
    return orders.select(
        file_name.alias("file_name"),
        F.to_json(
            F.struct(F.col("o_custkey").alias("ladder_id"), F.struct(teams.alias("team")).alias("data"))
        ).alias("payload"),
    )


def legacy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member documents as JSON text, one per customer; rich customers bring a second account."""

    def member(id_: Column, name: Column) -> Column:
        clan = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
        return F.struct(
            F.struct(
                id_.cast("string").alias("id"),
                F.lit(1).alias("realm"),
                F.col("c_nationkey").alias("region"),
                name.alias("displayName"),
                clan.alias("clanName"),
                F.substring(clan, 1, 5).alias("clanTag"),
                F.concat_ws("/", F.lit("at"), "c_mktsegment", id_.cast("string")).alias("profilePath"),
            ).alias("character"),
            (F.col("c_custkey") * 3600).alias("joinTimestamp"),
            floor_long(F.col("c_acctbal")).alias("points"),
            floor_long(F.abs("c_acctbal") / 100).alias("wins"),
            F.length("c_mktsegment").alias("losses"),
            (F.col("c_nationkey") + 1).alias("highestRank"),
            F.length("c_mktsegment").alias("previousRank"),
            F.col("c_mktsegment").alias("favoriteRaceP1"),
        )

    main = member(F.col("c_custkey"), F.col("c_name"))
    other = member(-F.col("c_custkey") - 1, F.concat(F.lit("alt-"), F.col("c_name")))
    members = F.when(F.col("c_acctbal") > 5000, F.array(main, other)).otherwise(F.array(main))
    taken = F.expr("TIMESTAMP_NTZ'2020-01-01 04:40:00'")
    told = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    customers = dealt(read(spark, sf_dir, "customer").select(told), "c_custkey")
    return customers.select(
        filenames.document_name(F.lit("legacy_ladders_raw"), F.col("c_nationkey"), taken).alias("file_name"),
        F.to_json(
            F.struct(
                F.col("c_nationkey").alias("ladder_id"),
                F.struct(members.alias("ladderMembers")).alias("data"),
            )
        ).alias("payload"),
    )


def match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match documents as JSON text, one per event: the event and a match without a date."""

    def match(date: Column, kind: Column) -> Column:
        return F.struct(
            date.alias("date"),
            F.col("event_type").alias("map"),
            F.lit("1v1").alias("type"),
            kind.alias("decision"),
            F.lit("FASTER").alias("speed"),
        )

    seconds = floor_long(micros(F.col("ts")) / 1_000_000)
    event = F.col("event_type")
    decision = F.when(event == "purchase", "WIN").when(event == "error", "LOSS").otherwise("TIE")
    undated = match(F.lit(0).cast("bigint"), F.lit("WIN"))
    stamp = F.date_format("ts", filenames.STAMP_FORMAT)
    events = dealt(read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts"), "event_id")
    return events.select(
        F.concat(F.lit("matches_all_history_"), stamp, F.lit(".json")).alias("file_name"),
        F.col("ts"),
        F.to_json(
            F.struct(
                F.col("user_id").alias("request_profile_id"),
                F.lit(1).alias("request_realm_id"),
                F.lit(2).alias("request_region_id"),
                F.array(match(seconds, decision), undated).alias("matches"),
            )
        ).alias("payload"),
    )


def listing_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing: one name per event minute, kind and league, signups in the older naming."""
    kind = F.concat("event_type", F.lit("_raw"))
    league = floor_long(F.col("value") / 100)
    named = filenames.document_name(kind, league, F.col("ts"))
    older = filenames.document_name(kind, None, F.col("ts"))
    name = F.when(F.col("event_type") == "signup", older).otherwise(named)
    return read(spark, sf_dir, "events").select(name.alias("file_name")).distinct()


# --------------------------------------------------------------------- tables


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a rating series: the user as character, the type as race, the value as rating."""
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("character_id"),
        F.col("event_type").alias("race"),
        F.col("ts").alias("snapshot_ts"),
        F.floor("value").cast("int").alias("rating"),
        F.col("event_id").alias("ladder_id"),
    )


def modern_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ladder snapshots: the customer as character, the status as race."""
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("character_id"),
        F.col("o_orderstatus").alias("primary_race"),
        F.col("o_orderpriority").alias("battle_tag"),
        F.concat(F.lit("m-"), "o_orderpriority").alias("character_name"),
        F.col("o_orderdate").alias("snapshot_ts"),
        F.col("o_orderkey").alias("ladder_id"),
        F.floor("o_totalprice").cast("int").alias("rating"),
        F.month("o_orderdate").alias("wins"),
        F.dayofmonth("o_orderdate").alias("losses"),
    )


def legacy_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as member snapshots: the type as name, and as clan unless it is an error."""
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("character_id"),
        F.col("event_type").alias("display_name"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("clan_tag"),
        F.col("ts").alias("snapshot_ts"),
    )


def match_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as reports of one game: the part as player, the order as map."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return (
        read(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_partkey", "l_returnflag", "l_shipdate")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_partkey").alias("profile_id"),
            F.col("o_orderdate").alias("match_date"),
            F.col("l_orderkey").cast("string").alias("map"),
            F.lit("1v1").alias("type"),
            F.col("l_returnflag").alias("decision"),
            F.to_date("l_shipdate").alias("snapshot_date"),
        )
    )


def rating_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a rating track: the customer as character, the priority as race.

    Parts play, customers are rated: parts beyond the last customer have no rating.
    """
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("character_id"),
        F.col("o_orderpriority").alias("race"),
        F.col("o_orderdate").alias("snapshot_ts"),
        F.floor("o_totalprice").cast("int").alias("rating"),
    )


def known_races(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the player dimension: their segment as race, and a second one for the rich."""
    races = F.array_compact(F.array("c_mktsegment", F.when(F.col("c_acctbal") > 5000, F.lit("second"))))
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("character_id"), F.explode(races).alias("race"))


def declared_races(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as outside evidence of the race a character played at a time."""
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("character_id"),
        F.col("o_orderdate").alias("match_date"),
        F.col("o_orderpriority").alias("race"),
    )


def game_counters(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    """Events per user so far, as each player's number of games."""
    events = read(spark, sf_dir, "events").select("user_id", "ts")
    if until:
        events = events.where(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return events.groupBy(F.col("user_id").alias("character_id")).agg(
        F.count("*").alias("current_games")
    )
