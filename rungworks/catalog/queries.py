"""The registered queries: each runs an operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rungworks import schemas
from rungworks.catalog import roles
from rungworks.catalog.roles import AS_OF, EVENTS_AS_OF, MATCH_DAYS, read
from rungworks.functions import filenames
from rungworks.functions.scalars import moment
from rungworks.operators import changes, contracts, daily, flatten, inference, keyfilter, latest, matching, merge, pairs
from rungworks.operators.asof import asof_lookup
from rungworks.operators.hotkeys import heavy_keys
from rungworks.plans import bronze, gold, silver, worklists
from rungworks.plans.folded import fold_distinct, fold_latest
from rungworks.session import scratch_path, stage, staging
from rungworks.sources import arrays, documents, listing, tables
from rungworks.streaming import ingest as streams
from rungworks.streaming import state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def _day(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# -------------------------------------------------------------------- flatten


def _league_docs(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.parse_documents(roles.league_documents(spark, sf), "payload", schemas.LEAGUE_DOCUMENT)


@query("q01_flatten_league")
def flatten_league(spark: SparkSession, sf: str) -> DataFrame:
    checked = contracts.check_payloads(roles.league_documents(spark, sf), "payload", "league")
    sound, _ = contracts.split(checked)
    return flatten.league_divisions(flatten.parse_documents(sound, "payload", schemas.LEAGUE_DOCUMENT))


@query("q02_flatten_ladder_teams")
def flatten_teams(spark: SparkSession, sf: str) -> DataFrame:
    docs = roles.modern_documents(spark, sf)
    return flatten.modern_ladder_teams(
        flatten.parse_documents(docs, "payload", schemas.MODERN_LADDER_DOCUMENT)
    )


@query("q03_flatten_ladder_members")
def flatten_members(spark: SparkSession, sf: str) -> DataFrame:
    docs = roles.legacy_documents(spark, sf)
    return flatten.legacy_ladder_members(
        flatten.parse_documents(docs, "payload", schemas.LEGACY_LADDER_DOCUMENT)
    )


@query("q03_split_array")
def split_array(spark: SparkSession, sf: str) -> DataFrame:
    """All member documents as one array in one file, read back by several tasks and flattened."""
    root = scratch_path(spark, "one-array")
    docs = roles.legacy_documents(spark, sf)
    named = F.concat(F.lit('{"file_name": "'), "file_name", F.lit('", "document": '), "payload", F.lit("}"))
    documents.land_files(docs.select(F.lit("all_members.json").alias("file"), named.alias("element")), root, "file", "element")
    found = arrays.split_documents(spark, root, bytes_per_task=256 * 1024)
    parsed = F.from_json("payload", f"file_name STRING, document STRUCT<{schemas.LEGACY_LADDER_DOCUMENT}>")
    return flatten.legacy_ladder_members(found.select(parsed.alias("d")).select("d.document.*", "d.file_name"))


@query("q04_flatten_matches")
def flatten_matches(spark: SparkSession, sf: str) -> DataFrame:
    docs = roles.match_documents(spark, sf).drop("ts")
    return flatten.match_history(
        flatten.parse_documents(docs, "payload", schemas.MATCH_HISTORY_DOCUMENT)
    )


@query("q05_flatten_with_position")
def flatten_position(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.flatten_path(
        _league_docs(spark, sf),
        ["tier", "division"],
        meta={"tier_min_rating": "tier.min_rating", "league_id": "key.league_id"},
        position="tier_index",
    )


@query("q05_flatten_path_prefixes")
def flatten_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.flatten_path(
        _league_docs(spark, sf),
        ["tier", "division"],
        meta={"id": "tier.id", "min_rating": "tier.min_rating", "season_id": "key.season_id"},
        record_prefix="division_",
        meta_prefix="tier_",
    )


@query("q06_child_ids")
def child_ids(spark: SparkSession, sf: str) -> DataFrame:
    listed = flatten.child_ids(_league_docs(spark, sf), "tier", "division", "ladder_id", "ids")
    return listed.select(
        filenames.league_id("file_name").alias("league_id"),
        filenames.snapshot_ts("file_name").alias("snapshot_ts"),
        F.size("ids").cast("bigint").alias("ladders"),
        F.array_join("ids", ",").alias("ladder_ids"),
    )


@query("q06_ladder_worklist")
def ladder_worklist(spark: SparkSession, sf: str) -> DataFrame:
    return worklists.ladder_worklist(_league_docs(spark, sf)).select(
        "league_id", F.col("position").cast("bigint").alias("position"), "ladder_id"
    )


# ------------------------------------------------------------------- listings


@query("q07_file_name_metadata")
def file_names(spark: SparkSession, sf: str) -> DataFrame:
    named = roles.listing_names(spark, sf)
    return named.select(
        "file_name",
        filenames.kind("file_name").alias("kind"),
        filenames.league_id("file_name").alias("league_id"),
        filenames.snapshot_ts("file_name").alias("snapshot_ts"),
        filenames.snapshot_date("file_name").alias("snapshot_date"),
    )


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    return listing.describe(roles.listing_names(spark, sf))


def _ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger of a run that ended on 20 January."""
    done = _listing(spark, sf).where(F.col("snapshot_ts") < _day("2024-01-20 00:00:00"))
    return done.select(
        F.col("file_name").alias("filename"), moment("2024-01-20 00:00:00").alias("processed_at")
    )


@query("q08_latest_file_per_group")
def latest_file(spark: SparkSession, sf: str) -> DataFrame:
    return listing.latest_file(_listing(spark, sf)).select("kind", "league_id", "file_name")


@query("q09_last_n_files_per_group")
def last_files(spark: SparkSession, sf: str) -> DataFrame:
    return listing.last_files(_listing(spark, sf)).select("kind", "league_id", "file_name")


@query("q10_backlog")
def backlog(spark: SparkSession, sf: str) -> DataFrame:
    return listing.backlog(_listing(spark, sf))


@query("q11_unprocessed_files")
def unprocessed(spark: SparkSession, sf: str) -> DataFrame:
    return listing.unprocessed(_listing(spark, sf), _ledger(spark, sf)).select("file_name", "kind")


@query("q11_ledger_after_run")
def ledger_after_run(spark: SparkSession, sf: str) -> DataFrame:
    ledger = _ledger(spark, sf)
    noted = listing.ledger_entries(_listing(spark, sf), ledger, EVENTS_AS_OF)
    return ledger.unionByName(noted)


# --------------------------------------------------------------------- merges

LINE_KEY = ["l_orderkey", "l_linenumber"]


def _lines(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(lines loaded before 1998, one per key; all lines, as the incoming batch)."""
    batch = read(spark, sf, "lineitem").select(
        *LINE_KEY, "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    before = batch.where(F.col("l_shipdate") < _day("1998-01-01 00:00:00"))
    return merge.unique_by_key(before, LINE_KEY), batch


@query("q12_insert_if_absent")
def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    target, batch = _lines(spark, sf)
    return merge.insert_if_absent(target, batch, LINE_KEY, drop_if_null=LINE_KEY)


@query("q12_load_summary")
def load_summary(spark: SparkSession, sf: str) -> DataFrame:
    target, batch = _lines(spark, sf)
    return merge.load_summary(batch, merge.rows_to_insert(target, batch, LINE_KEY, LINE_KEY))


@query("q12_key_filters")
def key_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Filters of the lines of odd number, asked for all lines: none held is missed, few others are reported."""
    key = [*LINE_KEY, "l_shipdate"]
    lines = read(spark, sf, "lineitem").select(*key).distinct()
    held = F.col("l_linenumber") % 2 == 1
    filters = stage(keyfilter.build(lines.where(held), "l_shipdate", key), "key-filters")
    reported = keyfilter.possibly_held(lines, filters, "l_shipdate", key).drop("day").withColumn("reported", F.lit(True))
    asked = lines.join(reported, key, "left").withColumn("reported", F.col("reported").isNotNull())
    false, others = F.count_if(F.col("reported") & ~held), F.count_if(~held)
    return asked.groupBy(F.year("l_shipdate").alias("year")).agg(
        F.count("*").alias("keys"),
        F.count_if(held).alias("held"),
        F.count_if(F.col("reported") & held).alias("found"),
        (100 * false <= others + 100).alias("few_false"),
    )


@query("q12_table_constraints")
def table_constraints(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
    rows = read(spark, sf, "events").select(
        F.col("user_id").alias("ladder_id"),
        F.when(F.col("event_type") != "error", day).alias("snapshot_ts"),
        F.floor(F.col("value") * 300).cast("bigint").alias("member_count"),
        *[
            F.lit(None).cast("bigint").alias(c)
            for c in schemas.LEAGUE_DIVISIONS.payload
            if c not in ("ladder_id", "snapshot_ts", "member_count")
        ],
    )
    return contracts.constraint_report(rows, schemas.LEAGUE_DIVISIONS)


@query("q13_overwrite_upsert")
def overwrite_upsert(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_custkey", "o_orderdate")

    def totals(df: DataFrame, at: str) -> DataFrame:
        return df.groupBy(F.col("o_custkey").alias("character_id")).agg(
            F.count("*").alias("total_games"), F.lit(at).cast("timestamp_ntz").alias("updated_at")
        )

    early = totals(orders.where(F.col("o_orderdate") < _day("1998-01-01 00:00:00")), "1998-01-01 00:00:00")
    late = totals(orders.where(F.col("o_orderdate") >= _day("1998-01-01 00:00:00")), AS_OF)
    return merge.upsert(
        early, late, ["character_id"], {"total_games": merge.INCOMING, "updated_at": merge.INCOMING}
    )


def _facts(orders: DataFrame, race: Column, confidence: str, shift: int) -> DataFrame:
    """Orders as match rows without an opponent."""
    none = F.lit(None).cast("string")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("match_id"),
        (F.col("o_orderdate") + F.make_dt_interval(days=F.lit(shift))).alias("match_date"),
        F.col("o_orderpriority").alias("map"),
        F.col("o_custkey").alias("p1_character_id"),
        race.alias("p1_race_inferred"),
        F.lit(confidence).alias("p1_race_confidence"),
        F.lit(None).cast("bigint").alias("p2_character_id"),
        none.alias("p2_race_inferred"),
        none.alias("p2_race_confidence"),
    )


def _held_facts(orders: DataFrame) -> DataFrame:
    held = orders.where(F.col("o_orderdate") < _day("2000-01-01 00:00:00"))
    return _facts(held, F.col("o_orderstatus"), "LOW", 0)


def _new_facts(orders: DataFrame) -> DataFrame:
    came = orders.where(F.col("o_orderdate") >= _day("1998-01-01 00:00:00"))
    return _facts(came, F.lower("o_orderstatus"), "HIGH", 1)


@query("q14_partial_upsert")
def partial_upsert(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders")
    return gold.merge_matches(_held_facts(orders), _new_facts(orders))


def _player_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs: one on what was known early, one on everything."""
    modern, legacy = roles.modern_snapshots(spark, sf), roles.legacy_snapshots(spark, sf)
    early = gold.current_players(
        modern.where(F.col("snapshot_ts") < _day("2000-01-01 00:00:00")),
        legacy.where(F.col("snapshot_ts") < _day("2024-01-15 00:00:00")),
    )
    # The given tables' ids are wide.
    columns = schemas.DIM_PLAYERS.columns.replace("character_id INT", "character_id BIGINT")
    first = gold.merge_players(spark.createDataFrame([], columns), early, "2024-01-15 00:00:00")
    return gold.merge_players(first, gold.current_players(modern, legacy), EVENTS_AS_OF)


@query("q15_player_dimension")
def player_dimension(spark: SparkSession, sf: str) -> DataFrame:
    players = _player_dimension(spark, sf)
    names = F.transform("legacy_names", lambda x: F.concat_ws("@", x["name"], x["since"]))
    clans = F.transform("legacy_clans", lambda x: F.concat_ws("@", x["clan"], x["since"]))
    return players.withColumns(
        {"legacy_names": F.array_join(names, ","), "legacy_clans": F.array_join(clans, ",")}
    )


# ------------------------------------------------------- latest, counts, state


@query("q16_latest_per_race")
def latest_per_race(spark: SparkSession, sf: str) -> DataFrame:
    return latest.latest_per_key(roles.snapshots(spark, sf), ["character_id", "race"], "snapshot_ts")


@query("q16_latest_per_character")
def latest_per_character(spark: SparkSession, sf: str) -> DataFrame:
    return latest.latest_per_key(roles.snapshots(spark, sf), ["character_id"], "snapshot_ts")


@query("q16_folded_latest")
def folded_latest(spark: SparkSession, sf: str) -> DataFrame:
    """As ``q16_latest_per_race``, in three runs that each read the days that changed; some rows come 12 days late."""
    root = scratch_path(spark, "folded-latest")
    rows = roles.snapshots(spark, sf)
    table = schemas.Table("snapshots", rows.schema.simpleString()[7:-1], ("character_id",), ("character_id",), time="snapshot_ts")
    late = F.when(F.col("ladder_id") % 7 == 0, 12).otherwise(0)
    day = F.datediff(F.col("snapshot_ts").cast("date"), F.lit("2024-01-01").cast("date")) + late
    found = rows
    for first, last in ((-1000, 10), (10, 20), (20, 1000)):
        came = stage(rows.where((day >= first) & (day < last)), "folded-came")
        tables.note_days(spark, f"{root}/snapshots", tables.touched_days(came, "snapshot_ts"))
        tables.append(came, f"{root}/snapshots", table)
        found = fold_latest(spark, f"{root}/snapshots", table, f"{root}/newest", lambda df: df, ["character_id", "race"], "snapshot_ts")
    return found


@query("q16_latest_rating")
def latest_rating(spark: SparkSession, sf: str) -> DataFrame:
    return inference.latest_ratings(roles.rating_track(spark, sf))


@query("q17_race_counts")
def race_counts(spark: SparkSession, sf: str) -> DataFrame:
    return inference.race_counts(roles.rating_track(spark, sf))


@query("q17_folded_race_counts")
def folded_race_counts(spark: SparkSession, sf: str) -> DataFrame:
    """As ``q17_race_counts``, from the distinct races kept over three runs; orders arrive by key, not by time."""
    root = scratch_path(spark, "folded-races")
    rows = roles.rating_track(spark, sf).select("character_id", "race", F.date_trunc("year", "snapshot_ts").cast("timestamp_ntz").alias("year"))
    table = schemas.Table("races", rows.schema.simpleString()[7:-1], ("character_id",), ("character_id",), time="year")
    found = rows
    for part in range(3):
        came = rows.where(F.pmod(F.xxhash64("character_id", "race", "year"), F.lit(3)) == part)
        tables.note_days(spark, f"{root}/races", tables.touched_days(came, "year"))
        tables.append(came, f"{root}/races", table)
        found = fold_distinct(spark, f"{root}/races", table, f"{root}/distinct", lambda df: df.select("character_id", "race"))
    return inference.race_counts(found)


@query("q18_max_counter_first_seen")
def max_counter(spark: SparkSession, sf: str) -> DataFrame:
    return changes.max_counter_first_seen(
        read(spark, sf, "orders"),
        "o_custkey",
        F.floor("o_totalprice").cast("bigint"),
        ["o_orderstatus", "o_orderpriority"],
        ["o_orderkey"],
    )


def _checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """The state after the run of 29 January."""
    return roles.game_counters(spark, sf, "2024-01-29 00:00:00").select(
        "character_id",
        F.col("current_games").cast("int").alias("total_games"),
        moment("2024-01-29 00:00:00").alias("updated_at"),
    )


@query("q19_changed_keys")
def changed_keys(spark: SparkSession, sf: str) -> DataFrame:
    return changes.changed_keys(roles.game_counters(spark, sf), _checkpoint(spark, sf))


@query("q19_change_summary")
def change_summary(spark: SparkSession, sf: str) -> DataFrame:
    return changes.change_summary(roles.game_counters(spark, sf), _checkpoint(spark, sf))


@query("q19_advance_state")
def advance_state(spark: SparkSession, sf: str) -> DataFrame:
    state = _checkpoint(spark, sf)
    landed = changes.changed_keys(roles.game_counters(spark, sf), state)
    return changes.advance_state(state, landed, EVENTS_AS_OF)


@query("q19_changed_players")
def changed_players(spark: SparkSession, sf: str) -> DataFrame:
    docs = flatten.parse_documents(
        roles.legacy_documents(spark, sf), "payload", schemas.LEGACY_LADDER_DOCUMENT
    )
    losses = F.when(F.col("c_acctbal") > 2000, F.length("c_mktsegment")).otherwise(0)
    games = (F.floor(F.abs("c_acctbal") / 100) + losses).cast("int")
    known = read(spark, sf, "customer").select(
        F.col("c_custkey").alias("character_id"), games.alias("total_games")
    )
    return worklists.changed_players(docs, known)


@query("q19_fetch_twice")
def fetch_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the fetch; the first gets no answer for odd ids, which the second lists again."""
    root = scratch_path(spark, "fetch-state")
    docs = flatten.parse_documents(
        roles.legacy_documents(spark, sf), "payload", schemas.LEGACY_LADDER_DOCUMENT
    )
    runs = []
    for number, fetch in enumerate((lambda df: df.where("character_id % 2 = 0"), lambda df: df), 1):
        listed = worklists.fetch_changed(docs, root, fetch, AS_OF)
        runs.append(listed.select(F.lit(number).alias("run"), "character_id", "current_games"))
    state = tables.read_version(spark, root, schemas.MATCH_HISTORY_CHECKPOINT)
    after = state.select(F.lit(3).alias("run"), "character_id", F.col("total_games").alias("current_games"))
    return runs[0].unionByName(runs[1]).unionByName(after)


@query("q20_rolling_track")
def rolling_track(spark: SparkSession, sf: str) -> DataFrame:
    modern = roles.modern_snapshots(spark, sf)
    track = merge.unique_by_key(
        modern.where(F.col("snapshot_ts") < _day("2001-03-01 00:00:00")).select(
            "character_id", F.col("primary_race").alias("race"), "snapshot_ts",
            "ladder_id", "rating", "wins", "losses",
        ),
        ["character_id", "race", "snapshot_ts"],
    )
    return gold.rating_track_rows(track, modern, AS_OF, days=MATCH_DAYS)


# -------------------------------------------------------------------- matches


def _reports(spark: SparkSession, sf: str) -> tuple[DataFrame, datetime | None]:
    """The match reports, put together once, and the earliest match that the window reports."""
    reports = stage(roles.match_reports(spark, sf), "match-reports")
    return reports, gold.earliest_match(reports, AS_OF, MATCH_DAYS)


def _games(spark: SparkSession, sf: str) -> DataFrame:
    reports, since = _reports(spark, sf)
    return gold.rebuilt_games(reports, AS_OF, MATCH_DAYS, history_since=since)


@query("q21_pairs")
def reconstructed_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.matched(_games(spark, sf))


@query("q21_assigned_games")
def assigned_games(spark: SparkSession, sf: str) -> DataFrame:
    """Each player of an order in one pair at most, by the least difference of the parts' prices."""
    reports = pairs.game_reports(roles.match_reports(spark, sf), F.lit(True))
    prices = read(spark, sf, "part").select(F.col("p_partkey").alias("profile_id"), F.floor("p_retailprice").alias("rating"))
    found = matching.assigned(matching.rated_players(reports, prices), small=14)
    return found.select("p1_id", "p2_id", "match_date", "map", "cost")


@query("q22_unmatched")
def unmatched(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.unmatched(_games(spark, sf)).select("p1_id", "match_date", "map", "type", "p1_decision")


@query("q22_participants")
def participants(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.participants(_games(spark, sf))


@query("q23_rank_candidates")
def rank_candidates(spark: SparkSession, sf: str) -> DataFrame:
    profiles = inference.race_profiles(roles.rating_track(spark, sf), roles.known_races(spark, sf))
    ranked = inference.rank_candidates(_games(spark, sf), profiles)
    return ranked.select("p1_id", "p2_id", "match_date", "map", "cost", "p1_race", "p2_race")


@query("q24_match_inference")
def match_inference(spark: SparkSession, sf: str) -> DataFrame:
    reports, since = _reports(spark, sf)
    return gold.match_facts(
        reports,
        roles.rating_track(spark, sf),
        roles.known_races(spark, sf),
        AS_OF,
        MATCH_DAYS,
        history_since=since,
    )


@query("q24_match_inference_boosted")
def match_inference_boosted(spark: SparkSession, sf: str) -> DataFrame:
    reports, since = _reports(spark, sf)
    return gold.match_facts(
        reports,
        roles.rating_track(spark, sf),
        roles.known_races(spark, sf),
        AS_OF,
        MATCH_DAYS,
        evidence=roles.declared_races(spark, sf),
        tolerance=timedelta(days=90),
        history_since=since,
    )


_LOOKUP = {
    "key": "user_id",
    "probe_ts": "ts",
    "evidence_ts": "seen",
    "value": "value",
    "tolerance": inference.SESSION,
}


def _asked(events: DataFrame) -> DataFrame:
    """Every event asks for the one before it."""
    return events.select("user_id", "ts")


def _values(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select("user_id", F.col("ts").alias("seen"), "value")


@query("q24_retracted_matches")
def retracted_matches(spark: SparkSession, sf: str) -> DataFrame:
    """The match table after two runs: in the first a third of the players have not reported yet."""
    root, table = scratch_path(spark, "retracted"), None
    reports, since = _reports(spark, sf)
    for came in (reports.where("profile_id % 3 <> 0"), reports):
        found = gold.match_facts(
            came, roles.rating_track(spark, sf), roles.known_races(spark, sf), AS_OF, MATCH_DAYS, history_since=since
        )
        table = table or schemas.Table("matches", found.schema.simpleString()[7:-1], ("match_id",), ("match_id",))
        held = tables.read_version(spark, root, table)
        tables.write_version(gold.merge_matches(held, stage(found, "retracted-run"), retract=True), root)
    return tables.read_version(spark, root, table)


@query("q25_asof_lookup")
def asof(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events")
    dense = heavy_keys(events, "user_id")
    return asof_lookup(_asked(events), _values(spark, sf), **_LOOKUP, dense_keys=dense)


@query("q25_high_confidence_evidence")
def high_confidence(spark: SparkSession, sf: str) -> DataFrame:
    """What games say for sure about the races their players play."""
    inferred = gold.inferred_games(_games(spark, sf), roles.rating_track(spark, sf), roles.known_races(spark, sf))
    return inference.high_confidence_evidence(inferred)


@query("q26_player_stats_daily")
def stats_daily(spark: SparkSession, sf: str) -> DataFrame:
    matches = read(spark, sf, "events").select(
        F.col("user_id").alias("profile_id"),
        F.col("ts").alias("match_date"),
        F.col("event_type").alias("decision"),
    )
    return daily.player_stats_daily(matches, win="purchase", loss="error")


@query("q27_player_mmr_daily")
def mmr_daily(spark: SparkSession, sf: str) -> DataFrame:
    modern = roles.snapshots(spark, sf).withColumnRenamed("race", "battle_tag")
    return gold.player_mmr_daily(modern, roles.legacy_snapshots(spark, sf))


@query("q28_mmr_checkpoints")
def mmr_checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("ladder_id"),
        F.col("l_partkey").alias("profile_id"),
        F.col("l_shipdate").alias("snapshot_ts"),
        F.floor("l_extendedprice").cast("bigint").alias("rating"),
    )
    return gold.mmr_checkpoints(rows)


# ------------------------------------------------------------------ contracts


@query("q29_league_contract")
def league_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads sound and damaged, by the order's priority and status."""
    urgent = F.col("o_orderpriority")
    number = F.col("o_orderkey").cast("string")
    key = F.format_string('"key": {"season_id": %s, "queue_id": %s, "league_id": null, "team_type": %s}', number, number, number)
    end = F.lit("}]}]}")

    def start(more: str) -> Column:
        return F.concat(F.lit("{"), key, F.lit(', "tier": [{"division": []}, {"division": [' + more))

    sound = F.concat(start('{"ladder_id": '), number, end)
    no_id = F.concat(start('{"ladder_id": null}, {"id": '), number, end)
    payload = (
        F.when(urgent == "1-URGENT", sound)
        .when(urgent == "2-HIGH", no_id)
        .when(urgent == "3-MEDIUM", F.concat(F.lit("["), number, F.lit("]")))
        .when(
            (urgent == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "F"),
            F.format_string('{"key": {"season_id": %s, "queue_id": %s}, "tier": []}', number, number),
        )
        .when(urgent == "4-NOT SPECIFIED", F.concat(F.lit("{"), key, F.lit(', "tier": [{"division": {}}]}')))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("{"), key, F.lit(', "tier": null}')))
        .when(F.col("o_orderstatus") == "O", F.lit('{"key": [], "tier": []}'))
        .otherwise(F.lit("not json"))
    )
    orders = roles.dealt(read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), "o_orderkey")
    docs = orders.select("o_orderkey", payload.alias("payload"))
    return contracts.check_payloads(docs, "payload", "league").select("o_orderkey", "violation")


@query("q29_missing_leagues")
def missing_leagues(spark: SparkSession, sf: str) -> DataFrame:
    """Leagues asked for of which no sound document came."""
    checked = contracts.check_payloads(roles.league_documents(spark, sf), "payload", "league")
    sound, _ = contracts.split(checked)
    asked = list(range(40))
    return bronze.missing_partitions(sound.withColumn("league_id", filenames.league_id("file_name")), "league_id", asked)


@query("q29_list_contracts")
def list_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """The three list contracts over event properties used as payloads."""
    event, props = F.col("event_type"), F.col("props")

    def instead(content: str) -> Column:
        return F.regexp_replace(props, '"k": (\\d+)', content)

    damaged = (
        F.when(event == "view", instead('"team": [$1]'))
        .when(event == "click", instead('"ladderMembers": []'))
        .when(event == "purchase", instead('"matches": [{"date": $1}]'))
        .when(event == "signup", instead('"team": null, "matches": $1'))
        .otherwise(F.concat(F.lit("["), props, F.lit("]")))
    )
    events = roles.dealt(read(spark, sf, "events").select("event_id", "event_type", "props"), "event_id")
    docs = events.select("event_id", damaged.alias("payload"))
    return docs.select(
        "event_id",
        contracts.modern_ladder_violation(F.col("payload")).alias("modern"),
        contracts.legacy_ladder_violation(F.col("payload")).alias("legacy"),
        contracts.match_history_violation(F.col("payload")).alias("matches"),
    )


@query("q29_request_wrapping")
def request_wrapping(spark: SparkSession, sf: str) -> DataFrame:
    """Raw payloads wrapped with the ids they were asked for, then read back typed."""
    events = roles.dealt(read(spark, sf, "events").select("event_id", "user_id", "props"), "event_id").select(
        "event_id", F.col("user_id").alias("profile_id"), F.col("props").alias("payload")
    )
    with_ids = documents.with_request_ids(events, ["profile_id"], "payload")
    wrapped = documents.with_key(with_ids, "event_id", "payload")
    schema = "event_id BIGINT, data STRUCT<request_profile_id BIGINT, k INT>"
    parsed = wrapped.select(F.from_json("payload", schema).alias("d"))
    return parsed.select("d.event_id", "d.data.request_profile_id", "d.data.k")


# ------------------------------------------------------- landing and streaming


#: Files of a batch in the document streams.
MAX_FILES = 5


def _stream(spark: SparkSession, sf: str, name: str, files: int = 3) -> DataFrame:
    """One of the given tables, arriving in at least ``files`` files, a file at a time."""
    source = scratch_path(spark, f"arriving-{name}")
    table = read(spark, sf, name)
    table.repartition(files).write.parquet(source)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(source)


def _collector(path: str) -> Callable[[DataFrame, int], None]:
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}")


@query("q30_land_and_flatten")
def land_and_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Structure documents landed below league and time folders, read back and flattened."""
    root = scratch_path(spark, "landed")
    docs = roles.league_documents(spark, sf).withColumns(
        {
            "league": filenames.league_id("file_name"),
            "taken": F.expr("TIMESTAMP_NTZ'2020-01-01 04:40:00'"),
        }
    )
    documents.land(docs, root, silver.LEAGUE.kind, "payload", "taken", "league")
    landed = documents.read_landed(spark, root, silver.LEAGUE.kind, silver.LEAGUE.document)
    return silver.LEAGUE.transform(landed)


@query("q30_load_flows")
def load_flows(spark: SparkSession, sf: str) -> DataFrame:
    """All four kinds of document loaded into their tables, twice: rows that came, rows inserted.

    The documents of a kind are staged as they were parsed, so that each is put together and parsed
    once and not once per load.
    """
    root = scratch_path(spark, "load-flows")
    sources = (
        (silver.LEAGUE, roles.league_documents(spark, sf)),
        (silver.MODERN, roles.modern_documents(spark, sf)),
        (silver.LEGACY, roles.legacy_documents(spark, sf)),
        (silver.MATCHES, roles.match_documents(spark, sf).drop("ts")),
    )
    found = []
    for flow, texts in sources:
        with staging(spark):
            docs = stage(flatten.parse_documents(texts, "payload", flow.document), f"documents-{flow.table.name}")
            for run in (1, 2):
                came, inserted = silver.load(flow, docs, root, AS_OF)
                held = tables.read_table(spark, f"{root}/{flow.table.name}", flow.table).count()
                found.append((flow.table.name, run, came, inserted, held))
    return spark.createDataFrame(found, "name STRING, run INT, processed BIGINT, inserted BIGINT, held BIGINT")


@query("q30_ingest_files")
def ingest_files(spark: SparkSession, sf: str) -> DataFrame:
    """Whole files listed, read, flattened, loaded and noted, in four runs.

    At first the files of leagues below 10 are there; then nothing new; then all; then a lost table is loaded
    anew from the newest file of each league, the ledger being lost too.
    """
    root = scratch_path(spark, "ingest-files")
    docs = roles.legacy_documents(spark, sf)
    flow, small = silver.LEGACY, filenames.league_id("file_name") < 10
    tables.ensure_table(spark, f"{root}/silver/{flow.table.name}", flow.table)
    runs = []

    def turn(target: str, **options: int) -> None:
        done = silver.ingest_window(spark, flow, f"{root}/bronze", f"{root}/{target}", AS_OF, **options)
        held = tables.read_table(spark, f"{root}/{target}/{flow.table.name}", flow.table).count()
        noted = tables.read_table(spark, f"{root}/{target}/{schemas.PROCESSED_FILES.name}", schemas.PROCESSED_FILES).count()
        runs.append(done.select(F.lit(len(runs) + 1).alias("run"), "*", F.lit(held).alias("held"), F.lit(noted).alias("noted")))

    documents.land_files(docs.where(small), f"{root}/bronze", "file_name", "payload")
    turn("silver", files_at_once=7)
    turn("silver")
    documents.land_files(docs.where(~small), f"{root}/bronze", "file_name", "payload")
    turn("silver")
    turn("again", window=1)
    return reduce(DataFrame.unionByName, runs)


@query("q30_stream_ingest")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Match documents landed by day, worked off as a stream and inserted by key."""
    root = scratch_path(spark, "stream-ingest")
    flow = silver.MATCHES
    docs = roles.match_documents(spark, sf).withColumn("day", F.date_trunc("day", F.col("ts")))
    documents.land(docs, f"{root}/bronze", flow.kind, "payload", "day")
    stream = documents.stream_landed(spark, f"{root}/bronze", flow.kind, flow.document, max_files=MAX_FILES)
    streams.ingest(stream, flow, f"{root}/silver", f"{root}/progress", EVENTS_AS_OF).awaitTermination()
    return tables.read_table(spark, f"{root}/silver/{flow.table.name}", flow.table)


@query("q31_stream_first_sightings")
def stream_first_sightings(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "first-sightings")
    keys = ("o_custkey", "o_orderpriority", "o_orderdate")
    table = schemas.Table("sightings", "o_custkey BIGINT, o_orderpriority STRING, o_orderdate TIMESTAMP_NTZ", keys, keys)
    arriving = _stream(spark, sf, "orders").select(*keys)
    streams.first_sightings(arriving, table, f"{root}/out", f"{root}/progress").awaitTermination()
    return tables.read_table(spark, f"{root}/out", table)


def _stream_changes(spark: SparkSession, sf: str) -> str:
    """Counters of arriving ladder documents against the state, over several batches."""
    root = scratch_path(spark, "stream-changes")
    flow = silver.LEGACY
    docs = roles.legacy_documents(spark, sf).withColumns(
        {
            "league": filenames.league_id("file_name"),
            "taken": F.expr("TIMESTAMP_NTZ'2020-01-01 04:40:00'"),
        }
    )
    documents.land(docs, f"{root}/bronze", flow.kind, "payload", "taken", "league")
    stream = documents.stream_landed(spark, f"{root}/bronze", flow.kind, flow.document, max_files=MAX_FILES)
    streams.detect_changes(
        stream,
        worklists.newest_counters,
        f"{root}/state",
        _collector(f"{root}/changed"),
        f"{root}/progress",
        AS_OF,
    ).awaitTermination()
    return root


@query("q32_stream_changes")
def stream_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The state after the stream."""
    root = _stream_changes(spark, sf)
    return tables.read_version(spark, f"{root}/state", schemas.MATCH_HISTORY_CHECKPOINT)


@query("q32_handed_over")
def stream_handed_over(spark: SparkSession, sf: str) -> DataFrame:
    """The changes that the stream's batches handed over."""
    root = _stream_changes(spark, sf)
    written = "character_id BIGINT, realm BIGINT, region BIGINT, current_games BIGINT"
    return spark.read.schema(written).parquet(f"{root}/changed").drop("batch")


@query("q33_stream_upsert")
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Arriving inferences merged into a table that already holds earlier ones."""
    root = scratch_path(spark, "stream-upsert")
    held = _held_facts(read(spark, sf, "orders"))
    table = schemas.Table("facts", held.schema.simpleString()[7:-1], ("match_id",), ("match_id",))
    tables.write_version(held, f"{root}/facts")
    streams.upsert_batches(
        _new_facts(_stream(spark, sf, "orders")),
        table,
        f"{root}/facts",
        {c: merge.INCOMING for c in gold.INFERRED_COLUMNS},
        f"{root}/progress",
    ).awaitTermination()
    return tables.read_version(spark, f"{root}/facts", table)


@query("q34_stream_lookup")
def stream_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Arriving events, each looked up among the events of the 90 minutes before, which arrive too."""
    root = scratch_path(spark, "stream-lookup")
    values = _stream(spark, sf, "events").select("user_id", F.col("ts").alias("seen"), "value")
    running, found = streams.lookup_streams(_asked(_stream(spark, sf, "events")), values, root, f"{root}/progress", **_LOOKUP)
    running.awaitTermination()
    return tables.read_table(spark, f"{root}/{found.name}", found)


# ------------------------------------------- streams with watermarks and state


def _arrive(table: DataFrame, arrived: Column, first: str, days: int, slices: int, path: str) -> Iterator[int]:
    """Append a table to a folder in slices of ``days`` by the time its rows arrive; what is later comes last."""
    since = F.datediff(arrived.cast("date"), F.lit(first).cast("date"))
    number = F.greatest(F.least(F.floor(since / days), F.lit(slices - 1)), F.lit(0))
    for n in range(slices):
        table.where(number == n).write.mode("append").parquet(path)
        yield n


def _later(time: str, minutes: Column) -> Column:
    return F.col(time) + F.make_dt_interval(mins=minutes.cast("int"))


@query("q34_interval_join")
def interval_join(spark: SparkSession, sf: str) -> DataFrame:
    """As ``q34_stream_lookup``, by a join of two streams; probes come up to 5 hours late, evidence up to 6.

    A last row of each stream, a month on, says that nothing more will come.
    """
    root = scratch_path(spark, "interval-join")
    events = read(spark, sf, "events")
    values = events.select("event_id", "user_id", F.col("ts").alias("seen"), "value")
    batches = [
        _arrive(events.select("event_id", "user_id", "ts"), _later("ts", F.col("event_id") * 37 % 300), "2024-01-01", 11, 3, f"{root}/probes"),
        _arrive(values, _later("seen", F.col("event_id") * 101 % 360), "2024-01-01", 11, 3, f"{root}/evidence"),
    ]

    def work_off() -> None:
        probes, evidence = (spark.readStream.schema(t.schema).parquet(f"{root}/{n}") for t, n in ((events.select("event_id", "user_id", "ts"), "probes"), (values, "evidence")))
        found = state.interval_lookup(probes, evidence, **_LOOKUP, lateness=timedelta(hours=6))
        state.append_stream(found, f"{root}/found", f"{root}/progress").awaitTermination()

    for _ in zip(*batches, strict=True):
        work_off()
    end = _day("2024-03-01 00:00:00")
    for name, time, table in (("probes", "ts", events.select("event_id", "user_id", "ts")), ("evidence", "seen", values)):
        last = table.limit(1).withColumns({"user_id": F.lit(-1).cast("long"), time: end})
        last.write.mode("append").parquet(f"{root}/{name}")
    work_off()
    return spark.read.schema("user_id BIGINT, ts TIMESTAMP_NTZ, value DOUBLE, evidence_ts TIMESTAMP_NTZ").parquet(f"{root}/found")


@query("q32_state_changes")
def state_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Counters that go up and down, in five batches, held in the state store.

    The third batch fails in the sink at first and is repeated; customers without a counter for 400 days are forgotten.
    """
    root = scratch_path(spark, "state-changes")
    level = F.floor(F.col("o_totalprice") / 50000).cast("long")
    counters = read(spark, sf, "orders").select("o_orderkey", "o_custkey", level.alias("games"), F.col("o_orderdate").alias("seen"))
    late = F.make_dt_interval(days=(F.col("o_orderkey") % 50).cast("int"))
    collect = _collector(f"{root}/changed")

    def fail(_: DataFrame, number: int) -> None:
        raise RuntimeError("the sink is down")

    for n in _arrive(counters, F.col("seen") + late, "1995-01-01", 482, 5, f"{root}/in"):
        for handle in [fail, collect] if n == 2 else [collect]:
            stream = spark.readStream.schema(counters.schema).parquet(f"{root}/in")
            changes = state.changed_counters(stream, ["o_custkey"], counter="games", at="seen", lateness=timedelta(days=60), keep=timedelta(days=400))
            running = state.hand_over(changes, handle, f"{root}/progress")
            try:
                running.awaitTermination()
            except StreamingQueryException:
                if handle is collect:
                    raise
    written = "o_custkey BIGINT, previous BIGINT, games BIGINT, seen TIMESTAMP"
    return spark.read.schema(written).parquet(f"{root}/changed").select("o_custkey", "previous", "games", F.col("seen").cast("timestamp_ntz").alias("seen"))


@query("q31_bounded_sightings")
def bounded_sightings(spark: SparkSession, sf: str) -> DataFrame:
    """First sightings of rows that may come 60 days late, and the rows that came later."""
    root = scratch_path(spark, "bounded-sightings")
    keys = ["o_custkey", "o_orderpriority", "o_orderdate"]
    rows = read(spark, sf, "orders").select("o_orderkey", *keys)
    days = F.when(F.col("o_orderkey") % 10 == 0, 400).otherwise(F.col("o_orderkey") % 30)
    for _ in _arrive(rows, F.col("o_orderdate") + F.make_dt_interval(days=days.cast("int")), "1995-01-01", 810, 3, f"{root}/in"):
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        state.first_sightings_within(stream, keys, "o_orderdate", timedelta(days=60), root)
    kind = "o_orderkey BIGINT, o_custkey BIGINT, o_orderpriority STRING, o_orderdate TIMESTAMP_NTZ"
    seen = state.sightings(spark, root, kind).select(F.lit(False).alias("late"), *keys)
    return seen.unionByName(state.late_rows(spark, root, kind).select(F.lit(True).alias("late"), *keys))
