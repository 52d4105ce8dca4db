"""A league feed derived from the orders and events tables.

Every order is one match. The orders of a competition and season, taken in date order, fill a
20-team round robin ten matches to a round. From that schedule come the provider's responses
(competitions, teams, matches, standings) that the landing step reads, each in two loads, and the
events table stands in for the log of past pipeline runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.functions.expressions import season_start_year
from leaguelake.operators.latest import latest_per_key
from leaguelake.operators.ordered import month_of, running_totals
from leaguelake.sources.schemas import COUNTED_STATUSES, RUN_EVENTS, TABLE_STAGES

# Fixed values of the feed.
SOURCE = "orders-feed"
TEAMS = 20
MATCHES_PER_ROUND = 10
FIRST_LOAD, SECOND_LOAD = "load-1", "load-2"
LOAD_TIMES = {FIRST_LOAD: "2001-08-02 06:00:00", SECOND_LOAD: "2001-08-02 18:00:00"}
UPCOMING_FROM = "2001-03-01"
CUP = "C2"
UNIT = ["competition_code", "season"]
KEEP_NULLS = {"ignoreNullFields": "false"}


def schedule(orders: DataFrame) -> DataFrame:
    """Orders -> matches, with the integer rules that place each one in its round."""
    day = F.col("o_orderdate")
    keyed = orders.select(
        F.concat(F.lit("C"), F.substring("o_orderpriority", 1, 1)).alias("competition_code"),
        season_start_year(day).cast("string").alias("season"),
        day.alias("kickoff_utc"),
        "o_orderkey",
        (F.floor("o_totalprice").cast("long") % 5).alias("drawn_home"),
        ((3 * F.col("o_orderkey") + F.col("o_custkey")) % 4).alias("drawn_away"),
    )
    placed = running_totals(
        keyed, UNIT, [F.col("kickoff_utc").asc_nulls_last(), F.col("o_orderkey").asc_nulls_last()],
        month_of("kickoff_utc"), {"place": F.lit(1)},
    )
    rounds = placed.withColumn("rd", F.expr(f"(place - 1) div {MATCHES_PER_ROUND}")).withColumn(
        "k", (F.col("place") - 1) % MATCHES_PER_ROUND
    )
    others = TEAMS - 1
    first = F.when(F.col("k") == 0, others).otherwise((F.col("rd") + F.col("k")) % others)
    second = F.when(F.col("k") == 0, F.col("rd") % others).otherwise(F.pmod(F.col("rd") - F.col("k"), F.lit(others)))
    turned = F.col("rd") % 2 == 1
    status = (
        F.when(F.col("kickoff_utc") >= F.lit(UPCOMING_FROM).cast("timestamp_ntz"), "TIMED")
        .when(F.col("o_orderkey") % 50 == 0, "AWARDED")
        .when(F.col("o_orderkey") % 97 == 0, "POSTPONED")
        .otherwise("FINISHED")
    )
    return (
        rounds.withColumn("status", status)
        .select(
            *UNIT,
            "kickoff_utc",
            F.col("o_orderkey").alias("id"),
            (F.col("rd") + 1).alias("matchday"),
            F.when(turned, second).otherwise(first).cast("long").alias("home"),
            F.when(turned, first).otherwise(second).cast("long").alias("away"),
            "status",
            F.when((F.col("competition_code") == CUP) & (F.col("rd") % 6 == 5), "LAST_16")
            .when(F.col("competition_code") == CUP, "GROUP_STAGE")
            .otherwise("REGULAR_SEASON")
            .alias("stage"),
            F.when(F.col("status").isin(*COUNTED_STATUSES), F.col("drawn_home")).alias("home_goals"),
            F.when(F.col("status").isin(*COUNTED_STATUSES), F.col("drawn_away")).alias("away_goals"),
        )
    )


def _stamped(envelopes: DataFrame) -> DataFrame:
    """Adds what the loader knows: the run and its load time."""
    times = F.create_map(*[F.lit(v) for pair in LOAD_TIMES.items() for v in pair])
    return envelopes.withColumn("source", F.lit(SOURCE)).withColumn(
        "loaded_at", times[F.col("run_id")].cast("timestamp_ntz")
    )


def _both_loads() -> Column:
    return F.explode(F.array(F.lit(FIRST_LOAD), F.lit(SECOND_LOAD))).alias("run_id")


def _team_name(team: Column) -> Column:
    return F.concat(F.lit("Team "), F.lpad(team.cast("string"), 2, "0"))


def _team(team: Column) -> Column:
    return F.struct(team.alias("id"), _team_name(team).alias("name"))


def _utc_text(moment: Column) -> Column:
    return F.concat(F.replace(moment.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def match_envelopes(matches: DataFrame) -> DataFrame:
    """One response per round (ten matches), first as fixtures, then with results."""
    home, away = F.col("home_goals"), F.col("away_goals")
    winner = F.when(home > away, "HOME_TEAM").when(home < away, "AWAY_TEAM").when(home == away, "DRAW")
    final = F.col("run_id") == SECOND_LOAD

    def goals(of_home: Column, of_away: Column) -> Column:
        return F.struct(F.when(final, of_home).alias("home"), F.when(final, of_away).alias("away"))

    item = F.struct(
        "id",
        _utc_text(F.col("kickoff_utc")).alias("utcDate"),
        F.when(final, F.col("status")).otherwise("TIMED").alias("status"),
        "matchday",
        "stage",
        _team(F.col("home")).alias("homeTeam"),
        _team(F.col("away")).alias("awayTeam"),
        F.struct(
            F.when(final, winner).alias("winner"),
            goals(home, away).alias("fullTime"),
            goals(F.expr("home_goals div 2"), F.expr("away_goals div 2")).alias("halfTime"),
        ).alias("score"),
    )
    rounds = (
        matches.select("*", _both_loads())
        .groupBy(*UNIT, "matchday", "run_id")
        .agg(F.collect_list(item).alias("matches"))
    )
    payload = F.to_json(
        F.struct(F.struct(F.col("competition_code").alias("code")).alias("competition"), "matches"), KEEP_NULLS
    )
    return _stamped(rounds.select(*UNIT, "run_id", payload.alias("payload")))


def team_envelopes(matches: DataFrame) -> DataFrame:
    """One response per unit with all twenty teams; names are provisional in the first load."""
    provisional = F.when(F.col("run_id") == FIRST_LOAD, " (provisional)").otherwise("")

    def team(number: Column) -> Column:
        digits = F.lpad(number.cast("string"), 2, "0")
        return F.struct(
            number.alias("id"),
            F.concat(_team_name(number), provisional).alias("name"),
            F.concat(F.lit("T"), digits).alias("shortName"),
            F.concat(F.lit("T"), digits).alias("tla"),
            F.concat(F.lit("crests/"), digits, F.lit(".png")).alias("crest"),
            (number + 1900).alias("founded"),
            F.lit("Red / White").alias("clubColors"),
            F.concat(F.lit("Ground "), digits, F.lit(" "), F.col("season")).alias("venue"),
        )

    units = matches.select(*UNIT).distinct().select(*UNIT, _both_loads())
    teams = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(TEAMS - 1).cast("long")), team)
    payload = F.to_json(F.struct(F.lit(TEAMS).alias("count"), teams.alias("teams")))
    return _stamped(units.select(*UNIT, "run_id", payload.alias("payload")))


def competition_envelopes(matches: DataFrame) -> DataFrame:
    """One response per competition describing its newest season."""
    seasons = matches.groupBy(*UNIT).agg(
        F.min("kickoff_utc").cast("date").cast("string").alias("startDate"),
        F.max("kickoff_utc").cast("date").cast("string").alias("endDate"),
        F.max("matchday").alias("last_matchday"),
    )
    newest = latest_per_key(seasons, ["competition_code"], [F.col("season").desc()]).select("*", _both_loads())
    number = F.substring("competition_code", 2, 1).cast("long")
    payload = F.to_json(
        F.struct(
            (number + 2000).alias("id"),
            F.concat(F.lit("Competition "), F.col("competition_code")).alias("name"),
            F.col("competition_code").alias("code"),
            F.when(F.col("competition_code") == CUP, "CUP").otherwise("LEAGUE").alias("type"),
            F.struct(
                F.concat(F.lit("Area "), (6 - number).cast("string")).alias("name"),
                F.concat(F.lit("A"), (6 - number).cast("string")).alias("code"),
            ).alias("area"),
            F.struct(
                (F.col("season").cast("long") * 10 + number).alias("id"),
                "startDate",
                "endDate",
                F.when(F.col("run_id") == FIRST_LOAD, 1).otherwise(F.col("last_matchday")).alias("currentMatchday"),
            ).alias("currentSeason"),
        )
    )
    return _stamped(
        newest.select("competition_code", F.lit(None).cast("string").alias("season"), "run_id", payload.alias("payload"))
    )


def standing_envelopes(matches: DataFrame) -> DataFrame:
    """The provider's own tables, totalled per team without windows, three types per unit.

    Two known errors are planted in the overall table: a point too many for team ids divisible by
    seven, and a goal difference two too low for team 13. The first load has empty tables.
    """
    counted = matches.filter(F.col("status").isin(*COUNTED_STATUSES) & F.col("stage").isin(*TABLE_STAGES))

    def side(kind: str, team: str, scored: str, conceded: str) -> Column:
        return F.struct(
            F.lit(kind).alias("type"), F.col(team).alias("team"),
            F.col(scored).alias("scored"), F.col(conceded).alias("conceded"),
        )

    home = ("home", "home_goals", "away_goals")
    away = ("away", "away_goals", "home_goals")
    sides = counted.select(
        *UNIT,
        "stage",
        F.inline(F.array(side("TOTAL", *home), side("HOME", *home), side("TOTAL", *away), side("AWAY", *away))),
    )
    scored, conceded = F.col("scored"), F.col("conceded")
    totals = sides.groupBy(*UNIT, "stage", "type", "team").agg(
        F.count(F.lit(1)).alias("played"),
        F.count_if(scored > conceded).alias("won"),
        F.count_if(scored == conceded).alias("draw"),
        F.count_if(scored < conceded).alias("lost"),
        F.sum("scored").alias("goals_for"),
        F.sum("conceded").alias("goals_against"),
    ).withColumn("points", 3 * F.col("won") + F.col("draw"))
    overall = F.col("type") == "TOTAL"
    difference = F.col("goals_for") - F.col("goals_against")
    standing = F.struct(
        (-F.col("points")).alias("by_points"), (-difference).alias("by_difference"),
        (-F.col("goals_for")).alias("by_goals"),
        _team(F.col("team")).alias("team"),
        F.col("played").alias("playedGames"), "won", "draw", "lost",
        (F.col("points") + F.when(overall & (F.col("team") % 7 == 0), 1).otherwise(0)).alias("points"),
        F.col("goals_for").alias("goalsFor"), F.col("goals_against").alias("goalsAgainst"),
        (difference - F.when(overall & (F.col("team") == 13), 2).otherwise(0)).alias("goalDifference"),
    )
    # At most twenty teams per table, so sorting the collected list is bounded.
    tables = totals.groupBy(*UNIT, "stage", "type").agg(F.sort_array(F.collect_list(standing)).alias("rows"))

    def placed(row: Column, index: Column) -> Column:
        return F.struct(
            (index + 1).alias("position"),
            *[row[name].alias(name) for name in (
                "team", "playedGames", "won", "draw", "lost", "points", "goalsFor", "goalsAgainst", "goalDifference"
            )],
        )

    numbered = tables.select(*UNIT, "stage", "type", F.transform("rows", placed).alias("table"))
    units = numbered.groupBy(*UNIT).agg(F.collect_list(F.struct("stage", "type", "table")).alias("standings"))
    emptied = F.transform(
        "standings",
        lambda s: F.struct(s["stage"].alias("stage"), s["type"].alias("type"), F.slice(s["table"], 1, 0).alias("table")),
    )
    loads = units.select("*", _both_loads()).withColumn(
        "standings", F.when(F.col("run_id") == FIRST_LOAD, emptied).otherwise(F.col("standings"))
    )
    payload = F.to_json(
        F.struct(
            F.struct(F.col("competition_code").alias("code")).alias("competition"),
            F.struct(F.col("season").cast("long").alias("id")).alias("season"),
            "standings",
        )
    )
    return _stamped(loads.select(*UNIT, "run_id", payload.alias("payload")))


def damaged_envelopes(envelopes: DataFrame, round_column: Column) -> DataFrame:
    """Spoils some responses by their round, one kind of damage each; the others stay as they are."""
    payload = F.col("payload")
    spoiled = (
        F.when(round_column % 11 == 0, F.expr("left(payload, length(payload) - 1)"))
        .when(round_column % 13 == 0, F.replace(payload, F.lit('"matches":'), F.lit('"fixtures":')))
        .when(round_column % 17 == 0, F.concat(F.lit('{"matches":{"only":'), payload, F.lit("}}")))
        .otherwise(payload)
    )
    return envelopes.withColumn("payload", spoiled)


def mistyped(item: Column, matchday: Column) -> Column:
    """Gives some matches a field of another type by their round: matchday, kickoff, home goals or a team."""
    text = F.to_json(item)
    spoiled = (
        F.when(matchday % 7 == 3, F.regexp_replace(text, '"matchday":[0-9]+', '"matchday":"later"'))
        .when(matchday % 7 == 4, F.regexp_replace(text, '"utcDate":"[^"]*"', '"utcDate":"soon"'))
        .when(matchday % 7 == 5, F.regexp_replace(text, '"fullTime":\\{"away":([^,]*),"home":[0-9]+\\}',
                                                  '"fullTime":{"away":$1,"home":"many"}'))
        .when(matchday % 7 == 6, F.regexp_replace(text, '"homeTeam":\\{[^}]*\\}', '"homeTeam":[1]'))
    )
    return F.when(matchday % 7 >= 3, F.parse_json(spoiled)).otherwise(item)


def run_events(events: DataFrame) -> DataFrame:
    """Every event is one past run: a RUNNING event, and for most an end as SUCCESS or FAILED."""
    event, user = F.col("event_id"), F.col("user_id")
    season = 1994 + (event + user) % 9
    dataset = F.element_at(
        F.array(*[F.lit(d) for d in ("competitions", "teams", "matches", "standings")]), (event % 4 + 1).cast("int")
    )
    received = F.floor(F.col("value") * 10).cast("long")
    rejected = F.floor("value").cast("long") % 3
    failed = (F.col("event_type") == "error") | ((F.col("dataset") == "standings") & (F.col("season_year") % 2 == 1))
    base = events.select(
        F.concat(F.lit("run-"), event.cast("string")).alias("run_id"),
        F.when(F.col("event_type").isin("click", "view"), "leaguelake.daily")
        .otherwise("leaguelake.backfill")
        .alias("pipeline_name"),
        dataset.alias("dataset"),
        F.lit(SOURCE).alias("source"),
        F.concat(F.lit("C"), (user % 6 + 1).cast("string")).alias("competition_code"),
        season.alias("season_year"),
        season.cast("string").alias("season"),
        F.lit(None).cast("string").alias("matchweek"),
        F.lit(None).cast("timestamp_ntz").alias("watermark"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(secs=F.floor("value").cast("int") + 1)).alias("ended_at"),
        received.alias("received"),
        rejected.alias("rejected"),
        "event_type",
        (event % 50 == 0).alias("unfinished"),
        F.concat(F.lit("failed: "), F.col("props")).alias("message"),
    ).withColumn("failed", failed)
    ends = F.when(F.col("unfinished"), F.array(F.lit("RUNNING"))).otherwise(
        F.array(F.lit("RUNNING"), F.when(F.col("failed"), "FAILED").otherwise("SUCCESS"))
    )
    done, good = F.col("status") != "RUNNING", F.col("status") == "SUCCESS"
    return (
        base.withColumn("status", F.explode(ends))
        .withColumn("completed_at", F.when(done, F.col("ended_at")))
        .withColumn("records_received", F.when(good, F.col("received")))
        .withColumn("records_inserted", F.when(good, F.greatest(F.col("received") - F.col("rejected"), F.lit(0))))
        .withColumn("records_updated", F.lit(None).cast("long"))
        .withColumn("records_rejected", F.when(good, F.col("rejected")))
        .withColumn("error_message", F.when(F.col("status") == "FAILED", F.col("message")))
        .select(*RUN_EVENTS.names)
    )


def unusable_lines(matches: DataFrame) -> DataFrame:
    """Four lines for each unit that name none or are no JSON: column value."""

    def line(**fields: Column) -> Column:
        return F.to_json(F.struct(*[c.alias(n) for n, c in {**fields, "payload": F.lit("{}")}.items()]))

    code, season = F.col("competition_code"), F.col("season")
    whole = line(dataset=F.lit("matches"), competition_code=code, season=season)
    lines = F.array(
        F.substring(whole, 1, 40),
        line(dataset=F.lit("referees"), competition_code=code, season=season),
        line(dataset=F.lit("matches"), season=season),
        line(dataset=F.lit("standings"), competition_code=code),
    )
    return matches.select(*UNIT).distinct().select(F.explode(lines).alias("value"))
