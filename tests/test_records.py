import datetime as dt

from pyspark.sql import functions as F

from tests import fixtures as fx
from touchline.operators import events as event_ops
from touchline.operators import sheets
from touchline.sources import records, sinks, tables


def test_lines_are_routed_and_bad_ones_kept(spark):
    feed = fx.lines(spark, [
        fx.match(1, [fx.team(10, [1]), fx.team(20, [2])]),
        fx.event(1, 8, [1801, 302]),
        fx.event(1, 3, [101], sub=""),
        "{broken",
    ])
    parsed = records.parse_lines(feed)
    events = records.route_events(parsed).collect()
    assert [(e.eventId, e.subEventId, list(e.tag_ids)) for e in events] == [
        (8, 0, [1801, 302]), (3, None, [101])]
    matches = records.route_matches(parsed).collect()
    assert [(m.wyId, m.match_date) for m in matches] == [(1, dt.date(2018, 5, 13))]
    assert [r[0] for r in records.corrupt_lines(parsed).collect()] == ["{broken"]


def test_match_dates(spark):
    texts = ["May 5, 2018 at 8:45:00 PM GMT+2", " December 31, 2017 at 1:30:00 PM GMT", "soon"]
    feed = fx.lines(spark, [fx.match(i, [], date=t) for i, t in enumerate(texts)])
    rows = records.route_matches(records.parse_lines(feed)).orderBy("wyId").collect()
    assert [r.match_date for r in rows] == [dt.date(2018, 5, 5), dt.date(2017, 12, 31), None]


def test_lines_survive_a_round_trip(spark):
    feed = fx.lines(spark, [
        fx.match(1, [fx.team(10, [1], [3], [(3, 1, 70)]), fx.team(20, [2])]), fx.event(1, 8, [1801])])
    parsed = records.parse_lines(feed)
    matches, events = records.route_matches(parsed), records.route_events(parsed)
    again = records.parse_lines(records.match_line(matches).unionByName(records.event_line(events)))
    assert records.route_matches(again).collect() == matches.collect()
    assert records.route_events(again).collect() == events.collect()


def test_feed_sends_each_match_before_its_events(spark):
    feed = fx.lines(spark, [
        fx.match(2, [], date="May 6, 2018 at 1"), fx.match(1, [], date="May 5, 2018 at 1"),
        fx.event(1, 8, match=2), fx.event(1, 8, match=1), fx.event(1, 8, match=9)])
    parsed = records.parse_lines(feed)
    events = records.route_events(parsed).withColumn("event_id", F.monotonically_increasing_id())
    rows = records.feed_lines(events, records.route_matches(parsed)).collect()
    assert [(r.matchId, r.is_event) for r in rows] == [(1, False), (1, True), (2, False), (2, True)]


def test_flattening_of_a_match_record(spark):
    feed = fx.lines(spark, [fx.match(1, [
        fx.team(10, [1, 2], [3, 4], [(3, 2, 60)]), fx.team(20, [5], [6], formed=0)])])
    made = sheets.team_sheets(records.route_matches(records.parse_lines(feed)))
    entries = sheets.formation_entries(made).select("teamId", "section", "place", "playerId")
    assert sorted(map(tuple, entries.collect())) == [
        (10, "bench", 0, 3), (10, "bench", 1, 4), (10, "lineup", 0, 1), (10, "lineup", 1, 2)]
    assert list(map(tuple, sheets.substitutions(made).collect())) == [(1, 10, 3, 2, 60)]
    closing = sheets.closing_squads(made).collect()[0]
    assert (closing.stayed_on, closing.unused) == ([1], [4])


def test_unknown_players_are_dropped(spark):
    parsed = records.parse_lines(fx.lines(spark, [fx.event(1, 8), fx.event(99, 8)]))
    known = event_ops.of_known_players(
        records.route_events(parsed), fx.players(spark, [(1, "A", "GK")]))
    assert [r.playerId for r in known.collect()] == [1]


def test_player_and_team_files(spark, tmp_path):
    player_file, team_file = tmp_path / "players.csv", tmp_path / "teams.csv"
    player_file.write_text(
        "name,birthArea,birthDate,foot,role,height,passportArea,weight,Id,numFouls,numGoals,"
        "numOwnGoals,passAcc,shotsOnTarget,normalPasses,keyPasses,accNormalPasses,accKeyPasses,"
        "rating,numMatches\n"
        "Ann Keeper,Wales,1993-03-15 00:00:00,left,GK,180,Wales,75,7,9,9,9,0.9,9,9,9,9,9,0.9,9\n")
    team_file.write_text("name,Id\nHome FC,10\n")
    row = tables.with_career_defaults(tables.read_players(spark, str(player_file))).collect()[0]
    assert (row.Id, row.name, row.birthDate, row.numFouls, row.rating, row.previousRating) == (
        7, "Ann Keeper", dt.datetime(1993, 3, 15), 0, 0.5, 0.5)
    teams = tables.read_teams(spark, str(team_file))
    tables.register(Teams=teams, Player=tables.read_players(spark, str(player_file)))
    assert list(map(tuple, spark.sql("SELECT * FROM Teams").collect())) == [("Home FC", 10)]
    assert [r.Id for r in tables.player_ids(spark).collect()] == [7]


def test_requests_in_and_responses_out_keep_their_order(spark, tmp_path):
    source = tmp_path / "requests.txt"
    source.write_text("".join(f'{{"req_type": 2, "name": "P{i}"}}\n' for i in range(50)))
    requests = tables.read_requests(spark, str(source))
    answers = requests.repartition(7).select(
        "request_seq", F.to_json(F.struct("name")).alias("response"))
    sinks.write_responses(answers, str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("part-*"))
    written = [line for p in parts for line in p.read_text().splitlines()]
    assert written == [f'{{"name":"P{i}"}}' for i in range(50)]


def test_a_match_sent_twice_is_stored_once(spark):
    first = records.route_matches(records.parse_lines(fx.lines(spark, [fx.match(1, []), fx.match(2, [])])))
    again = records.route_matches(records.parse_lines(fx.lines(spark, [fx.match(2, []), fx.match(3, [])])))
    keep = ["wyId", "status", "match_date"]
    stored = sinks.append_matches(first.select(keep), again.select(keep))
    assert sorted(r.wyId for r in stored.collect()) == [1, 2, 3]
