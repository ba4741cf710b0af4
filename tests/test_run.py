"""From files to answers, the way a user runs it."""

import json

import pytest

import run
from tests import fixtures as fx

HEADER = ("name,birthArea,birthDate,foot,role,height,passportArea,weight,Id,numFouls,numGoals,"
          "numOwnGoals,passAcc,shotsOnTarget,normalPasses,keyPasses,accNormalPasses,accKeyPasses,"
          "rating,numMatches\n")


def test_feed_to_answers(spark, tmp_path):
    people = [(i, f"P{i}", fx.ROLES[(i - 1) % 11]) for i in range(1, 23)]
    (tmp_path / "players.csv").write_text(HEADER + "".join(
        f"{n},Area,1993-03-15 00:00:00,left,{r},180,Area,75,{i},0,0,0,0,0,0,0,0,0,0,0\n"
        for i, n, r in people))
    (tmp_path / "teams.csv").write_text("name,Id\nHome FC,10\nAway FC,20\n")
    records = []
    for m in range(1, 7):
        records.append(fx.match(m, [fx.team(10, range(1, 12)), fx.team(20, range(12, 23))],
                                date=f"May {m}, 2018 at 1", label=f"Game {m}", winner=10))
        for i, _, _ in people:
            records += [fx.event(i, 8, (1801,), match=m), fx.event(i, 1, (703,), match=m),
                        fx.event(i, 10, (1801,), match=m), fx.event(i, 3, (1801,), match=m)]
    (tmp_path / "feed").mkdir()
    half = len(records) // 2

    def send(name, rows):
        (tmp_path / "feed" / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
    requests = [fx.prediction([f"P{i}" for i in range(1, 12)], [f"P{i}" for i in range(12, 23)]),
                {"req_type": 2, "name": "P3"}, {"req_type": 3, "date": "2018-05-02", "label": "Game 2"},
                {"req_type": 7}]
    (tmp_path / "requests.txt").write_text("".join(json.dumps(r) + "\n" for r in requests))

    files = ["--players", f"{tmp_path}/players.csv"]
    take = ["ingest", "--once", "--end", "--option", f"path={tmp_path}/feed", "--tables",
            f"{tmp_path}/tables", *files]
    # The second half comes first, and one match is cut in two: late matches and a pause.
    send("a.txt", [*records[half - 20:], "no record"])
    run.main(take)
    send("b.txt", records[:half - 20])
    run.main(take)
    store = run.Store(spark, f"{tmp_path}/tables")
    corrupt = store.read(store.latest(), "corrupt").collect()
    assert [r[0] for r in corrupt] == ['"no record"']
    common = [*files, "--teams", f"{tmp_path}/teams.csv", "--requests", f"{tmp_path}/requests.txt"]
    run.main(["answer", "--tables", f"{tmp_path}/tables", "--out", f"{tmp_path}/out1", *common])
    run.main(["answer", "--feed", f"{tmp_path}/feed", "--out", f"{tmp_path}/out2", *common])

    def answers(folder):
        parts = sorted((tmp_path / folder).glob("part-*"))
        return [json.loads(line) for p in parts for line in p.read_text().splitlines()]

    # Requests that arrive are answered as they come, each batch from one view of the tables.
    (tmp_path / "asked").mkdir()
    serve = ["serve", "--once", "--tables", f"{tmp_path}/tables", *files, "--teams",
             f"{tmp_path}/teams.csv", "--requests", f"{tmp_path}/asked", "--out", f"{tmp_path}/served"]
    text = (tmp_path / "requests.txt").read_text().splitlines(keepends=True)
    (tmp_path / "asked" / "a.txt").write_text("".join(text[:3]))
    run.main(serve)
    (tmp_path / "asked" / "b.txt").write_text(text[3])
    run.main(serve)
    served = answers("served/responses/batch_id=0") + answers("served/responses/batch_id=1")

    # A round that is cut off between two tables changes nothing for those who ask.
    view = store.latest()
    send("c.txt", [fx.event(3, 8, (1801,), match=2)] * 5 + [fx.match(7, [], label="Game 7")])
    args = type("Args", (), {"option": [f"path={tmp_path}/feed"], "source": "text", "gap": "3 hours",
                             "delay": "10 minutes", "players": f"{tmp_path}/players.csv"})()
    steps = run.ingest_steps(spark, store, args)

    def cut_off():
        raise InterruptedError

    with pytest.raises(InterruptedError):
        run.one_round(store, {**steps, "finished": cut_off}, False, args)
    assert store.written("counts").count() > store.read(store.latest(), "counts").count()
    run.main(["answer", "--tables", f"{tmp_path}/tables", "--out", f"{tmp_path}/out3", *common])
    assert store.latest().number == view.number and answers("out3") == answers("out1")
    # The next round goes on where this one stopped; the late events change the finished match.
    run.one_round(store, steps, True, args)
    run.main(["answer", "--tables", f"{tmp_path}/tables", "--out", f"{tmp_path}/out4", *common])
    run.main(["answer", "--feed", f"{tmp_path}/feed", "--out", f"{tmp_path}/out5", *common])
    assert answers("out4")[1:] == answers("out5")[1:] and answers("out4")[1] == answers("out1")[1]
    chances = [answers(out)[0]["team1"]["winning chance"] for out in ("out4", "out5")]
    assert chances[0] == pytest.approx(chances[1])

    got = answers("out1")
    assert served == got
    again = answers("out2")
    assert got[1:] == again[1:]
    for answer in (got[0], again[0]):
        assert answer["team1"]["winning chance"] == pytest.approx(50)
    assert (got[1]["name"], got[1]["birthDate"], got[1]["percent_shots_on_target"]) == (
        "P3", "1993-03-15", 100)
    assert (got[2]["winner"], got[2]["date"]) == ("Home FC", "2018-05-02")
    assert got[3] == {"msg": "Invalid request"}
