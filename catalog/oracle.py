"""SQL that computes the registered queries in another engine (DuckDB), straight from the
test tables. Written apart from the Spark operators: tag chains are CASE expressions here, the
rating recursion is a list fold, formations never pass through a match record."""

from __future__ import annotations

COUNTS = """count(*) filter (where pass in ('acc', 'plain')) as "normalPasses",
    count(*) filter (where pass in ('acc key', 'key')) as "keyPasses",
    count(*) filter (where pass = 'acc') as "accNormalPasses",
    count(*) filter (where pass = 'acc key') as "accKeyPasses",
    count(*) filter (where duel = 'won') as "duelsWon",
    count(*) filter (where duel = 'neutral') as "neutralDuels",
    count(duel) as "totalDuels",
    count(*) filter (where "eventId" = 3 and t1801) as "effectiveFreeKicks",
    count(*) filter (where "eventId" = 3 and "subEventId" = 35 and t101) as "penaltiesScored",
    count(*) filter (where "eventId" = 3) as "totalFreeKicks",
    count(*) filter (where shot = 'goal') as "targetAndGoal",
    count(*) filter (where shot = 'saved') as "targetNotGoal",
    count(shot) as "totalShots",
    count(*) filter (where shot in ('goal', 'saved')) as "shotsOnTarget",
    count(*) filter (where "eventId" = 10 and t101) as "numGoals",
    count(*) filter (where "eventId" = 2) as "foulLoss",
    count(*) filter (where t102) as "ownGoals"
    """

def _fit() -> str:
    """The clustering as a recursive query: first centers one after the other, then rounds of means."""
    columns = ["height", "weight", "coalesce(fouls, 0)", "coalesce(goals, 0)",
               "coalesce(own_goals, 0)",
               "coalesce((acc_normal + 2 * acc_key) / nullif(normal + 2 * keyed, 0), 0)",
               "coalesce(on_target, 0)", "coalesce(normal, 0)", "coalesce(keyed, 0)",
               "coalesce(acc_normal, 0)", "coalesce(acc_key, 0)", "f.rating", "f.matches"]
    x = ", ".join(f"cast(floor(cast({c} as double) * 1000 + 0.5000001) as bigint)" for c in columns)

    def apart(center: str) -> str:
        return "(" + " + ".join(f"cast(x[{i}] - {center}[{i}] as double)"
                                f" * cast(x[{i}] - {center}[{i}] as double)"
                                for i in range(1, len(columns) + 1)) + ")"

    starts = ['fx_c1 as (select arg_min(x, "Id") as c1 from fx_points)']
    for k in range(2, 6):
        known = [f"c{i}" for i in range(1, k)]
        far = ", ".join(apart(c) for c in known)
        starts.append(f"""fx_c{k} as (select {", ".join(known)}, x as c{k} from fx_points, fx_c{k - 1}
          order by least({far}) desc, "Id" limit 1)""")
    every = ", ".join(apart(f"centers[{k}]") for k in range(1, 6))
    means = ", ".join(f"cast(sum(x[{i}]) // count(*) as bigint)" for i in range(1, len(columns) + 1))
    return f"""fx_points as (
  select p."Id", [{x}] as x
  from fx_players p join profiled f on f."Id" = p."Id" left join totals t on t."playerId" = p."Id"),
{", ".join(starts)},
fx_fit as (
  select 0 as round, [c1, c2, c3, c4, c5] as centers, true as moving from fx_c5
  union all
  select round + 1, next, next <> centers from (
    select round, centers, list_transform(range(5), lambda k: coalesce(
      list_extract(list_filter(found, lambda f: f.k = k), 1).c, centers[k + 1])) as next
    from (
      select round, centers, list({{'k': k, 'c': c}}) as found from (
        select round, centers, k, [{means}] as c from (
          select round, centers, x, list_position(far, list_min(far)) - 1 as k from (
            select round, centers, x, [{every}] as far from fx_fit, fx_points
            where moving and round < 20))
        group by round, centers, k)
      group by round, centers))),
fx_clusters as (
  select "Id", cast(list_position(far, list_min(far)) - 1 as int) as prediction from (
    select "Id", [{every}] as far
    from fx_points, (select centers from fx_fit order by round desc limit 1)))"""


CLUSTERS = _fit()

VIEWS = """
fx_teams as (
  select s_suppkey + 1 as "Id", s_name as name from supplier
  union all
  select distinct c_custkey // 14 + 1, 'Team ' || (c_custkey // 14 + 1) from customer
  where c_custkey // 14 not in (select s_suppkey from supplier)),
fx_players as (
  select c_custkey as "Id", c_name as name, c_custkey // 14 + 1 as "teamId", c_custkey % 14 as slot,
    case when c_custkey % 14 = 0 then 'GK' when c_custkey % 14 in (1, 2, 3, 4, 12) then 'DF'
         when c_custkey % 14 in (5, 6, 7, 8, 13) then 'MD' else 'FW' end as role,
    cast(165 + c_custkey % 31 as int) as height, cast(60 + c_custkey % 37 as int) as weight,
    'Area ' || c_custkey % 7 as "birthArea",
    date '1983-01-01' + cast(c_custkey * 37 % 7300 as int) as "birthDate",
    case when c_custkey % 4 = 0 then 'left' else 'right' end as foot,
    case when c_custkey % 5 <> 0 then 'Area ' || c_custkey % 3 end as "passportArea"
  from customer),
fx_pairs as (
  select ("teamId" - 1) // 2 as m, count(*) as players from fx_players group by 1
  having count(distinct "teamId") = 2),
fx_raw as (
  select event_id, ts, 2 * user_id + event_id % 2 as "playerId", event_type,
    cast(json_extract_string(props, '$.k') as int) as k,
    cast(floor((epoch(ts) - epoch(timestamp '2024-01-01 00:00:00')) / 518400) as int) as matchday
  from events),
fx_events as (
  select event_id, ts, r."playerId", p."teamId", matchday,
    (p."teamId" - 1) // 2 * 100000 + matchday as "matchId",
    case event_type when 'view' then 8 when 'click' then 1 when 'signup' then 3
                    when 'purchase' then 10 else 2 end as "eventId",
    case when event_type = 'signup' and k % 5 = 0 then 35 else 0 end as "subEventId",
    event_type = 'click' and k % 10 < 3 as t701,
    event_type = 'click' and k % 10 between 3 and 5 as t702,
    event_type = 'click' and k % 10 between 6 and 8 as t703,
    case event_type when 'view' then k % 10 < 7 when 'signup' then k % 2 = 0
                    when 'purchase' then k % 2 = 0 else false end as t1801,
    case event_type when 'view' then k % 10 in (7, 8) when 'signup' then k % 2 = 1
                    when 'purchase' then k % 2 = 1 else false end as t1802,
    event_type = 'view' and k % 4 = 0 as t302,
    case event_type when 'signup' then k % 10 = 0 when 'purchase' then k % 6 = 0
                    else false end as t101,
    k = 24 as t102
  from fx_raw r join fx_players p on p."Id" = r."playerId"),
classed as (
  select *,
    case when "eventId" <> 8 then null when t1801 and t302 then 'acc key' when t1801 then 'acc'
         when t1802 then 'plain' when t302 then 'key' end as pass,
    case when "eventId" <> 1 then null when t701 then 'lost' when t702 then 'neutral'
         when t703 then 'won' end as duel,
    case when "eventId" <> 10 then null when t1801 and t101 then 'goal'
         when t1801 then 'saved' when t1802 then 'wide' end as shot
  from fx_events),
counted as (
  select "matchId", "playerId", min(matchday) as matchday,
    {COUNTS}
  from classed group by 1, 2),
rated as (
  select *,
    ("accNormalPasses" + 2 * "accKeyPasses") / nullif("normalPasses" + 2 * "keyPasses", 0)
      as pass_ratio,
    ("duelsWon" + 0.5::double * "neutralDuels") / nullif("totalDuels", 0) as duel_ratio,
    ("effectiveFreeKicks" + "penaltiesScored") / nullif("totalFreeKicks", 0) as kick_ratio,
    ("targetAndGoal" + 0.5::double * "targetNotGoal") / nullif("totalShots", 0) as shot_ratio
  from counted),
days as (
  select distinct ("teamId" - 1) // 2 as m, matchday from fx_events
  where ("teamId" - 1) // 2 in (select m from fx_pairs)),
fx_appearances as (
  select d.matchday, d.m * 100000 + d.matchday as "matchId", "teamId",
    "Id" as "playerId", name, slot, date '2024-01-01' + 6 * d.matchday as match_date,
    case when slot <= 9 then 1.05::double when slot = 10 then (60 + matchday) / 90.0::double
         when slot = 11 then 15 / 90.0::double when slot = 12 then (15 - matchday) / 90.0::double
         else 0::double end as time_weight,
    slot <= 12 as played,
    slot in (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12) as in_chemistry
  from fx_players join days d on d.m = ("teamId" - 1) // 2),
fx_substitutions as (
  select a."matchId", a."teamId", i."playerId" as "playerIn", a."playerId" as "playerOut",
    cast(case a.slot when 10 then 60 else 75 end + a.matchday as int) as minute
  from fx_appearances a join fx_appearances i
    on i."matchId" = a."matchId" and i."teamId" = a."teamId" and i.slot = a.slot + 1
  where a.slot in (10, 11)),
fx_formation as (
  select a."matchId", a.matchday, a."teamId", a."playerId", a.name, a.slot,
    case when a.slot <= 10 then 'lineup' else 'bench' end as section,
    coalesce(c."numGoals", 0) as goals, coalesce(c."ownGoals", 0) as own_goals,
    case when c."foulLoss" >= 3 then '1' else '0' end as yellow,
    case when c."foulLoss" >= 5 then '1' else '0' end as red
  from fx_appearances a left join counted c
    on c."matchId" = a."matchId" and c."playerId" = a."playerId"),
score as (
  select "matchId", any_value(matchday) as matchday, min("teamId") as home, max("teamId") as away,
    sum(case when "teamId" % 2 = 1 then goals else own_goals end) as h,
    sum(case when "teamId" % 2 = 0 then goals else own_goals end) as a
  from fx_formation group by 1),
fx_matches as (
  select "matchId" as "wyId", 'Played' as status, 'Regular' as duration,
    cast(matchday + 1 as int) as gameweek, 'Ground ' || home as venue,
    date '2024-01-01' + 6 * matchday as match_date,
    th.name || ' - ' || ta.name || ', ' || cast(h as int) || ' - ' || cast(a as int) as label,
    case when h > a then home when a > h then away else 0 end as winner
  from score join fx_teams th on th."Id" = home join fx_teams ta on ta."Id" = away
  union all
  select 99999, 'Suspended', 'Regular', 6, 'Ground 0', date '2024-01-31',
    'Suspended fixture, 0 - 0', 0),
contrib as (
  select a."matchId", a."playerId", a."teamId", a.match_date, a.time_weight, a.played,
    a.in_chemistry, a.time_weight * ((coalesce(pass_ratio, 0) + coalesce(duel_ratio, 0)
      + coalesce(kick_ratio, 0) + coalesce(shot_ratio, 0)) / 4) as contribution,
    sum(coalesce("foulLoss", 0)) over w as fouls, sum(coalesce("ownGoals", 0)) over w as own_goals
  from fx_appearances a left join rated r
    on r."matchId" = a."matchId" and r."playerId" = a."playerId"
  window w as (partition by a."playerId" order by a.match_date, a."matchId"
               rows unbounded preceding)),
perf as (
  select *, contribution * pow(0.995, fouls) * pow(0.95, own_goals) as performance
  from contrib where played),
folded as (
  select *, row_number() over w as n,
    list_reduce(list_prepend(0.5::double, list(performance) over w), lambda r, p: (p + r) / 2)
      as rating
  from perf
  window w as (partition by "playerId" order by match_date, "matchId" rows unbounded preceding)),
history as (
  select *, lag(rating, 1, 0.5) over (partition by "playerId" order by n) as previous_rating
  from folded),
latest as (
  select "playerId", max_by(rating, n) as rating, max(n) as matches from history group by 1),
pairs as (
  select a."playerId" as player1, b."playerId" as player2, a."matchId", a.match_date,
    a."teamId" = b."teamId" as same_team,
    a.rating - a.previous_rating as move1, b.rating - b.previous_rating as move2
  from history a join history b on a."matchId" = b."matchId" and a."playerId" < b."playerId"
  where a.in_chemistry and b.in_chemistry),
deltas as (
  select player1, player2, "matchId", match_date, same_team,
    case when sign(move1) = sign(move2) and move1 <> 0 then 1 else -1 end
      * case when same_team then 1 else -1 end * abs((move1 + move2) / 2) as delta
  from pairs),
chem as (
  select player1, player2, 0.5 + sum(delta) as chemistry from deltas group by 1, 2),
totals as (
  select "playerId", cast(sum("foulLoss") as bigint) as fouls, cast(sum("numGoals") as bigint) as goals,
    cast(sum("ownGoals") as bigint) as own_goals, cast(sum("shotsOnTarget") as bigint) as on_target,
    cast(sum("totalShots") as bigint) as shots, cast(sum("normalPasses") as bigint) as normal,
    cast(sum("keyPasses") as bigint) as keyed, cast(sum("accNormalPasses") as bigint) as acc_normal,
    cast(sum("accKeyPasses") as bigint) as acc_key
  from counted group by 1),
profiled as (
  select "Id", coalesce(rating, 0.5) as rating, coalesce(matches, 0) as matches
  from fx_players left join latest on "playerId" = "Id"),
{CLUSTERS},
smooth as (
  select "Id", matches, prediction, rating as own_rating,
    case when matches < 5 then avg(rating) over (partition by prediction) else rating end as rating
  from profiled join fx_clusters using ("Id")),
asked as (
  select m * 10 + kind as request_seq, kind, m,
    case when kind = 1 and team = 1 and slot = 8 then 13 when kind = 2 and team = 1 and slot = 1 then 0
         when slot = 0 and (team = 1 and kind in (4, 6) or team = 2 and kind in (5, 6)) then 12
         else slot end as who,
    kind in (3, 7) and team = 1 and slot = kind % 5 + case kind when 7 then 3 else 0 end as unknown,
    team, cast(slot + 1 as int) as slot
  from (select m from fx_pairs where players = 28),
    (select unnest(range(8)) as kind), (select unnest([1, 2]) as team),
    (select unnest(range(11)) as slot)),
places as (
  select request_seq, kind, m, team, s.slot,
    case when not unknown then p.name when kind = 3 then 'No Such Player' end as name,
    case when not unknown then p."Id" end as "Id", case when not unknown then p.role end as role,
    case when not unknown then smooth.rating end as rating
  from asked s join fx_players p on p."teamId" = 2 * m + team and p.slot = s.who
    left join smooth on smooth."Id" = p."Id"),
roles as (
  select request_seq, team, count(*) filter (where role = 'GK') as "GK",
    count(*) filter (where role = 'DF') as "DF", count(*) filter (where role = 'MD') as "MD",
    count(*) filter (where role = 'FW') as "FW"
  from places group by 1, 2),
judged as (
  select p.request_seq, any_value(kind) as kind, any_value(m) as m,
    count(distinct p."Id") as profiles, bool_or(p."Id" is null) as any_missing,
    bool_or(coalesce(rating < 0.2, false)) as retired,
    bool_and("GK" = 1 and "DF" >= 3 and "MD" >= 2 and "FW" >= 1) filter (where team = 1) as valid1,
    bool_and("GK" = 1 and "DF" >= 3 and "MD" >= 2 and "FW" >= 1) filter (where team = 2) as valid2,
    min_by(p.name, slot * 10 + team) filter (where p."Id" is null) as missing
  from places p join roles using (request_seq, team) group by 1),
eligible as (
  select request_seq from judged where profiles = 22 and not any_missing and not retired),
mates as (
  select a.request_seq, a.team, a.slot, a."Id", a.rating,
    avg(coalesce(chemistry, 0.5)) as mean_chemistry
  from places a join eligible using (request_seq)
    join places b on b.request_seq = a.request_seq and b.team = a.team and b.slot <> a.slot
    left join chem on player1 = least(a."Id", b."Id") and player2 = greatest(a."Id", b."Id")
  group by 1, 2, 3, 4, 5),
strengths as (
  select request_seq,
    sum(rating * mean_chemistry) filter (where team = 1) / 11 as strength1,
    sum(rating * mean_chemistry) filter (where team = 2) / 11 as strength2
  from mates group by 1),
verdicts as (
  select *,
    case when request_seq not in (select request_seq from eligible) then 'Player Does Not Exist'
         when not valid2 then 'Team 2 is Invalid' when not valid1 then 'Team 1 is Invalid' end as msg,
    case when any_missing
           then coalesce('Player : ' || missing || ' does not exist', 'Player Does Not Exist')
         when not valid1 then 'Team 1 is Invalid' when not valid2 then 'Team 2 is Invalid'
         when request_seq not in (select request_seq from eligible) then 'Player Does Not Exist'
    end as detail
  from judged),
predictions as (
  select v.request_seq, kind, 'Side 1 of ' || m as name1, 'Side 2 of ' || m as name2,
    case when msg is null then 50 + 50 * (strength1 - strength2) end as chance1,
    case when msg is null then 50 - 50 * (strength1 - strength2) end as chance2, msg, detail
  from verdicts v left join strengths using (request_seq)),
answers as (
  select "Id" + 1000000000000000 as request_seq, p.name, "birthArea",
    strftime("birthDate", '%Y-%m-%d') as "birthDate", foot, role, height, "passportArea", weight,
    coalesce(fouls, 0) as fouls, coalesce(goals, 0) as goals, coalesce(own_goals, 0) as own_goals,
    cast(coalesce(round(100 * ((acc_normal + 2 * acc_key) / nullif(normal + 2 * keyed, 0))), 0) as int)
      as percent_pass_accuracy,
    cast(coalesce(round(100 * (on_target / nullif(shots, 0))), 0) as int) as percent_shots_on_target,
    cast(null as varchar) as msg
  from fx_players p left join totals t on t."playerId" = p."Id"
  union all
  select 1999999999999999, null, null, null, null, null, null, null, null, null, null, null, null, null, 'Player Not Found'),
lists as (
  select "matchId",
    list({'name': f.name, 'team': t.name, 'number_of_goals': goals}
      order by f."teamId", section, slot) filter (where goals > 0) as goals,
    list({'name': f.name, 'team': t.name, 'number_of_goals': own_goals}
      order by f."teamId", section, slot) filter (where own_goals > 0) as own_goals,
    list(f.name order by f."teamId", section, slot) filter (where yellow <> '0') as yellow_cards,
    list(f.name order by f."teamId", section, slot) filter (where red <> '0') as red_cards
  from fx_formation f join fx_teams t on t."Id" = f."teamId" group by 1),
reports as (
  select m."wyId" + 2000000000000000 as request_seq,
    case when status = 'Played' then strftime(match_date, '%Y-%m-%d') end as date,
    case when status = 'Played' then duration end as duration,
    case when status = 'Played' then label end as label,
    case when status <> 'Played' then null when winner = 0 then 'None' else t.name end as winner,
    case when status = 'Played' then venue end as venue,
    case when status = 'Played' then gameweek end as gameweek,
    case when status = 'Played' then cast(to_json(coalesce(goals, [])) as varchar) end as goals,
    case when status = 'Played' then cast(to_json(coalesce(own_goals, [])) as varchar) end as own_goals,
    case when status = 'Played' then cast(to_json(coalesce(yellow_cards, [])) as varchar) end
      as yellow_cards,
    case when status = 'Played' then cast(to_json(coalesce(red_cards, [])) as varchar) end as red_cards,
    case when status <> 'Played' then 'Match was ' || status end as msg
  from fx_matches m left join fx_teams t on t."Id" = m.winner left join lists l on l."matchId" = m."wyId"
  union all
  select 2999999999999999, null, null, null, null, null, null, null, null, null, null, 'No Matches found'),
responses as (
  select request_seq, 1 as req_type, case when msg is not null then '{"msg":"' || msg || '"}' end as body,
    case when msg is null then name1 end as name1, case when msg is null then name2 end as name2,
    case when msg is null then round(chance1 + 1e-10, 6) end as chance1,
    case when msg is null then round(chance2 + 1e-10, 6) end as chance2
  from predictions
  union all
  select request_seq, 2, case when msg is not null then '{"msg":"' || msg || '"}' else
    cast(to_json({'name': name, 'birthArea': "birthArea", 'birthDate': "birthDate", 'foot': foot,
      'role': role, 'height': height, 'passportArea': "passportArea", 'weight': weight,
      'fouls': fouls, 'goals': goals, 'own_goals': own_goals,
      'percent_pass_accuracy': percent_pass_accuracy,
      'percent_shots_on_target': percent_shots_on_target}) as varchar) end, null, null, null, null
  from answers
  union all
  select request_seq, 3, case when msg is not null then '{"msg":"' || msg || '"}' else
    '{"date":"' || date || '","duration":"' || duration || '","label":"' || label || '","winner":"'
      || winner || '","venue":"' || venue || '","gameweek":' || gameweek || ',"goals":' || goals
      || ',"own_goals":' || own_goals || ',"yellow_cards":' || yellow_cards || ',"red_cards":'
      || red_cards || '}' end, null, null, null, null
  from reports
  union all
  select 3000000000000000, 9, '{"msg":"Invalid request"}', null, null, null, null),
sent as (
  select p.request_seq, 1 as req_type, name1 as asked, f.name as player1
  from predictions p join places f on f.request_seq = p.request_seq and f.team = 1 and f.slot = 1
  union all select "Id" + 1000000000000000, 2, name, null from fx_players
  union all select 1999999999999999, 2, 'No Such Player', null
  union all select "wyId" + 2000000000000000, 3, label, null from fx_matches
  union all select 2999999999999999, 3, 'No Such Match', null
  union all select 3000000000000000, 9, null, null),
feed as (
  select match_date, "matchId", true as is_event, event_id, cast(null as varchar) as label,
    '{"eventId":' || "eventId" || ',"subEventId":"' || "subEventId" || '","playerId":' || "playerId"
      || ',"matchId":' || "matchId" || ',"tags":[' || array_to_string(list_transform(list_filter([
        case when t701 then 701 when t702 then 702 when t703 then 703 when t1801 then 1801
             when t1802 then 1802 end, case when t302 then 302 when t101 then 101 end,
        case when t102 then 102 end], lambda t: t is not null),
        lambda t: '{"id":' || t || '}'), ',') || ']}' as event
  from fx_events join fx_matches on "wyId" = "matchId"
  union all
  select match_date, "wyId", false, null, label, null from fx_matches)
""".replace("{COUNTS}", COUNTS).replace("{CLUSTERS}", CLUSTERS)

_COUNTERS = """"normalPasses", "keyPasses", "accNormalPasses", "accKeyPasses", "duelsWon",
  "neutralDuels", "totalDuels", "effectiveFreeKicks", "penaltiesScored", "totalFreeKicks",
  "targetAndGoal", "targetNotGoal", "totalShots", "shotsOnTarget", "numGoals", "foulLoss",
  "ownGoals\""""
_ZERO_COUNTERS = ", ".join(
    f"coalesce({c.strip()}, 0) as {c.strip()}" for c in _COUNTERS.split(","))
_RATIOS = """round(coalesce(pass_ratio, 0) + 1e-10, 6) as "passAccuracy",
  round(coalesce(duel_ratio, 0) + 1e-10, 6) as "duelEffectiveness",
  round(coalesce(kick_ratio, 0) + 1e-10, 6) as "freeKick",
  round(coalesce(shot_ratio, 0) + 1e-10, 6) as "shotsEffectiveness\""""
_METRICS = f'select "matchId", "playerId", {_COUNTERS}, {_RATIOS} from rated'
_HISTORY = """select "playerId", "matchId", "teamId", round(contribution + 1e-10, 6) as contribution,
  round(performance + 1e-10, 6) as performance, round(previous_rating + 1e-10, 6) as previous_rating,
  round(rating + 1e-10, 6) as rating, n as "numMatches" from history"""
_CHEMISTRY = "select player1, player2, round(chemistry + 1e-10, 6) as chemistry from chem"
_PLAYERS = 'select "Id", name, role, height, weight from fx_players'
_MATCHES = """select "wyId", status, match_date, label, duration, winner, venue, gameweek
  from fx_matches"""


def _ratio(name: str, column: str) -> str:
    return f'select "matchId", "playerId", round({column} + 1e-10, 6) as "{name}" from rated'


def _pairs(same_team: str) -> str:
    return f"""select player1, player2, "matchId", round(move1 + 1e-10, 6) as move1,
      round(move2 + 1e-10, 6) as move2 from pairs where {same_team}"""


BODIES = {
    "scan_players": """select "Id", name, role, height, weight, 0 as "numFouls", 0 as "numGoals",
      0 as "numOwnGoals", 0 as "passAcc", 0 as "shotsOnTarget", 0 as "normalPasses",
      0 as "keyPasses", 0 as "accNormalPasses", 0 as "accKeyPasses", 0 as "numMatches",
      0.5::double as rating, 0.5::double as "previousRating" from fx_players""",
    "scan_teams": 'select "Id", name from fx_teams',
    "players_from_csv": """select "Id", name, role, height, weight, "birthArea", foot,
      "passportArea", "birthDate" from fx_players""",
    "teams_from_csv": 'select "Id", name from fx_teams',
    "player_ids": 'select "Id" from fx_players',
    "preview_players": _PLAYERS + ' order by "Id" limit 5',
    "events_typed": """select "matchId", "playerId", "eventId", "subEventId", t101 as t_goal,
      t102 as t_own_goal, t302 as t_key, t701 as t_lost, t702 as t_neutral, t703 as t_won,
      t1801 as t_acc, t1802 as t_inacc from fx_events""",
    "events_with_match": """select event_id, "matchId", "playerId", "eventId", status, match_date,
      label, gameweek, venue from fx_events join fx_matches on "wyId" = "matchId\"""",
    "feed_lines": """select event, label,
      row_number() over (order by match_date, "matchId", is_event, event_id) - 1 as line_no from feed""",
    "pass_counters": """select "matchId", "playerId", "normalPasses", "keyPasses",
      "accNormalPasses", "accKeyPasses" from counted""",
    "duel_counters": """select "matchId", "playerId", "duelsWon", "neutralDuels", "totalDuels"
      from counted""",
    "freekick_counters": """select "matchId", "playerId", "effectiveFreeKicks", "penaltiesScored",
      "totalFreeKicks" from counted""",
    "shot_counters": """select "matchId", "playerId", "targetAndGoal", "targetNotGoal",
      "totalShots", "shotsOnTarget" from counted""",
    "goals_fouls_owngoals": """select "matchId", "playerId", "numGoals", "foulLoss", "ownGoals"
      from counted""",
    "pass_accuracy": _ratio("passAccuracy", "pass_ratio"),
    "duel_effectiveness": _ratio("duelEffectiveness", "duel_ratio"),
    "freekick_effectiveness": _ratio("freeKick", "kick_ratio"),
    "shots_effectiveness": _ratio("shotsEffectiveness", "shot_ratio"),
    "player_match_metrics": _METRICS,
    "match_metric_rows": f"""select a."matchId", a."playerId", a."teamId", {_ZERO_COUNTERS},
      {_RATIOS}, round(c.contribution + 1e-10, 6) as contribution
      from fx_appearances a left join rated r
        on r."matchId" = a."matchId" and r."playerId" = a."playerId"
      join contrib c on c."matchId" = a."matchId" and c."playerId" = a."playerId\"""",
    "career_totals": """select t."playerId", fouls as "numFouls", goals as "numGoals",
      own_goals as "numOwnGoals", on_target as "shotsOnTarget", shots as "totalShots",
      normal as "normalPasses", keyed as "keyPasses", acc_normal as "accNormalPasses",
      acc_key as "accKeyPasses",
      round(coalesce((acc_normal + 2 * acc_key) / nullif(normal + 2 * keyed, 0), 0) + 1e-10, 6) as "passAcc",
      coalesce(matches, 0) as "numMatches"
      from totals t left join latest l on l."playerId" = t."playerId\"""",
    "match_dates": 'select "wyId", status, match_date from fx_matches',
    "formation_flat": """select "matchId", "teamId", "playerId", section,
      cast(goals as varchar) as goals, cast(own_goals as varchar) as "ownGoals",
      yellow as "yellowCards", red as "redCards" from fx_formation""",
    "substitutions_flat": 'select "matchId", "teamId", "playerIn", "playerOut", minute from fx_substitutions',
    "closing_squads": """select "matchId", "teamId", "playerId", slot <= 9 as stayed_on
      from fx_appearances where slot <= 9 or slot = 13""",
    "appearance_weights": """select "matchId", "teamId", "playerId", match_date,
      round(time_weight + 1e-10, 6) as time_weight, played, in_chemistry from fx_appearances""",
    "player_contribution": """select "matchId", "playerId", "teamId", played,
      round(contribution + 1e-10, 6) as contribution from contrib""",
    "player_performance": """select "matchId", "playerId", round(performance + 1e-10, 6) as performance,
      cast(fouls as bigint) as "careerFouls", cast(own_goals as bigint) as "careerOwnGoals"
      from perf""",
    "rating_history": _HISTORY,
    "rating_latest": """select "playerId", round(rating + 1e-10, 6) as rating, matches as "numMatches"
      from latest""",
    "career_running_totals": """select "matchId", "playerId",
      cast(fouls as bigint) as "careerFouls", cast(own_goals as bigint) as "careerOwnGoals",
      cast(count(*) filter (where played) over (partition by "playerId"
        order by match_date, "matchId" rows unbounded preceding) as bigint) as "numMatches"
      from contrib""",
    "same_team_pairs": _pairs("same_team"),
    "opposite_team_pairs": _pairs("not same_team"),
    "chemistry_deltas": """select player1, player2, "matchId", same_team, round(delta + 1e-10, 6) as delta
      from deltas""",
    "chemistry_latest": _CHEMISTRY,
    "chemistry_as_of": """select player1, player2, "matchId", round(0.5 + sum(delta) over (
      partition by player1, player2 order by match_date, "matchId" rows unbounded preceding) + 1e-10, 6)
      as chemistry from deltas""",
    "chemistry_lookup": """select a.request_seq, a.team, a.slot as slot1, b.slot as slot2,
      round(coalesce(chemistry, 0.5) + 1e-10, 6) as chemistry
      from places a join places b on b.request_seq = a.request_seq and b.team = a.team
        and b.slot > a.slot
      left join chem on player1 = least(a."Id", b."Id") and player2 = greatest(a."Id", b."Id")""",
    "squad_roles": 'select request_seq, team, "GK", "DF", "MD", "FW" from roles',
    "squad_validity": """select request_seq, valid1, valid2, profiles, any_missing, retired,
      request_seq in (select request_seq from eligible) as eligible from judged""",
    "player_strength": """select request_seq, team, slot, round(mean_chemistry + 1e-10, 6) as mean_chemistry,
      round(rating * mean_chemistry + 1e-10, 6) as strength from mates""",
    "team_strength": """select request_seq, round(strength1 + 1e-10, 6) as strength1,
      round(strength2 + 1e-10, 6) as strength2 from strengths""",
    "win_chances": """select request_seq, round(50 + 50 * (strength1 - strength2) + 1e-10, 6) as chance1,
      round(50 - 50 * (strength1 - strength2) + 1e-10, 6) as chance2 from strengths""",
    "predict_responses": """select request_seq, name1, name2, round(chance1 + 1e-10, 6) as chance1,
      round(chance2 + 1e-10, 6) as chance2, msg, detail from predictions""",
    "player_profile": "select * from answers",
    "cluster_smoothing": """select prediction, count(*) as players,
      count(*) filter (where matches < 5) as rookies, round(avg(own_rating) + 1e-10, 6) as mean_rating,
      round(avg(rating) + 1e-10, 6) as mean_smoothed from smooth group by 1""",
    "predict_smoothed": """select "Id", matches as "numMatches", prediction,
      round(own_rating + 1e-10, 6) as rating, round(rating + 1e-10, 6) as smoothed_rating from smooth""",
    "chemistry_dense": """select a."teamId", a."Id" as player1, b."Id" as player2,
      round(coalesce(chemistry, 0.5) + 1e-10, 6) as chemistry
      from fx_players a join fx_players b on a."teamId" = b."teamId" and a."Id" < b."Id"
      left join chem on player1 = a."Id" and player2 = b."Id\"""",
    "requests_numbered": """select row_number() over (order by request_seq) - 1 as request_seq,
      req_type, asked, player1 from sent""",
    "responses_written": """select row_number() over (order by request_seq) - 1 as line_no,
      body, name1, name2, chance1, chance2 from responses""",
    "request_dispatch": "select * from responses",
    "match_report": "select * from reports",
    "match_goals": """select f."matchId", f.name, t.name as team, goals, own_goals as "ownGoals"
      from fx_formation f join fx_teams t on t."Id" = f."teamId"
      where goals > 0 or own_goals > 0""",
    "match_cards": """select f."matchId", f.name, t.name as team, yellow as "yellowCards",
      red as "redCards" from fx_formation f join fx_teams t on t."Id" = f."teamId"
      where yellow <> '0' or red <> '0'""",
    "append_matches": _MATCHES,
    "stream_live_metrics": _METRICS,
    "stream_ratings": _HISTORY,
    "stream_chemistry": _CHEMISTRY,
}


def oracle_sql() -> dict[str, str]:
    from catalog.stream_oracle import STREAMS, VIEWS as STREAM_VIEWS

    plain = {name: f"with recursive {VIEWS}\n{body}" for name, body in BODIES.items()}
    return plain | {name: f"with recursive {VIEWS},\n{STREAM_VIEWS}\n{body}" for name, body in STREAMS.items()}
