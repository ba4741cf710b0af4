"""SQL of the registered streams: which part a row comes in and what is late is computed from the times,
no stream is imitated."""

from __future__ import annotations

from catalog.oracle import _COUNTERS, _MATCHES, _METRICS, BODIES, COUNTS

VIEWS = """
st_parts as (
  select event_id, ts, "playerId", "playerId" // 28 * 100000 + matchday as "matchId",
    least(cast(least(greatest(floor((floor(epoch(ts)) - epoch(timestamp '2024-01-01'))
      / 2678400 * 4), 0), 3) as int) + case when event_id % 11 = 5 then 1 else 0 end, 3) as part
  from fx_raw),
st_seen as (
  select part, max(max(ts)) over (order by part rows between unbounded preceding and 1 preceding)
    as seen
  from st_parts group by part),
st_gate as (
  select *, coalesce(ts < seen - interval 2 days, false) as late
  from st_parts join st_seen using (part))"""

STREAMS = {
    "stream_events_with_match": """
      select e.event_id, e."matchId", e."playerId", e."eventId", status, match_date, label, gameweek,
        venue
      from fx_events e left join fx_matches m on m."wyId" = e."matchId" and m."wyId" % 10 <> 3""",
    "stream_late_events": """
      select event_id, "matchId", "playerId", cast(part as bigint) as batch_id
      from st_gate where late""",
    "stream_match_sessions": f"""
      select c."matchId", c."playerId", min(c.ts) as first_ts,
        max(c.ts) + interval 6 days as closed_ts, {COUNTS}
      from classed c join st_gate g on g.event_id = c.event_id and not late
      group by 1, 2""",
    "stream_whole_sessions": f"""
      select "matchId", "playerId", first_ts, last_ts + interval 6 days as closed_ts, {_COUNTERS}
      from counted join (select "matchId", "playerId", min(ts) as first_ts, max(ts) as last_ts
                         from fx_events group by 1, 2) using ("matchId", "playerId")""",
    "stream_reconciled": f"""
      select c."matchId", c."playerId", {{zeros}},
        count(*) filter (where acted and not late) as "actionsCounted",
        count(*) filter (where acted and late) as "actionsLate",
        count(*) filter (where acted) as "actionsStored", true as agrees
      from (select *, pass is not null or duel is not null or "eventId" in (2, 3)
              or shot is not null as acted from classed) c
        join st_gate g on g.event_id = c.event_id
      group by 1, 2""".replace("{zeros}", ", ".join(
        f"cast(0 as bigint) as {name.strip()}" for name in _COUNTERS.split(","))),
    "stream_match_intake": f"""
      select * from ({_MATCHES})
      union all select * replace (label || ' (replay)' as label) from ({_MATCHES})
      where "wyId" % 3 = 0""",
    "stream_closed_matches": """
      select "wyId" as "matchId", coalesce(lead(cast(match_date as timestamp)) over w,
          cast(match_date as timestamp) + interval 100 days) as closed_ts,
        case when lead("wyId") over w is null then 'timeout' else 'header' end as reason
      from fx_matches
      window w as (partition by "wyId" // 100000 order by match_date, "wyId")""",
    "stream_finished_matches": """
      select c."matchId", c."playerId", "teamId", match_date, played,
        round(contribution + 1e-10, 6) as contribution,
        coalesce("foulLoss", 0) as "foulLoss", coalesce("ownGoals", 0) as "ownGoals"
      from contrib c
        left join counted r on r."matchId" = c."matchId" and r."playerId" = c."playerId"
      where match_date is not null""",
    "stream_lines": BODIES["events_typed"],
    "stream_merged_counts": _METRICS,
    "stream_requests": BODIES["responses_written"],
}
