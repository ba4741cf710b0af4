"""Codes of the match-event feed."""

# Fixed values of the feed: event classes.
DUEL = 1
FOUL = 2
FREE_KICK = 3
PASS = 8
SHOT = 10

# Fixed value of the feed: sub-event of a free kick.
PENALTY = 35

# Fixed values of the feed: tags.
GOAL = 101
OWN_GOAL = 102
KEY_PASS = 302
DUEL_LOST = 701
DUEL_NEUTRAL = 702
DUEL_WON = 703
ACCURATE = 1801
INACCURATE = 1802

# Fixed values of the model.
INITIAL_RATING = 0.5
INITIAL_CHEMISTRY = 0.5
FULL_MATCH_WEIGHT = 1.05
MATCH_MINUTES = 90
FOUL_FACTOR = 0.995
OWN_GOAL_FACTOR = 0.95
RETIRED_BELOW = 0.2
ROOKIE_BELOW = 5
SQUAD_SIZE = 11
CLUSTERS = 5
