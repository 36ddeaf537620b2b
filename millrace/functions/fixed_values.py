"""Fixed values of the pitch data model."""

# Club code, league, division.
TEAMS = [
    ("ATL", "NL", "East"),
    ("MIA", "NL", "East"),
    ("NYM", "NL", "East"),
    ("PHI", "NL", "East"),
    ("WSH", "NL", "East"),
    ("CHC", "NL", "Central"),
    ("CIN", "NL", "Central"),
    ("MIL", "NL", "Central"),
    ("PIT", "NL", "Central"),
    ("STL", "NL", "Central"),
    ("ARI", "NL", "West"),
    ("COL", "NL", "West"),
    ("LAD", "NL", "West"),
    ("SD", "NL", "West"),
    ("SF", "NL", "West"),
    ("BAL", "AL", "East"),
    ("BOS", "AL", "East"),
    ("NYY", "AL", "East"),
    ("TB", "AL", "East"),
    ("TOR", "AL", "East"),
    ("CWS", "AL", "Central"),
    ("CLE", "AL", "Central"),
    ("DET", "AL", "Central"),
    ("KC", "AL", "Central"),
    ("MIN", "AL", "Central"),
    ("ATH", "AL", "West"),
    ("HOU", "AL", "West"),
    ("LAA", "AL", "West"),
    ("SEA", "AL", "West"),
    ("TEX", "AL", "West"),
]

# Pitch code, label, family.
PITCH_TYPES = [
    ("FF", "Four-Seam Fastball", "fastball"),
    ("SI", "Sinker", "fastball"),
    ("FC", "Cutter", "fastball"),
    ("FT", "Two-Seam Fastball", "fastball"),
    ("FA", "Fastball", "fastball"),
    ("SL", "Slider", "breaking"),
    ("ST", "Sweeper", "breaking"),
    ("SV", "Slurve", "breaking"),
    ("CU", "Curveball", "breaking"),
    ("KC", "Knuckle Curve", "breaking"),
    ("CS", "Slow Curve", "breaking"),
    ("CH", "Changeup", "offspeed"),
    ("FS", "Split-Finger", "offspeed"),
    ("FO", "Forkball", "offspeed"),
    ("SC", "Screwball", "offspeed"),
    ("EP", "Eephus", "offspeed"),
    ("KN", "Knuckleball", "offspeed"),
    ("PO", "Pitchout", "other"),
]

# Which outcomes count as an out (pattern) and as a hit (list).
OUT_PATTERN = "out|strikeout|double_play|sac_"
HITS = ["single", "double", "triple", "home_run"]

# Columns a plate appearance keeps, where the fact has them.
PLATE_APPEARANCE_COLUMNS = [
    "game_pk",
    "at_bat_number",
    "events",
    "des",
    "description",
    "batter",
    "pitcher",
    "stand",
    "p_throws",
    "home_team",
    "away_team",
    "bb_type",
    "hit_location",
    "launch_speed",
    "launch_angle",
    "hit_distance_sc",
    "estimated_ba_using_speedangle",
    "estimated_woba_using_speedangle",
    "woba_value",
    "woba_denom",
    "babip_value",
    "iso_value",
    "launch_speed_angle",
    "on_1b",
    "on_2b",
    "on_3b",
    "outs_when_up",
    "inning",
    "inning_topbot",
    "home_score",
    "away_score",
    "bat_score",
    "fld_score",
    "post_home_score",
    "post_away_score",
    "post_bat_score",
    "post_fld_score",
    "delta_home_win_exp",
    "delta_run_exp",
    "if_fielding_alignment",
    "of_fielding_alignment",
    "game_year",
    "game_month",
    "game_date",
    "pitch_number",
    "balls",
    "strikes",
    "pfx_x",
    "pfx_z",
    "plate_x",
    "plate_z",
    "effective_speed",
    "release_speed",
    "sz_top",
    "sz_bot",
    "vx0",
    "vy0",
    "vz0",
    "ax",
    "ay",
    "az",
    "hc_x",
    "hc_y",
    "spin_axis",
    "arm_angle",
    "attack_angle",
    "swing_length",
    "bat_speed",
    "delta_pitcher_run_exp",
    "home_win_exp",
    "bat_win_exp",
    "n_thruorder_pitcher",
    "release_spin_rate",
    "release_extension",
    "estimated_slg_using_speedangle",
    "pitch_name",
    "pitch_type",
]

# What an event gets for a missing field.
NO_ID = "0"
NO_TYPE = "UnknownEvent"
NO_ACTOR = "unknown"
NO_REPO = "unknown/unknown"
NO_TIME = "1970-01-01T00:00:00Z"
NO_GAME = "0"
NO_PITCH_TYPE = "UN"
NO_DATE = "1970-01-01"
