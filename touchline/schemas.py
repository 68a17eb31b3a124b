"""Explicit schemas for competitions, matches and match events.

Every source is read with one of these instead of JSON inference, so a field
missing from one document (no ``block`` or ``foul_won`` anywhere in a match)
is a null column rather than an analysis error, and every statistic sees one
stable nested shape however the documents drift.
"""

from __future__ import annotations

from pyspark.sql import types as T


def ref_type() -> T.StructType:
    """A name/id pair: ``{"id": 904, "name": "Bayer Leverkusen"}``."""
    return T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]
    )


REF = ref_type()
POINT = T.ArrayType(T.DoubleType())

COMPETITION_SCHEMA = T.StructType(
    [
        T.StructField("competition_id", T.LongType()),
        T.StructField("season_id", T.LongType()),
        T.StructField("competition_name", T.StringType()),
        T.StructField("country_name", T.StringType()),
        T.StructField("season_name", T.StringType()),
    ]
)

MATCH_SCHEMA = T.StructType(
    [
        T.StructField("match_id", T.LongType()),
        T.StructField(
            "competition",
            T.StructType(
                [
                    T.StructField("competition_id", T.LongType()),
                    T.StructField("competition_name", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "season",
            T.StructType(
                [
                    T.StructField("season_id", T.LongType()),
                    T.StructField("season_name", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "home_team",
            T.StructType(
                [
                    T.StructField("home_team_id", T.LongType()),
                    T.StructField("home_team_name", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "away_team",
            T.StructType(
                [
                    T.StructField("away_team_id", T.LongType()),
                    T.StructField("away_team_name", T.StringType()),
                ]
            ),
        ),
        T.StructField("home_score", T.LongType()),
        T.StructField("away_score", T.LongType()),
    ]
)

LINEUP_ENTRY = T.StructType(
    [
        T.StructField("player", REF),
        T.StructField("position", REF),
        T.StructField("jersey_number", T.LongType()),
    ]
)

# The event document as the statistics read it. ``match_id`` is not part of a
# match document: the sources add it from the document's file name.
EVENT_FIELDS = [
    T.StructField("id", T.StringType()),
    T.StructField("index", T.LongType()),
    T.StructField("type", REF),
    T.StructField("team", REF),
    T.StructField("player", REF),
    T.StructField("position", REF),
    T.StructField("minute", T.LongType()),
    T.StructField("second", T.LongType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("location", POINT),
    T.StructField(
        "tactics",
        T.StructType(
            [
                T.StructField("formation", T.LongType()),
                T.StructField("lineup", T.ArrayType(LINEUP_ENTRY)),
            ]
        ),
    ),
    T.StructField(
        "substitution",
        T.StructType(
            [T.StructField("replacement", REF), T.StructField("outcome", REF)]
        ),
    ),
    T.StructField(
        "pass",
        T.StructType(
            [
                T.StructField("end_location", POINT),
                T.StructField("outcome", REF),
                T.StructField("body_part", REF),
                T.StructField("type", REF),
            ]
        ),
    ),
    T.StructField(
        "shot",
        T.StructType(
            [T.StructField("end_location", POINT), T.StructField("outcome", REF)]
        ),
    ),
    T.StructField("dribble", T.StructType([T.StructField("outcome", REF)])),
    T.StructField(
        "ball_recovery",
        T.StructType([T.StructField("recovery_failure", T.BooleanType())]),
    ),
    T.StructField(
        "block",
        T.StructType(
            [
                T.StructField("deflection", T.BooleanType()),
                T.StructField("offensive", T.BooleanType()),
                T.StructField("save_block", T.BooleanType()),
                T.StructField("counterpress", T.BooleanType()),
            ]
        ),
    ),
    T.StructField(
        "foul_committed",
        T.StructType(
            [
                T.StructField("type", REF),
                T.StructField("counterpress", T.BooleanType()),
                T.StructField("offensive", T.BooleanType()),
                T.StructField("advantage", T.BooleanType()),
                T.StructField("penalty", T.BooleanType()),
                T.StructField("card", REF),
            ]
        ),
    ),
    T.StructField(
        "foul_won",
        T.StructType(
            [
                T.StructField("defensive", T.BooleanType()),
                T.StructField("advantage", T.BooleanType()),
                T.StructField("penalty", T.BooleanType()),
            ]
        ),
    ),
]

# Schema of one match document (what the JSON reader is given).
EVENT_DOCUMENT_SCHEMA = T.StructType(EVENT_FIELDS)

# Schema of landed events: the document fields plus the match they came from.
EVENT_SCHEMA = T.StructType(EVENT_FIELDS + [T.StructField("match_id", T.LongType())])
