"""Season selection (S5, S6) and schema alignment (H3).

The events of a season are the events of the season's matches. Instead of
collecting match ids to the driver and loading one document per match, the
match list stays a DataFrame and selects events with a left-semi join. The
match list is small (hundreds of rows per season), so the planner broadcasts
it when its size is under the broadcast bound and keeps a shuffle join
otherwise.

On landed data an index says in which partition a match lies, whatever season its list
gives by now. It joins the list first, so the join with the events has the partitions as
keys, too, and Spark prunes the scan to them when it runs (dynamic partition pruning).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEASON = ["competition_id", "season_id"]
#: Stands for the partition of events whose season isn't known.
UNLISTED = -1


def season_match_ids(matches: DataFrame, competition_id: int, season_id: int) -> DataFrame:
    """The ids of a season's matches, as a one-column DataFrame."""
    return matches.filter(
        (F.col("competition.competition_id") == F.lit(competition_id))
        & (F.col("season.season_id") == F.lit(season_id))
    ).select("match_id")


def match_partitions(events: DataFrame) -> DataFrame:
    """The index of landed events: one row for each match and partition, read from ids alone."""
    return events.select("match_id", *SEASON).distinct()


def season_events(
    events: DataFrame, matches: DataFrame, competition_id: int, season_id: int, index: DataFrame | None = None
) -> DataFrame:
    """Events of the matches that the list gives for one competition season.

    The match list alone decides, so landed events and events straight from
    documents give the same rows: also events that were landed before their match was
    listed, or under another season. With the ``index`` of landed events
    (``match_partitions``) only partitions that hold one of the matches are read; without
    it the join reads them all.
    """
    ids = season_match_ids(matches, competition_id, season_id)
    if index is None:
        return events.join(ids, on="match_id", how="left_semi")
    place = lambda of, c: F.coalesce(of[c], F.lit(UNLISTED))
    places = index.join(ids, on="match_id", how="left_semi").select(
        F.col("match_id").alias("place_match"), *[place(index, c).alias(f"place_{c}") for c in SEASON]
    )
    here = (events["match_id"] == F.col("place_match")) & (place(events, SEASON[0]) == F.col(f"place_{SEASON[0]}")) & (place(events, SEASON[1]) == F.col(f"place_{SEASON[1]}"))
    return events.join(places, here, "left_semi")


def align_union(frames: list[DataFrame]) -> DataFrame:
    """H3: union frames whose schemas drifted; missing fields become null.

    Neighbours are united pairwise, so the plan is as deep as the logarithm
    of the number of frames.
    """
    while len(frames) > 1:
        frames = [
            frames[i].unionByName(frames[i + 1], allowMissingColumns=True)
            if i + 1 < len(frames)
            else frames[i]
            for i in range(0, len(frames), 2)
        ]
    return frames[0]
