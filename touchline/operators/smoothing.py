"""Ratings of players with few matches, smoothed by clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions import codes
from touchline.operators.clustering import clusters as fitted_clusters

# Fixed values of the model; the id is left out because it says nothing about play.
FEATURES = [
    "height", "weight", "numFouls", "numGoals", "numOwnGoals", "passAcc", "shotsOnTarget",
    "normalPasses", "keyPasses", "accNormalPasses", "accKeyPasses", "rating", "numMatches",
]


def cluster_ratings(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("prediction").agg(F.avg("rating").alias("cluster_rating"))


def smooth_ratings(profiles: DataFrame, features: list[str] = FEATURES,
                   clusters: DataFrame | None = None) -> DataFrame:
    """Adds ``prediction`` and ``smoothed_rating``: the cluster's mean rating for players with
    fewer than five matches, their own rating for everyone else. ``clusters`` (Id, prediction)
    takes the place of the fit."""
    if clusters is None:
        clusters = fitted_clusters(profiles, features, codes.CLUSTERS)
    clustered = profiles.select("Id", "rating").join(clusters, "Id")
    # At most one row per cluster, so the broadcast is bounded by the number of clusters.
    means = F.broadcast(cluster_ratings(clustered))
    places = clustered.select("Id", "prediction").join(means, "prediction")
    rookie = F.col("numMatches") < codes.ROOKIE_BELOW
    smoothed = F.when(rookie, F.coalesce("cluster_rating", "rating")).otherwise(F.col("rating"))
    return profiles.join(places, "Id", "left").withColumn("smoothed_rating", smoothed)
