"""From ratings to filtered, split, indexed interactions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.operators.filters import to_implicit
from affinis.operators.ids import build_mappings, interaction_matrix
from affinis.operators.kcore import kcore_filter
from affinis.operators.popularity import popularity
from affinis.operators.split import TEST, TRAIN, VAL, time_split
from affinis.session import cut_lineage


@dataclass
class Prepared:
    """Tables the later stages start from."""

    split: DataFrame  # user_id, item_id, timestamp, split
    users: DataFrame  # id, idx
    items: DataFrame  # id, idx
    popularity: DataFrame
    matrix: DataFrame  # user_idx, item_idx, value

    def part(self, name: str) -> DataFrame:
        return self.split.filter(F.col("split") == name).drop("split")

    @property
    def train(self) -> DataFrame:
        return self.part(TRAIN)

    @property
    def val(self) -> DataFrame:
        return self.part(VAL)

    @property
    def test(self) -> DataFrame:
        return self.part(TEST)


def interactions_from(
    ratings: DataFrame, threshold: int = 4, min_user: int = 5, min_item: int = 10
) -> DataFrame:
    """Implicit feedback after the minimum-degree filter."""
    implicit = to_implicit(ratings, threshold).select("user_id", "item_id", "timestamp")
    return kcore_filter(implicit, min_user, min_item)


def prepare(
    ratings: DataFrame, threshold: int = 4, min_user: int = 5, min_item: int = 10,
    train_ratio: float = 0.70, val_ratio: float = 0.15, test_ratio: float = 0.15,
) -> Prepared:
    """Filter, split, and index; the stage tables are written to the checkpoint folder,
    the split table by split."""
    interactions = interactions_from(ratings, threshold, min_user, min_item)
    split = cut_lineage(
        time_split(interactions, train_ratio, val_ratio, test_ratio), partition_by=["split"]
    )
    train = split.filter(F.col("split") == TRAIN).drop("split")
    users, items = (cut_lineage(m) for m in build_mappings(train))
    matrix = cut_lineage(interaction_matrix(train, users, items))
    return Prepared(split, users, items, popularity(train), matrix)
