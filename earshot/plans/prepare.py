"""From raw interactions to indexed training, validation and test parts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from earshot.functions.counts import VARIANTS
from earshot.operators.indexing import fit_index, index_pairs
from earshot.operators.splits import holdout_histories
from earshot.session import stored


@dataclass(frozen=True)
class Prepared:
    """Indexed interactions with a ``split`` column, and the indexes fitted on its train part."""

    indexed: DataFrame
    users: DataFrame
    items: DataFrame

    def part(self, split: str) -> DataFrame:
        return self.indexed.where(self.indexed["split"] == split).drop("split")

    @property
    def train(self) -> DataFrame:
        return self.part("train")

    @property
    def valid(self) -> DataFrame:
        return self.part("valid")

    @property
    def test(self) -> DataFrame:
        return self.part("test")


def prepare(interactions: DataFrame) -> Prepared:
    """Split, index on the training rows, apply to all parts.

    The split table is written once, partitioned by ``split``, so that the join and aggregation
    behind it run once and readers of one part skip the others.
    """
    split = stored(holdout_histories(interactions), "interactions", partition_by="split")
    train = split.where("split = 'train'")
    users = fit_index(train, "user_id", "user_index")
    items = fit_index(train, "track_id", "item_index")
    return Prepared(index_pairs(split, users, items), users, items)


def count_variants(prepared: Prepared) -> dict[str, DataFrame]:
    """Training interactions under every count modification; labels stay the same for all."""
    return {name: change(prepared.train) for name, change in VARIANTS.items()}
