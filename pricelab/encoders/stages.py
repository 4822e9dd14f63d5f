"""The full feature preparation, fitted on a train fold and applied to any frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from pricelab.encoders.categorical import CategoryEncoder, RareNuller, TargetMeanEncoder
from pricelab.encoders.numeric import Imputer, SkewLog, StandardScaler


class FeatureSteps:
    """Rare values, category and target encoding, gap filling, skew logs, scaling.

    Each step fits on the output of the steps before it. ``scale=False`` and
    ``skewed=()`` give the shorter form used for trees.
    """

    def __init__(
        self,
        num: Sequence[str],
        cat: Sequence[str],
        target: str,
        fill: dict[str, object] | None = None,
        rare: Sequence[str] = (),
        rare_threshold: int = 2,
        skewed: Sequence[str] | None = (),
        target_encode: bool = True,
        codes: str | None = "keras",
        scale: bool = True,
        parity: bool = False,
    ):
        self.num, self.cat, self.target = list(num), list(cat), target
        self.fill, self.rare, self.rare_threshold = dict(fill or {}), list(rare), rare_threshold
        self.skewed, self.target_encode, self.codes, self.scale = skewed, target_encode, codes, scale
        self.parity = parity

    def fit(self, train: DataFrame, keep_from: DataFrame | None = None) -> "FeatureSteps":
        self.rare_nuller = RareNuller(self.rare_threshold).fit(train, self.rare, keep_from)
        df = self.rare_nuller.transform(train)
        self.encoded: list[str] = []
        if self.target_encode and self.cat:
            self.target_encoder = TargetMeanEncoder(self.parity).fit(df, self.cat, self.target)
            df = self.target_encoder.transform(df)
            self.encoded = [f"encoded_{c}" for c in self.cat]
        if self.codes and self.cat:
            self.code_encoder = CategoryEncoder(self.codes, reserve_missing=self.codes == "keras").fit(df, self.cat)
        self.imputer = Imputer().fit(df, list(self.fill), self.fill)
        df = self.imputer.transform(df)
        self.skew_log = SkewLog().fit(df, self.num, self.skewed)
        df = self.skew_log.transform(df)
        if self.scale:
            self.scaler = StandardScaler().fit(df, self.num + self.encoded)
            self.target_scaler = StandardScaler().fit(df, [self.target])
        return self

    def transform(self, df: DataFrame, is_train: bool = False) -> DataFrame:
        """Apply the fitted steps; rare values are nulled in the train frame only."""
        if is_train:
            df = self.rare_nuller.transform(df)
        if self.encoded:
            df = self.target_encoder.transform(df)
        if self.codes and self.cat:
            df = self.code_encoder.transform(df)
        df = self.skew_log.transform(self.imputer.transform(df))
        if self.scale:
            df = self.scaler.transform(df)
            if self.target in df.columns:
                df = self.target_scaler.transform(df, [self.target], [f"{self.target}_scaled"])
        return df

    def features(self) -> list[str]:
        return self.num + self.encoded + (self.cat if self.codes else [])

    def target_inverse(self, df: DataFrame, scaled: str, out: str) -> DataFrame:
        return self.target_scaler.inverse_transform(df, [scaled], [out])
