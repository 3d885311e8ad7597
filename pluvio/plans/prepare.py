"""Full preparation: normalise → split → outliers → tier 1 → tier 2.

Stage boundaries that are read more than once (the cleaned train side is
both data and fit input of tier 1; tier-1 train output is both data and
fit input of tier 2) are materialised with :func:`pluvio.session.materialize`
so lineage stays short and a lost executor does not replay the cascade.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import WEATHER, WIND_TOKENS, Roles
from ..functions.columns import calendar_keys
from ..functions.predicates import canonical_binary, normalize_tokens, parse_date, number
from ..operators import impute
from ..operators.explore import valid_label
from ..operators.outliers import fences, iqr_bounds, null_outliers
from ..operators.split import hash_split, split_label
from ..session import materialize


def normalize(df: DataFrame, spec: Roles = WEATHER) -> DataFrame:
    """Typed projection + token normalisation + calendar keys (P4-P8), one select.

    A table without one of the roles' columns is an error that names them.
    """
    spec.check(df.columns)
    dtypes = dict(df.dtypes)
    out = []
    for c in df.columns:
        if c == spec.date:
            out.append(parse_date(c, spec.date_format, dtypes[c] == "string").alias(c))
        elif c == spec.label:
            out.append(canonical_binary(c).alias(c))
        elif c in spec.directions:
            out.append(normalize_tokens(c, WIND_TOKENS).alias(c))
        elif c in spec.doubles:
            out.append(number(c).alias(c))
        elif c in spec.ints:
            out.append(F.col(c).try_cast("int").alias(c))
        else:
            out.append(F.col(c))
    return calendar_keys(df.select(*out), spec.date)


@dataclass
class Preparation:
    """Lazily built stages of the cascade; each property is built once."""

    raw: DataFrame
    spec: Roles = WEATHER
    ratio: float = 0.8
    materialize_stages: bool = True
    _cache: dict = field(default_factory=dict)

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    def _mat(self, df: DataFrame) -> DataFrame:
        return materialize(df) if self.materialize_stages else df

    @property
    def keys3(self):
        return [self.spec.location, "DayMonth", self.spec.label]

    @property
    def keys2(self):
        return [self.spec.location, "DayMonth"]

    @property
    def normalized(self) -> DataFrame:
        return self._get("normalized", lambda: valid_label(normalize(self.raw, self.spec), self.spec))

    @property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return self._get("split", lambda: hash_split(self.normalized, ratio=self.ratio, spec=self.spec))

    @property
    def stored(self) -> tuple[DataFrame, DataFrame]:
        """The split written once: fences are fitted on its columns, and both sides read it."""
        def build():
            both = materialize(split_label(self.normalized, ratio=self.ratio, spec=self.spec).withColumnRenamed("split", "__side"))
            return tuple(both.filter(F.col("__side") == side).drop("__side") for side in ("train", "test"))
        return self._get("stored", build)

    @property
    def bounds(self) -> DataFrame:
        """Tukey fences fitted on the train side only."""
        return self._get("bounds", lambda: iqr_bounds(self.stored[0], self.spec.outliers, spec=self.spec, stored=True))

    @property
    def fences(self) -> dict:
        return self._get("fences", lambda: fences(self.bounds))

    @property
    def train_clean(self) -> DataFrame:
        return self._get("train_clean", lambda: null_outliers(self.stored[0], self.fences))

    @property
    def test_clean(self) -> DataFrame:
        return self._get("test_clean", lambda: null_outliers(self.stored[1], self.fences))

    @property
    def train_tier1(self) -> DataFrame:
        return self._get("train_tier1", lambda: self._mat(
            impute.impute_tier1(self.train_clean, self.train_clean, self.keys3, self.spec, train=True)))

    @property
    def test_tier1(self) -> DataFrame:
        return self._get("test_tier1", lambda: impute.impute_tier1(
            self.test_clean, self.train_clean, self.keys2, self.spec, train=False))

    @property
    def train_final(self) -> DataFrame:
        return self._get("train_final", lambda: self._canonical(
            impute.impute_secondary(self.train_tier1, self.train_tier1, self.spec.label, self.spec, stored=self.materialize_stages)))

    @property
    def test_final(self) -> DataFrame:
        return self._get("test_final", lambda: self._canonical(
            impute.impute_secondary(self.test_tier1, self.train_tier1, spec=self.spec, infer_flag=True, stored=self.materialize_stages)))

    @property
    def train_final_m(self) -> DataFrame:
        """The final train side, materialised: for flows that fit on it and then apply to it."""
        return self._get("train_final_m", lambda: materialize(self.train_final))

    def _canonical(self, df: DataFrame) -> DataFrame:
        r = self.spec.rain_today
        return df.withColumn(r, canonical_binary(r))


def prepare(df: DataFrame, spec: Roles = WEATHER, ratio: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(train, test) fully imputed: the reference's preparation as one call."""
    p = Preparation(df, spec, ratio)
    return p.train_final, p.test_final
