"""Fitted preprocessing (median/mode imputation, population standardisation,
one-hot with unseen -> all zeros) and assembly into an MLlib feature vector.

MLlib's ``Imputer`` median is approximate and its ``StandardScaler`` uses the sample
standard deviation, so X1-X3 are fitted expressions with exact statistics. The levels of
categorical columns are a table (column, value, number), numbered by a range sort; it is
joined, never collected, so a column may have any number of levels. One-hot vectors are MLlib's sparse
ones (``OneHotEncoder``) and the vector step is ``VectorAssembler``. Only ``transform``, which makes one
column a level, needs a short list of levels and raises beyond ``MAX_COLUMNS``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.functions.nulls import clean_double
from riskspark.operators.cumulative import column_modes, medians as column_medians

MAX_COLUMNS = 10_000  # of one-hot columns side by side; vectors have no limit
LEVELS = "name string, v string, i long"


def one_hot_name(col: str, value: str) -> str:
    return f"{col}_{value}"


def numbered_levels(levels: DataFrame) -> DataFrame:
    """(name, v, i): the distinct (name, v) with a number from 0 in the order of ``v`` in each name.

    The table is range-sorted and written; a row's number is its place in its partition plus the rows of its name in the
    partitions before, of which there is one count per partition and name."""
    placed = (
        levels.repartitionByRange("name", "v").sortWithinPartitions("name", "v")
        .select("name", "v", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("at")).checkpoint(eager=True)
    )
    parts = placed.groupBy("name", "p").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("name").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("name", "p", (before - F.col("first")).alias("shift"))
    return placed.join(starts, ["name", "p"]).select("name", "v", (F.col("at") + F.col("shift")).alias("i")).checkpoint(eager=True)


class Preprocessor:
    """Estimator over numeric and categorical columns (train split only)."""

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str], exact: bool = True):
        self.exact = exact
        self.numeric = list(numeric)
        self.categorical = list(categorical)

    def fit(self, df: DataFrame) -> "PreprocessorModel":
        from riskspark.session import ensure_checkpoint_dir

        spark = df.sparkSession
        ensure_checkpoint_dir(spark)
        # the fitted columns only, read once from the source and reused by every statistic
        df = df.select(*self.numeric, *self.categorical).checkpoint(eager=True)
        medians = column_medians(df, self.numeric, self.exact)
        modes = column_modes(df, self.categorical)
        imputed = [F.coalesce(clean_double(c), F.lit(medians[c]).cast("double")).alias(c) for c in self.numeric]
        stats = {}
        if self.numeric:
            row = df.select(*imputed).agg(
                *[F.avg(c).alias(f"m_{c}") for c in self.numeric],
                *[F.stddev_pop(c).alias(f"s_{c}") for c in self.numeric],
            ).first()
            stats = {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in self.numeric}
        sizes = {c: 0 for c in self.categorical}
        levels = spark.createDataFrame([], LEVELS)
        if self.categorical:
            # all category columns in one pass
            filled = [F.struct(F.lit(c).alias("name"), F.coalesce(F.col(c).cast("string"), F.lit(modes[c])).alias("v"))
                      for c in self.categorical]
            found = df.select(F.explode(F.array(*filled)).alias("kv")).select("kv.name", "kv.v").where(F.col("v").isNotNull()).distinct()
            levels = numbered_levels(found)
            sizes |= {r["name"]: r["n"] for r in levels.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
        return PreprocessorModel(self.numeric, self.categorical, medians, modes, stats, levels, sizes)


class PreprocessorModel:
    """Fitted statistics, and the table ``levels`` (name, v, i) with its number of levels per column (``sizes``)."""

    def __init__(self, numeric, categorical, medians, modes, stats, levels: DataFrame, sizes: dict):
        self.numeric = numeric
        self.categorical = categorical
        self.medians = medians
        self.modes = modes
        self.stats = stats
        self.levels = levels
        self.sizes = sizes
        self._categories = None

    def state(self) -> dict:
        """Plain values of the model, all but its levels."""
        return {"numeric": self.numeric, "categorical": self.categorical, "medians": self.medians, "modes": self.modes,
                "stats": {c: list(v) for c, v in self.stats.items()}, "sizes": self.sizes}

    def save(self, path: str) -> None:
        """IO12: the plain values and the table of levels under ``path``."""
        from riskspark.sources import io

        io.save_state(self.levels.sparkSession, f"{path}/fitted", self.state())
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "PreprocessorModel":
        from riskspark.sources import io

        return cls(levels=spark.read.schema(LEVELS).parquet(f"{path}/levels"), **io.load_state(spark, f"{path}/fitted"))

    @property
    def categories(self) -> dict[str, list[str]]:
        """The levels of each column as lists, for one column a level."""
        if self._categories is None:
            many = [c for c in self.categorical if self.sizes.get(c, 0) > MAX_COLUMNS]
            if many:
                raise ValueError(f"{many}: more than {MAX_COLUMNS} levels make too many columns; assemble() takes any number")
            out = {c: [] for c in self.categorical}
            for r in self.levels.collect() if self.categorical else ():
                out[r["name"]].append((r["i"], r["v"]))
            self._categories = {c: [v for _, v in sorted(x)] for c, x in out.items()}
        return self._categories

    def output_columns(self) -> list[str]:
        return list(self.numeric) + [one_hot_name(c, v) for c in self.categorical for v in self.categories[c]]

    def _scaled(self, c: str):
        x = F.coalesce(clean_double(c), F.lit(self.medians.get(c)).cast("double"))
        mean, sd = self.stats[c]
        return (x - F.lit(mean)) / F.lit(sd if sd else 1.0)

    def _filled(self, c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(self.modes.get(c)))

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """X1-X4 columns (remainder dropped, names kept), plus ``keep`` pass-through."""
        out = [F.col(k) for k in keep]
        out += [self._scaled(c).alias(c) for c in self.numeric]
        for c in self.categorical:
            for v in self.categories[c]:
                out.append(F.coalesce((self._filled(c) == F.lit(v)).cast("double"), F.lit(0.0)).alias(one_hot_name(c, v)))
        return df.select(*out)

    def assemble(self, df: DataFrame, keep: Sequence[str] = (), output: str = "features") -> DataFrame:
        """Scaled numbers and one-hot levels as one vector column, in the order of :meth:`output_columns`.

        A level's number comes from a join with the table of levels (a broadcast only if that is small); a value that the
        fit has not seen, or a missing one without a mode, gets all zeros."""
        out = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keep)],
                        *[self._scaled(c).alias(f"x{i}") for i, c in enumerate(self.numeric)],
                        *[self._filled(c).alias(f"v{i}") for i, c in enumerate(self.categorical)])
        vectors = []
        for j, c in enumerate(self.categorical):
            n = self.sizes.get(c, 0)
            if not n:
                continue
            named = self.levels.where(F.col("name") == c).select(F.col("v").alias(f"v{j}"), F.col("i").alias(f"i{j}"))
            meta = {"ml_attr": {"type": "nominal", "name": f"i{j}", "num_vals": n}}
            out = out.join(named, f"v{j}", "left").withColumn(f"i{j}", F.coalesce(F.col(f"i{j}"), F.lit(n)).cast("double").alias(f"i{j}", metadata=meta))
            vectors.append(j)
        if vectors:
            # unseen values have the number after the last, whose column "keep" adds and dropLast takes off again
            encoder = OneHotEncoder(inputCols=[f"i{j}" for j in vectors], outputCols=[f"o{j}" for j in vectors], handleInvalid="keep", dropLast=True)
            out = encoder.fit(out.limit(0)).transform(out)
        cols = [f"x{i}" for i in range(len(self.numeric))] + [f"o{j}" for j in vectors]
        out = VectorAssembler(inputCols=cols, outputCol="features_", handleInvalid="keep").transform(out)
        return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keep)], F.col("features_").alias(output))
