"""Dataset registry and table schemas."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAILY, MONTHLY = "D", "M"

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RINGS = T.ArrayType(T.ArrayType(POINT))

ZONE_KEYS = ["iso3", "adm_level", "zone_idx"]
ZONES = T.StructType(
    [
        T.StructField("iso3", T.StringType()),
        T.StructField("adm_level", T.IntegerType()),
        T.StructField("zone_idx", T.IntegerType()),
        T.StructField("pcode", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("rings", RINGS),
    ]
)

TILES = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("year_valid", T.IntegerType()),
        T.StructField("month_valid", T.IntegerType()),
        T.StructField("date_valid", T.IntegerType()),
        T.StructField("leadtime", T.IntegerType()),
        T.StructField("band", T.IntegerType()),
        T.StructField("x0", T.DoubleType()),
        T.StructField("y0", T.DoubleType()),
        T.StructField("res", T.DoubleType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("data", T.ArrayType(T.DoubleType())),
    ]
)

QA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("iso3", T.StringType()),
        T.StructField("adm_level", T.IntegerType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("stack_trace", T.StringType()),
    ]
)


@dataclass(frozen=True)
class DatasetSpec:
    """One gridded dataset: where its files are, how often they come, what keys they add."""

    name: str
    prefix: str
    start: date
    frequency: str
    forecast: bool = False
    extra_dims: dict[str, T.DataType] = field(default_factory=dict)
    coverage: tuple[str, ...] | None = None
    end: date | None = None
    test_iso3s: tuple[str, ...] = ()
    test_window: tuple[date, date] | None = None

    def in_test(self) -> DatasetSpec:
        """The dataset within its test window of dates; the whole of it without one."""
        if self.test_window is None:
            return self
        return replace(self, start=self.test_window[0], end=self.test_window[1])

    @property
    def date_column(self) -> str:
        return "issued_date" if self.forecast else "valid_date"

    @property
    def slice_keys(self) -> list[str]:
        return ["valid_date", *self.extra_dims]

    @property
    def key(self) -> list[str]:
        return ["valid_date", "pcode", *self.extra_dims]


# File prefixes, start dates, frequencies, the test countries and the list of
# countries with flood-extent coverage.
TEST_ISO3S = ("BDI", "NGA", "TCD")
FLOOD_COVERAGE = (
    "DZA", "AGO", "BEN", "BWA", "BFA", "BDI", "CPV", "CMR", "CAF", "TCD", "COM", "COG", "CIV",
    "CAP", "DJI", "EGY", "GNQ", "ERI", "SWZ", "ETH", "GAB", "GMB", "GHA", "GIN", "GNB", "KEN",
    "LS0", "LBR", "LBY", "MDG", "MWI", "MLI", "MRT", "MUS", "MAR", "MOZ", "NAM", "NER", "NGA",
    "RWA", "STP", "SEN", "SYC", "SLE", "SOM", "ZAF", "SSD", "SDN", "TGO", "TUN", "UGA", "TZA",
    "ZMB", "ZWE",
)
DATASETS = {
    spec.name: spec
    for spec in (
        DatasetSpec(
            "era5",
            "era5/monthly/processed/precip_reanalysis_v",
            date(1981, 1, 1),
            MONTHLY,
            test_iso3s=TEST_ISO3S,
        ),
        DatasetSpec(
            "floodscan",
            "floodscan/daily/v5/processed/aer_area_300s_",
            date(1998, 1, 12),
            DAILY,
            extra_dims={"band": T.StringType()},
            coverage=FLOOD_COVERAGE,
            test_iso3s=TEST_ISO3S,
        ),
        DatasetSpec(
            "imerg",
            "imerg/daily/late/v7/processed/imerg-daily-late-",
            date(2000, 6, 1),
            DAILY,
            test_iso3s=TEST_ISO3S,
        ),
        DatasetSpec(
            "seas5",
            "seas5/monthly/processed/precip_em_i",
            date(1981, 1, 1),
            MONTHLY,
            forecast=True,
            extra_dims={"leadtime": T.IntegerType()},
            test_iso3s=TEST_ISO3S,
        ),
    )
}

STAT_COLUMNS = ["mean", "median", "min", "max", "count", "sum", "std"]


def stats_schema(spec: DatasetSpec) -> T.StructType:
    """Columns of the dataset's statistics table, key columns first."""
    fields = [
        T.StructField("iso3", T.StringType()),
        T.StructField("pcode", T.StringType()),
        T.StructField("valid_date", T.DateType()),
    ]
    if spec.forecast:
        fields.append(T.StructField("issued_date", T.DateType()))
    fields += [T.StructField(name, kind) for name, kind in spec.extra_dims.items()]
    fields.append(T.StructField("adm_level", T.IntegerType()))
    for stat in STAT_COLUMNS:
        kind = T.IntegerType() if stat == "count" else T.FloatType()
        fields.append(T.StructField(stat, kind))
    return T.StructType(fields)


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema``; a column ``df`` lacks becomes null."""
    have = set(df.columns)

    def one(f: T.StructField) -> Column:
        source = F.col(f.name) if f.name in have else F.lit(None)
        return source.cast(f.dataType).alias(f.name)

    return df.select(*[one(f) for f in schema.fields])


def coverage_table(spark: SparkSession, specs: list[DatasetSpec]) -> DataFrame:
    """(dataset, iso3) for every dataset that restricts its countries."""
    rows = [(s.name, code) for s in specs if s.coverage is not None for code in s.coverage]
    return spark.createDataFrame(rows, "dataset string, iso3 string")


def required_dims(df: DataFrame, known: set[str], value: str = "value") -> str | None:
    """Check that a cells table has its required dimensions; return the extra one, if any."""
    missing = {"x", "y", "valid_date"} - set(df.columns)
    if missing:
        raise ValueError(f"cells lack the required dimensions {sorted(missing)}")
    ignored = {"x", "y", "valid_date", "row", "col", "iso3", "dataset", value}
    extra = [c for c in df.columns if c not in ignored and c in known]
    return extra[0] if extra else None
