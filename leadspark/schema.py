"""Column roles of the lead model and the contract every frame is checked against."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source field names of the company master, beside the names used here. The key
# and the name columns differ between deployments and are given by the caller.
SOURCE_FIELDS = {
    "Gruendung_Jahr": "founding_year",
    "PLZ": "postal_code",
    "Kanton": "canton",
    "Ort": "city",
    "Rechtsform": "legal_form",
    "RechtsCode": "legal_code",
    "BrancheCode_02": "industry_code_02",
    "BrancheCode_04": "industry_code_04",
    "BrancheCode_06": "industry_code_06",
    "BrancheText_02": "industry_text_02",
    "BrancheText_04": "industry_text_04",
    "BrancheText_06": "industry_text_06",
    "MitarbeiterBestand": "headcount",
    "MitarbeiterBestandKategorie": "headcount_band",
    "MitarbeiterBestandKategorieOrder": "headcount_band_order",
    "Umsatz": "revenue",
    "UmsatzKategorie": "revenue_band",
    "UmsatzKategorieOrder": "revenue_band_order",
    "Risikoklasse": "risk_class",
    "GroessenKategorie": "size_class",
    "V_Bestand_Kategorie": "stock_category",
    "Eintritt": "joined_at",
    "Austritt": "left_at",
    "DT_LoeschungAusfall": "deleted_at",
}

# The date the source stores in place of "not deleted".
NOT_DELETED = "1888-12-31"

# Feature columns by treatment, and the columns never used as features.
NUMERIC = (
    "headcount",
    "revenue",
    "risk_class",
    "company_age_years",
    "company_age_log",
    "is_missing_headcount",
    "is_missing_revenue",
    "headcount_log1p",
    "revenue_log1p",
    "month_sin",
    "month_cos",
    "is_quarter_end",
    "is_summer",
    "quarter",
)
ORDINAL = ("headcount_band_order", "revenue_band_order")
LOW_CARD = ("canton", "legal_form", "size_class", "stock_category", "legal_code", "company_age_bucket")
HIGH_CARD = (
    "postal_code",
    "plz2",
    "plz3",
    "industry_code_06",
    "noga_section",
    "noga_division",
    "noga_group",
    "canton_noga_section",
)
DROP = (
    "company_id",
    "company_name",
    "joined_at",
    "left_at",
    "snapshot_date",
    "target",
    "deleted_at",
    "industry_text_02",
    "industry_text_04",
    "industry_text_06",
    "headcount_band",
    "revenue_band",
)
LEAKAGE = ("target", "joined_at", "left_at", "snapshot_date", "deleted_at")


@dataclass(frozen=True)
class RoleSchema:
    """Which columns get which treatment. Anything not listed is dropped."""

    numeric: tuple[str, ...] = NUMERIC
    ordinal: tuple[str, ...] = ORDINAL
    low_card: tuple[str, ...] = LOW_CARD
    high_card: tuple[str, ...] = HIGH_CARD
    drop: tuple[str, ...] = field(default=DROP)

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.ordinal + self.low_card + self.high_card

    def check(self, df: DataFrame) -> None:
        """Fail before any job runs: no leakage in a feature role, no missing column, numeric means numeric."""
        leaked = sorted(set(self.features) & set(LEAKAGE))
        if leaked:
            raise ValueError(f"leakage columns used as features: {leaked}")
        absent = sorted(set(self.features) - set(df.columns))
        if absent:
            raise ValueError(f"feature columns missing from the frame: {absent}")
        wrong = [c for c in self.numeric + self.ordinal if not isinstance(df.schema[c].dataType, T.NumericType)]
        if wrong:
            raise TypeError(f"columns in a numeric role are not numeric: {wrong}")


def feature_columns(df: DataFrame, drop: tuple[str, ...] = DROP) -> DataFrame:
    """All columns but identifiers, outcomes and redundant labels."""
    return df.select(*[c for c in df.columns if c not in drop])


def available_columns(df: DataFrame, wanted: list[str] | tuple[str, ...], keep: tuple[str, ...] = ()) -> DataFrame:
    """The wanted columns that exist; names that do not are skipped."""
    have = set(df.columns)
    return df.select(*keep, *[c for c in wanted if c in have and c not in keep])


def autodetect_roles(df: DataFrame, exclude: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    """(categorical, numeric) column names by type."""
    categorical, numeric = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.StringType):
            categorical.append(f.name)
        elif isinstance(f.dataType, (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)):
            numeric.append(f.name)
    return categorical, numeric


def as_category_text(df: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """Cast categoricals to text with one label for an absent value."""
    from leadspark.functions.features import or_missing

    return df.withColumns({c: or_missing(F.col(c)) for c in cols if c in df.columns})


def as_float32(df: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("float") for c in cols})
