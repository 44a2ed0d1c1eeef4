"""The typed record of a sample: its fields, to and from JSON, defaults, and the dimension of states."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import hashing
from .dates import iso_text

# fixed values: fields of a record by group and type
_TEXT = (
    "id sample_id sample_hash results_hash product_name product_type product_subtype strain_name batch_number "
    "producer producer_license_number producer_address producer_street producer_city producer_state producer_zipcode "
    "distributor distributor_license_number distributor_address lab lab_license_number lab_address lab_state lab_id "
    "pesticides_status heavy_metals_status microbials_status mycotoxins_status residual_solvents_status foreign_matter_status overall_status "
    "metrc_lab_id metrc_source_id coa_url coa_pdf lab_results_url classification state source"
).split()
_NUMBERS = (
    "batch_size product_size serving_size delta_9_thc delta_8_thc thca total_thc cbd cbda total_cbd cbg cbga cbn cbc cbdv thcv total_cannabinoids "
    "beta_myrcene d_limonene beta_caryophyllene alpha_pinene beta_pinene linalool alpha_humulene terpinolene ocimene alpha_bisabolol camphene geraniol nerolidol guaiol caryophyllene_oxide total_terpenes "
    "moisture_content water_activity indica_percentage sativa_percentage"
).split()
_WHOLE = ["servings_per_package"]
DATES = "date_tested date_collected date_received date_produced date_packaged date_expires created_at updated_at data_refreshed_date".split()
_LISTS = {
    "metrc_ids": T.ArrayType(T.StringType()),
    **{name: T.ArrayType(T.MapType(T.StringType(), T.StringType())) for name in ("traceability_ids", "coa_urls", "results", "images")},
}
#: A record, dates as timestamps.
RECORD = T.StructType(
    [*[T.StructField(c, T.StringType()) for c in _TEXT], *[T.StructField(c, T.DoubleType()) for c in _NUMBERS], *[T.StructField(c, T.IntegerType()) for c in _WHOLE], *[T.StructField(c, T.TimestampNTZType()) for c in DATES], *[T.StructField(c, k) for c, k in _LISTS.items()]]
)
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?)?$"


def from_text(col: Column) -> Column:
    """A record struct of a JSON object: unknown keys are dropped, dates that aren't ISO are NULL, missing lists are empty."""
    raw = T.StructType([T.StructField(f.name, T.StringType()) if f.name in DATES else f for f in RECORD])

    def value(parsed: Column, f: T.StructField) -> Column:
        c = parsed[f.name]
        if f.name in DATES:
            return F.when(c.rlike(_ISO), c).try_cast("timestamp_ntz")
        return F.coalesce(c, F.array().cast(f.dataType)) if f.name in _LISTS else c

    # the text is parsed once for all fields: a variable of a lambda isn't put in place of each use
    made = F.transform(F.array(F.from_json(col, raw)), lambda parsed: F.struct(*[value(parsed, f).alias(f.name) for f in RECORD]))
    return F.element_at(made, 1)


def to_text(record: Column) -> Column:
    """JSON of a record struct, dates as ISO text."""
    shown = [iso_text(record[f.name].cast("string")).alias(f.name) if f.name in DATES else record[f.name].alias(f.name) for f in RECORD]
    return F.to_json(F.struct(*shown), {"ignoreNullFields": "false"})


def completed(df: DataFrame) -> DataFrame:
    """Rows with all fields of a record, in its order; ids and hashes are made where they are missing."""
    have = {c: F.col(c).cast(RECORD[c].dataType) for c in df.columns if c in RECORD.names}
    at = lambda c: have.get(c, F.lit(None).cast(RECORD[c].dataType))
    made = {
        "id": hashing.record_id([at(c) for c in ("product_name", "producer", "batch_number", "date_tested")]),
        "sample_hash": hashing.sample_hash(at("product_name"), at("producer"), at("batch_number"), at("total_thc"), at("date_tested").cast("string")),
    }
    return df.select(*[F.coalesce(F.nullif(at(f.name), F.lit("")), made[f.name]).alias(f.name) if f.name in made else (F.coalesce(at(f.name), F.array().cast(f.dataType)) if f.name in _LISTS else at(f.name)).alias(f.name) for f in RECORD])


# fixed values: states with their sources, whether they are worked on, and whether their records are public
STATES: Sequence[tuple[str, str, Sequence[str], bool, bool]] = (
    ("ak", "Alaska", ("prr",), True, True), ("az", "Arizona", ("curaleaf", "flow_distribution", "sticky_saguaro", "high_grade"), True, False),
    ("ca", "California", ("flower_company", "glass_house", "raw_garden", "sclabs"), True, False), ("co", "Colorado", ("prr",), True, True), ("ct", "Connecticut", ("ne_labs", "registry"), True, False),
    ("fl", "Florida", ("kaycha", "terplife", "flowery", "jungleboys"), True, False), ("hi", "Hawaii", ("prr",), True, True), ("ma", "Massachusetts", ("mcrlabs", "prr"), True, True),
    ("md", "Maryland", ("prr",), True, True), ("mi", "Michigan", ("prr",), True, True), ("mo", "Missouri", (), False, False), ("ms", "Mississippi", ("prr",), True, True),
    ("nj", "New Jersey", ("prr",), True, True), ("nv", "Nevada", ("prr",), True, True), ("ny", "New York", ("cannabis_realm", "my_coa", "hudson_cannabis", "jetty_extracts"), True, False),
    ("oh", "Ohio", ("prr",), True, True), ("or", "Oregon", ("prr",), True, True), ("ri", "Rhode Island", ("prr",), True, True), ("ut", "Utah", ("prr",), True, True),
    ("vt", "Vermont", ("3js_vt", "garcias", "gram_central", "float_on", "bushy_beard"), False, False), ("wa", "Washington", ("prr", "inventory"), True, True),
)


def states(spark: SparkSession) -> DataFrame:
    """The dimension of states: code, name, sources, active, public_records."""
    return spark.createDataFrame([(a, b, list(c), d, e) for a, b, c, d, e in STATES], "code string, name string, sources array<string>, active boolean, public_records boolean")


def state_folder(base: str, state: str) -> str:
    """Where a state's results lie; unknown codes stand for themselves."""
    names: Mapping[str, str] = {code: name for code, name, *_ in STATES}
    return f"{base}/{names.get(state.lower(), state).lower().replace(' ', '-')}/results"
