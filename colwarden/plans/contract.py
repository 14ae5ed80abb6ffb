"""Field lists as ordered relations. Names are data: compared exactly, case included."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The names and their order are those that the export service delivers.
ETL_FIELDS = (
    "contract_transaction_unique_key",
    "contract_award_unique_key",
    "action_date_fiscal_year",
    "action_date",
    "parent_award_id_piid",
    "award_id_piid",
    "modification_number",
    "federal_action_obligation",
    "total_dollars_obligated",
    "potential_total_value_of_award",
    "total_outlayed_amount_for_overall_award",
    "period_of_performance_start_date",
    "period_of_performance_current_end_date",
    "period_of_performance_potential_end_date",
    "ordering_period_end_date",
    "primary_place_of_performance_city_name",
    "primary_place_of_performance_state_code",
    "prime_award_base_transaction_description",
    "transaction_description",
    "naics_code",
    "naics_description",
    "product_or_service_code",
    "product_or_service_code_description",
    "dod_acquisition_program_description",
    "parent_award_agency_name",
    "awarding_sub_agency_name",
    "awarding_office_name",
    "funding_agency_name",
    "funding_sub_agency_name",
    "funding_office_name",
    "recipient_name",
    "recipient_uei",
    "recipient_parent_name",
    "recipient_parent_uei",
    "solicitation_date",
    "solicitation_procedures",
    "extent_competed",
    "type_of_set_aside",
    "fair_opportunity_limited_sources",
    "other_than_full_and_open_competition",
    "number_of_offers_received",
    "subcontracting_plan",
    "government_furnished_property",
    "type_of_contract_pricing",
    "action_type",
    "award_type",
    "type_of_idc",
    "idv_type",
    "undefinitized_action",
    "program_acronym",
    "multi_year_contract",
    "multiple_or_single_award_idv",
    "usaspending_permalink",
)
#: The field that the ETL list lacks.
PROBED_FIELD = "solicitation_identifier"
#: What a delivery must hold, in the order of the slim table.
CONTRACT_FIELDS = (*ETL_FIELDS, PROBED_FIELD)
#: The contract as it stood before the probed field was confirmed.
EARLIER_CONTRACT_FIELDS = ETL_FIELDS

#: Types for the optional typed layer: our inference from names; the raw layer is all strings.
INT_FIELDS = ("action_date_fiscal_year", "number_of_offers_received")
MONEY_FIELDS = ("federal_action_obligation", "total_dollars_obligated", "potential_total_value_of_award", "total_outlayed_amount_for_overall_award")
DATE_FIELDS = ("action_date", "period_of_performance_start_date", "period_of_performance_current_end_date", "period_of_performance_potential_end_date", "ordering_period_end_date", "solicitation_date")

LIST_SCHEMA = "pos INT, field STRING"


def relation(spark: SparkSession, fields: Iterable[str]) -> DataFrame:
    """(pos, field), pos from 1, order and repeats kept."""
    return spark.createDataFrame([(i, f) for i, f in enumerate(fields, 1)], LIST_SCHEMA)


def contract(spark: SparkSession) -> DataFrame:
    return relation(spark, CONTRACT_FIELDS)


def raw_schema(fields: Iterable[str] = CONTRACT_FIELDS) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


def values_sql(fields: Iterable[str]) -> str:
    """The same relation as SQL text."""
    return ", ".join(f"({i}, '{f}')" for i, f in enumerate(fields, 1))
