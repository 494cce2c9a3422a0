"""Composite plans: the seven tables, the three questions, the whole run,
and the inputs derived from the benchmark tables."""

from arrivals_mart.plans.pipeline import (
    Inputs,
    RunResult,
    build_candidates,
    build_mart,
    build_table,
    left_out,
    read_inputs,
    run_pipeline,
    run_report,
    stage_table,
)
from arrivals_mart.plans.questions import (
    arrivals_by_airport_month,
    arrivals_country_temperature,
    arrivals_state_population,
    labelled_arrivals,
)
from arrivals_mart.plans.tables import (
    airport_dimension,
    build_fact,
    conversion_losses,
    country_dimension,
    demographics_dimension,
    time_dimension,
    travel_mode_dimension,
    visa_dimension,
)

__all__ = [
    "Inputs",
    "RunResult",
    "build_candidates",
    "build_mart",
    "build_table",
    "left_out",
    "read_inputs",
    "run_pipeline",
    "run_report",
    "stage_table",
    "arrivals_by_airport_month",
    "arrivals_country_temperature",
    "arrivals_state_population",
    "labelled_arrivals",
    "airport_dimension",
    "build_fact",
    "conversion_losses",
    "country_dimension",
    "demographics_dimension",
    "time_dimension",
    "travel_mode_dimension",
    "visa_dimension",
]
