from clinsift.operators.clients import cohort, persons, prepare_clients
from clinsift.operators.ids import with_new_ids
from clinsift.operators.joins import drop_matching, keep_matching, skew_join, within_days
from clinsift.operators.observations import (
    answered_observations,
    client_observations,
    label_obs,
    labels,
    latest_per_group,
    measure_pivot,
    without_height,
)

__all__ = [
    "answered_observations",
    "client_observations",
    "cohort",
    "drop_matching",
    "keep_matching",
    "label_obs",
    "labels",
    "latest_per_group",
    "measure_pivot",
    "persons",
    "prepare_clients",
    "skew_join",
    "with_new_ids",
    "within_days",
    "without_height",
]
