from ratewise.sources import schemas
from ratewise.sources.readers import (
    read_business_json,
    read_checkin_json,
    read_labelled_pairs_csv,
    read_pairs_csv,
    read_ratings_csv,
    read_tip_json,
    read_user_json,
)
from ratewise.sources.sinks import write_predictions_csv, write_predictions_csv_loose
from ratewise.sources.standin import StandIn

__all__ = [
    "schemas", "StandIn",
    "read_ratings_csv", "read_pairs_csv", "read_labelled_pairs_csv", "read_business_json",
    "read_user_json", "read_checkin_json", "read_tip_json",
    "write_predictions_csv", "write_predictions_csv_loose",
]
