"""End-to-end jobs over files, the equivalents of the three reference programs.

Each reads its inputs with explicit schemas, runs the DataFrame plan and writes the predictions
as CSV from the executors, in the order of the pairs file. Of repeated ratings of a (user, item) the last
line stands.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ratewise.operators import neighbours
from ratewise.plans import feature_model, hybrid
from ratewise.sources import readers, sinks


def run_knn(spark: SparkSession, train_csv: str, pairs_csv: str, out_path: str,
            min_overlap: int = 75, k: int = 3) -> None:
    """Q1: item-kNN predictions, loose-header CSV."""
    train = readers.read_ratings_csv(spark, train_csv, ordered=True)
    pairs = readers.read_pairs_csv(spark, pairs_csv, ordered=True)
    pred = neighbours.knn_predict(train, pairs, min_overlap=min_overlap, k=k, decimals=None, order_by=[readers.LINE])
    sinks.write_predictions_csv_loose(sinks.in_line_order(pred, pairs), out_path, readers.LINE)


def run_hybrid(spark: SparkSession, train_csv: str, user_json: str, business_json: str, pairs_csv: str,
               out_path: str, min_overlap: int = 75, params: dict | None = None, strict: bool = False) -> None:
    """Q2: 0.1 x item-kNN + 0.9 x boosted trees, loose-header CSV."""
    train = readers.read_ratings_csv(spark, train_csv, ordered=True)
    pairs = readers.read_pairs_csv(spark, pairs_csv, ordered=True)
    user = readers.read_user_json(spark, user_json)
    business = readers.read_business_json(spark, business_json)
    pred = hybrid.hybrid_predict(train, pairs, user, business, min_overlap=min_overlap, params=params, strict=strict,
                                 order_by=[readers.LINE])
    sinks.write_predictions_csv_loose(sinks.in_line_order(pred, pairs), out_path, readers.LINE)


def run_feature_model(spark: SparkSession, train_csv: str, business_json: str, user_json: str, checkin_json: str,
                      tip_json: str, pairs_csv: str, out_path: str, params: dict | None = None,
                      min_partitions: int | None = None, strict: bool = False, reference_names: bool = False) -> None:
    """Q3: clipped boosted trees on the wide features, standard-header CSV."""
    train = readers.read_ratings_csv(spark, train_csv, min_partitions, header="line")
    pairs = readers.read_pairs_csv(spark, pairs_csv, min_partitions, header="line", ordered=True)
    business = readers.read_business_json(spark, business_json, min_partitions)
    user = readers.read_user_json(spark, user_json, min_partitions)
    checkin = readers.read_checkin_json(spark, checkin_json, min_partitions)
    tip = readers.read_tip_json(spark, tip_json, min_partitions)
    pred = feature_model.feature_model_predict(train, pairs, business, user, checkin, tip, params,
                                               strict=strict, reference_names=reference_names)
    sinks.write_predictions_csv(sinks.in_line_order(pred, pairs), out_path, readers.LINE)
