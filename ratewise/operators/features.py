"""Feature engineering for the feature model.

Attributes and categories are kept in long form (one row per business and token) until they are
turned into rows of token positions. Positions come from a table of the sorted vocabulary that is
numbered by range partitions and joined; it is never collected.

One-hot with drop-first (attribute values, state): per attribute the values are sorted --
numerically when every value of that attribute is all digits, as strings otherwise -- and the
first value is dropped; a missing attribute gives all zeros.
"""

from __future__ import annotations

from pyspark.ml.feature import PCA, OneHotEncoder
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.functions import scalars as S
from ratewise.operators import scope, sparse_pca
from ratewise.session import cut_lineage


# ---- attributes --------------------------------------------------------------------------
def flatten_attributes(business: DataFrame) -> DataFrame:
    """(business_id, attr, value, is_digit): nested dict strings expanded, later keys win."""
    flat = business.select("business_id", S.flatten_nested_map("attributes").alias("m"))
    return (flat.select("business_id", F.explode("m").alias("attr", "value"))
            .withColumn("is_digit", F.coalesce(S.is_digits("value"), F.lit(False))))


def attribute_vocabulary(attrs: DataFrame) -> DataFrame:
    """(attr, value, position, kept): all distinct (attr, value) pairs in one-hot order; the first
    value of each attribute has ``kept = false`` (drop-first)."""
    distinct = attrs.select("attr", "value", "is_digit").distinct()
    numeric = distinct.groupBy("attr").agg(F.bool_and("is_digit").alias("numeric_attr"))
    v = distinct.join(numeric, "attr").withColumn(
        "num", F.when(F.col("numeric_attr"), F.col("value").try_cast("decimal(38,0)")))
    w = Window.partitionBy("attr").orderBy(F.col("num").asc_nulls_last(), F.col("value"))
    return (v.withColumn("position", F.row_number().over(w))
            .select("attr", "value", "position", (F.col("position") > 1).alias("kept")))


def one_hot_attributes(business: DataFrame) -> DataFrame:
    """(business_id, feature) for every one-hot column that is 1 (feature = attr_value)."""
    attrs = flatten_attributes(business)
    kept = attribute_vocabulary(attrs).filter("kept").select("attr", "value")
    return (attrs.join(kept, ["attr", "value"])
            .select("business_id", F.concat_ws("_", "attr", "value").alias("feature")))


# ---- categories --------------------------------------------------------------------------
def category_tokens(business: DataFrame) -> DataFrame:
    """(business_id, categories array): NULL -> empty string, split on ", "."""
    return business.select("business_id", F.split(F.coalesce(F.col("categories"), F.lit("")), ", ")
                           .alias("category_list"))


def category_vocab(business: DataFrame) -> DataFrame:
    """Distinct categories (the empty string of a NULL list included, as in the source)."""
    return (category_tokens(business).select(F.explode("category_list").alias("category"))
            .distinct())


def multi_hot_categories(business: DataFrame) -> DataFrame:
    """(business_id, category): one row per indicator that is 1."""
    return (category_tokens(business)
            .select("business_id", F.explode(F.array_distinct("category_list")).alias("category")))


# ---- indicator rows ----------------------------------------------------------------------
def indicator_rows(ids: DataFrame, tokens: DataFrame, vocabulary: DataFrame, id_col: str = "business_id"):
    """(id_col, ones) with the ascending positions of a row's tokens, for every row of ``ids``, and the
    index (token, position) of the sorted ``vocabulary``.

    The index is a table numbered by range partitions; tokens meet it in a join, so no vocabulary is
    collected or sent to tasks. Gathering is bounded: a row's tokens come from one record."""
    index = cut_lineage(scope.id_dictionary(vocabulary.select("token"), "token", "position"))
    ones = (tokens.select(id_col, "token").join(index, "token").groupBy(id_col)
            .agg(F.array_sort(F.collect_set(F.col("position").cast("int"))).alias("ones")))
    rows = ids.select(id_col).distinct().join(ones, id_col, "left")
    return rows.select(id_col, F.coalesce("ones", F.array().cast("array<int>")).alias("ones")), index


def category_rows(business: DataFrame):
    """(business_id, ones) over the sorted categories, and their index."""
    tokens = multi_hot_categories(business).withColumnRenamed("category", "token")
    return indicator_rows(business, tokens, tokens)


def attribute_rows(business: DataFrame):
    """(business_id, ones) over the attribute values that one-hot encoding keeps (drop-first), and their
    index; businesses without attributes have no ones."""
    token = F.concat_ws("\u0001", "attr", "value").alias("token")
    attrs = flatten_attributes(business)
    kept = attribute_vocabulary(attrs).filter("kept").select(token)
    return indicator_rows(business, attrs.select("business_id", token), kept)


# ---- PCA ---------------------------------------------------------------------------------
def pca_columns(df: DataFrame, vec_col: str, k: int, prefix: str, id_col: str = "business_id") -> DataFrame:
    """The top-k principal components of dense vectors ``vec_col``: (id_col, prefix0 .. prefix{k-1}).
    For 0/1 rows over a vocabulary see :func:`pca_indicators`.

    Fitted on the vectors as they are: Spark's covariance subtracts the mean itself, so sparse rows
    stay sparse. Its projection does not, so mean x components (k numbers) is subtracted after it.
    Component signs are fixed so that each component's largest absolute loading is positive.
    The covariance is d x d on the driver, so d is the vectors' length, not the row count.
    """
    df = cut_lineage(df.select(id_col, vec_col))  # one small row per id, read by fit and projection
    first = df.first()
    if first is None:
        return df.select(id_col, *[F.lit(0.0).alias(f"{prefix}{j}") for j in range(k)])
    d = len(first[vec_col])
    k_eff = max(1, min(k, d))
    model = PCA(k=k_eff, inputCol=vec_col, outputCol="_p").fit(df)
    pc = model.pc.toArray()
    signs = [1.0 if pc[abs(pc[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k_eff)]
    out = model.transform(df).select(id_col, vector_to_array("_p").alias("_a"))
    middle = out.select(*[F.avg(F.col("_a")[j]) for j in range(k_eff)]).first()
    cols = [((F.col("_a")[j] - F.lit(middle[j])) * signs[j] if j < k_eff else F.lit(0.0)).alias(f"{prefix}{j}")
            for j in range(k)]
    return out.select(id_col, *cols)


def pca_indicators(rows: DataFrame, index: DataFrame, k: int, prefix: str, id_col: str = "business_id") -> DataFrame:
    """The top-k principal components of indicator rows: (id_col, prefix0 .. prefix{k-1})."""
    rows = cut_lineage(rows)
    table, shift, _ = sparse_pca.loadings(rows, index.count(), k)
    return sparse_pca.project(rows, id_col, table, shift, k, prefix)


def pca_attributes(business: DataFrame, k: int = 5) -> DataFrame:
    """E4; the column prefix is a fixed value of the reference."""
    return pca_indicators(*attribute_rows(business), k, "bus_attr_")


def pca_categories(business: DataFrame, k: int = 10) -> DataFrame:
    return pca_indicators(*category_rows(business), k, "cat_pc_")


# ---- wide rows ---------------------------------------------------------------------------
def state_index(values: DataFrame, col: str = "business_state") -> DataFrame:
    """(col, position, feature): the distinct values of ``col`` numbered in order, the first one last, so
    that an encoder which drops the last category drops it; feature ``state_<value>``, NULL for the first.

    Numbered by range partitions (:func:`scope.id_dictionary`); no vocabulary is collected."""
    ids = cut_lineage(scope.id_dictionary(values.filter(F.col(col).isNotNull()), col))
    n = ids.count()
    return ids.select(col, ((F.col("idx") + n - 1) % n).cast("double").alias("position"),
                      F.when(F.col("idx") > 0, F.concat(F.lit("state_"), F.col(col))).alias("feature"))


def state_one_hot(rows: DataFrame, col: str = "business_state", values: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``state_feature``, the name of the one-hot column that is 1 (NULL for the dropped
    first value and for missing ones), and ``state_vec``, the one-hot vector over the kept values.

    The vocabulary is the distinct ``col`` of ``values`` (the business profiles in scope, a far smaller
    table than the rows; default the rows themselves)."""
    index = state_index(rows if values is None else values, col)
    last = F.lit(float(max(index.count() - 1, 0)))
    sizes = index.select("position").union(index.sparkSession.range(1).select(last.alias("position")))
    model = OneHotEncoder(inputCol="position", outputCol="state_vec", dropLast=True).fit(sizes)
    out = rows.join(index.withColumnRenamed("feature", "state_feature"), col, "left")
    return model.transform(out.withColumn("position", F.coalesce("position", last))).drop("position")


def impute_with_flags(df: DataFrame, cols: list[str], stats_where: str | None = None,
                      flag_suffix: str = "_missing", drop_constant_flags: bool = False) -> DataFrame:
    """Replace NULL/NaN in ``cols`` by the column mean (over the rows matching ``stats_where``,
    default all rows) and add a 0/1 ``<col>_missing`` flag. Tree learners in Spark ML do not
    accept NaN features.

    Means and missing indicators come from ONE aggregate pass (one row to the driver). With
    ``drop_constant_flags`` a flag is only added for columns that have a missing value somewhere
    in ``df`` (an all-zero column carries no information for a model).
    """
    def clean(c):
        return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))

    def for_stats(c):
        return clean(c) if stats_where is None else F.when(F.expr(stats_where), clean(c))

    aggs = [F.avg(for_stats(c)).alias(f"m{j}") for j, c in enumerate(cols)]
    if drop_constant_flags:
        aggs += [F.max(clean(c).isNull().cast("int")).alias(f"h{j}") for j, c in enumerate(cols)]
    row = df.select(*aggs).first()
    out = []
    for j, c in enumerate(cols):
        x = F.col(c).cast("double")
        missing = x.isNull() | F.isnan(x)
        mean = row[f"m{j}"]
        out.append(F.when(missing, F.lit(mean if mean is not None else 0.0)).otherwise(x).alias(c))
        if not drop_constant_flags or row[f"h{j}"]:
            out.append(missing.cast("int").alias(f"{c}{flag_suffix}"))
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, *out)
