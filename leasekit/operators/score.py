"""Bulk scoring of listing requests.

A request batch of any size is one DataFrame job:
validate (row rules -> ``errors`` array) -> split valid / quarantine ->
enrich from the reference tables (modal state, city coordinates, training
listing counts) -> listing features -> fitted preprocessing -> model ->
interval and comment. Bad rows are quarantined with their messages instead
of failing the whole batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasekit import presets
from leasekit.functions.text import array_to_multi

REQUEST_SCHEMA = ("request_id long, square_feet double, bedrooms double, bathrooms double, cityname string, "
                  "state string, latitude double, longitude double, amenities array<string>, "
                  "pets_allowed array<string>, title string, body string, has_photo string")


# ----------------------------------------------------------------------- P17 U5
def request_rules(vocab: Sequence[str] = presets.AMENITIES_VOCAB,
                  pets: Sequence[str] = presets.PETS_VOCAB) -> list[tuple[Column, str]]:
    """(violation predicate, message) pairs; a null predicate means "no violation"."""
    b = presets.REQUEST_BOUNDS
    c = F.col

    def out_of(col: str) -> Column:
        lo, hi = b[col]
        return ~c(col).between(lo, hi)

    voc = F.array(*[F.lit(v) for v in vocab])
    pv = F.array(*[F.lit(v) for v in pets])
    empty = F.array().cast("array<string>")
    return [
        (c("square_feet").isNull(), "square_feet: required"),
        (out_of("square_feet"), "square_feet: out of range"),
        (c("bedrooms").isNull(), "bedrooms: required"),
        (out_of("bedrooms"), "bedrooms: out of range"),
        (c("bedrooms") != F.floor(c("bedrooms")), "bedrooms: not an integer"),
        (c("bathrooms").isNull(), "bathrooms: required"),
        (out_of("bathrooms"), "bathrooms: out of range"),
        (c("cityname").isNull() | (F.char_length(c("cityname")) < 1), "cityname: required"),
        (out_of("latitude"), "latitude: out of range"),
        (out_of("longitude"), "longitude: out of range"),
        (F.char_length(c("title")) > presets.REQUEST_MAX_TITLE, "title: too long"),
        (F.char_length(c("body")) > presets.REQUEST_MAX_BODY, "body: too long"),
        (F.size(F.array_except(F.coalesce(c("amenities"), empty), voc)) > 0, "amenities: unknown value"),
        (F.size(F.array_except(F.coalesce(c("pets_allowed"), empty), pv)) > 0, "pets_allowed: unknown value"),
    ]


def validate(requests: DataFrame, rules: list[tuple[Column, str]] | None = None) -> DataFrame:
    """Adds ``errors``: messages of every violated rule, in rule order (empty when valid)."""
    rules = rules or request_rules()
    errs = F.array_compact(F.array(*[F.when(cond, F.lit(msg)) for cond, msg in rules]))
    return requests.withColumn("errors", errs)


# ----------------------------------------------------------------------- J2 V2
def enrich(requests: DataFrame, city_ref: DataFrame, state_ref: DataFrame) -> DataFrame:
    """State := given else the city's modal state; coordinates := given (both) else the
    city medians; an unknown city without coordinates is an error. Listing counts come
    from the training reference (0 when unknown), never from the batch itself.

    Reference tables are aggregates (one row per city / state); the joins are plain
    left joins that AQE broadcasts once it has measured them.
    """
    cr = city_ref.select(F.col("cityname").alias("_city"), F.col("listings").alias("_city_n"),
                         F.col("median_price").alias("city_median"), F.col("latitude").alias("_rlat"),
                         F.col("longitude").alias("_rlon"), F.col("state").alias("_rstate"))
    j = requests.join(cr, F.col("cityname") == F.col("_city"), "left")
    need = F.col("latitude").isNull() | F.col("longitude").isNull()
    j = j.withColumns({
        "state": F.coalesce(F.col("state"), F.col("_rstate")),
        "latitude": F.when(need, F.col("_rlat")).otherwise(F.col("latitude")),
        "longitude": F.when(need, F.col("_rlon")).otherwise(F.col("longitude")),
        "known_city": F.col("_city_n").isNotNull(),
        "city_listing_count": F.coalesce(F.col("_city_n"), F.lit(0)).cast("bigint"),
        "errors": F.array_compact(F.concat(F.coalesce(F.col("errors"), F.array().cast("array<string>")),
                                           F.array(F.when(need & F.col("_city_n").isNull(),
                                                          F.lit("cityname: unknown city without coordinates"))))),
    })
    sr = state_ref.select(F.col("state").alias("_st"), F.col("listings").alias("_st_n"))
    j = j.join(sr, F.col("state") == F.col("_st"), "left").withColumn(
        "state_listing_count", F.coalesce(F.col("_st_n"), F.lit(0)).cast("bigint"))
    return j.drop("_city", "_city_n", "_rlat", "_rlon", "_rstate", "_st", "_st_n")


# ----------------------------------------------------------------------- V1 helpers
def to_listing_rows(enriched: DataFrame, defaults: dict, posted_at: str | None = None) -> DataFrame:
    """Request -> raw listing shape (F22 list -> comma string, F23 posting time as a parameter)."""
    ts = (F.lit(posted_at).cast("timestamp_ntz") if posted_at else F.current_timestamp().cast("timestamp_ntz"))
    return enriched.select(
        "*",
        F.col("request_id").alias("id"),
        F.lit(defaults.get("category")).alias("category"),
        F.lit(defaults.get("fee")).alias("fee"),
        F.lit(defaults.get("source")).alias("source"),
        ts.alias("posted_at"),
    ).withColumns({
        "amenities": array_to_multi("amenities"),
        "pets_allowed": array_to_multi("pets_allowed"),
        "title": F.coalesce(F.col("title"), F.lit("")),
        "body": F.coalesce(F.col("body"), F.lit("")),
        "has_photo": F.coalesce(F.col("has_photo"), F.lit("Yes")),
    })


def listing_features(rows: DataFrame) -> DataFrame:
    """P16 without recounting: counts were attached from the reference (V2)."""
    from leasekit.operators import features as FE

    return (rows.transform(FE.amenity_flags).transform(FE.pets_flags).transform(FE.text_features)
                .transform(FE.ratio_features).transform(FE.time_features)
                .withColumn("lat_lon_interaction", F.col("latitude") * F.col("longitude")))


# ----------------------------------------------------------------------- F19 F21
def interval_and_comment(df: DataFrame, mae: float = presets.FALLBACK_MAE, p: str = "prediction") -> DataFrame:
    pred = F.col(p)
    comment = F.when(F.col("known_city"), F.concat(
        F.lit("City known to the model ("), F.col("city_listing_count").cast("string"),
        F.lit(" listings in training)"))).otherwise(F.lit("City not in the training data; accuracy is lower"))
    return df.select(
        "request_id",
        F.round(pred, 2).alias("predicted_price"),
        F.round(F.greatest(pred - F.lit(mae), F.lit(0.0)), 2).alias("price_low"),
        F.round(pred + F.lit(mae), 2).alias("price_high"),
        F.col("city_median").cast("double").alias("city_median"),
        F.round(pred - F.col("city_median"), 2).alias("diff_from_city_median"),
        comment.alias("comment"),
    )


def score(requests: DataFrame, prep, model, city_ref: DataFrame, state_ref: DataFrame, defaults: dict,
          mae: float = presets.FALLBACK_MAE, posted_at: str | None = None,
          log_target: bool = False) -> tuple[DataFrame, DataFrame]:
    """V1: returns (predictions, quarantine). ``prep`` is a fitted preprocessor
    (``leasekit.operators.models.Prep``), ``model`` a fitted MLlib model."""
    v = enrich(validate(requests), city_ref, state_ref)
    bad = v.filter(F.size("errors") > 0).select("request_id", "errors")
    good = v.filter(F.size("errors") == 0)
    feats = listing_features(to_listing_rows(good, defaults, posted_at))
    passthrough = {"_rq": "request_id", "_kc": "known_city", "_cn": "city_listing_count", "_cm": "city_median"}
    feats = feats.withColumns({k: F.col(v) for k, v in passthrough.items()})
    x = prep.transform(feats.withColumn(presets.TARGET, F.lit(None).cast("double")).withColumn("split", F.lit("score")),
                       keep=list(passthrough))
    pred = model.transform(x).select("prediction", *[F.col(k).alias(v) for k, v in passthrough.items()])
    if log_target:
        pred = pred.withColumn("prediction", F.expm1("prediction"))
    return interval_and_comment(pred, mae), bad


@dataclass
class Scorer:
    """Everything that scoring needs, as one artifact: fitted preprocessing, model, references, defaults and the MAE that
    widens the interval."""

    prep: object
    model: object
    city_ref: DataFrame
    state_ref: DataFrame
    defaults: dict
    mae: float
    log_target: bool = False

    def score(self, requests: DataFrame, posted_at: str | None = None) -> DataFrame:
        """One row a request: a prediction, or (``errors`` not null) the messages of the rules that it breaks."""
        pred, bad = score(requests, self.prep, self.model, self.city_ref, self.state_ref, self.defaults, self.mae, posted_at, self.log_target)
        bad = bad.select("request_id", F.array_join("errors", "; ").alias("errors"))
        return pred.unionByName(bad, allowMissingColumns=True)

    def save(self, path: str) -> None:
        from leasekit.sources.artifacts import save_model, write_json

        save_model(self.prep, f"{path}/prep")
        save_model(self.model, f"{path}/model")
        self.city_ref.write.mode("overwrite").parquet(f"{path}/city_ref")
        self.state_ref.write.mode("overwrite").parquet(f"{path}/state_ref")
        write_json(self.city_ref.sparkSession, f"{path}/plain", {"defaults": self.defaults, "mae": self.mae, "log_target": self.log_target})

    @classmethod
    def load(cls, spark, path: str, model_class) -> Scorer:
        """``model_class``: the fitted model's class (``trees.Ensemble`` or an MLlib model)."""
        from leasekit.operators.models import Prep
        from leasekit.operators.trees import Ensemble
        from leasekit.sources.artifacts import load_model, read_json

        plain = read_json(spark, f"{path}/plain")
        model = load_model(model_class, f"{path}/model", spark if model_class is Ensemble else None)
        return cls(Prep.load(spark, f"{path}/prep"), model, spark.read.parquet(f"{path}/city_ref"), spark.read.parquet(f"{path}/state_ref"), **plain)


def model_card(run_metrics: DataFrame, model_type: str, n_features: int, spark) -> DataFrame:
    """V3: one row with model type, rounded metrics, feature count and the amenity vocabulary."""
    m = run_metrics.groupBy().pivot("metric", ["mae", "rmse", "mape", "r2", "median_ae"]).agg(F.first("value"))
    return m.select(F.lit(model_type).alias("model_type"),
                    *[F.round(c, 3).alias(c) for c in ["mae", "rmse", "mape", "r2", "median_ae"]],
                    F.lit(n_features).alias("n_features"),
                    F.array(*[F.lit(a) for a in presets.AMENITIES_VOCAB]).alias("amenities"))
