from pyspark.sql import functions as F

from parcelry.operators import cleaning, features, models
from parcelry.operators.scoring import score_table
from parcelry.sources.models import TrainedModel
from parcelry.streaming.scoring import read_requests, score_stream


def test_arriving_files_score_like_the_batch(spark, raw_training, tmp_path):
    fitted = features.Preprocessor().fit(raw_training)
    model = models.fit_model(spark, raw_training, fitted, "price", "ridge", {"alpha": 1.0})
    trained = TrainedModel(model, fitted, {"target_transform": "log1p"})
    requests = raw_training.select(
        "property_id",
        F.when(F.col("property_id") % 9 == 0, -1.0).otherwise(F.col("bedrooms")).alias("bedrooms"),
        "bathrooms",
        F.col("living_area").alias("livingarea"),
        F.when(F.col("property_id") % 2 == 0, F.col("latitude")).alias("latitude"),
        "longitude",
        F.col("property_type").alias("propertytype"),
        "vegas_district",
    )
    arriving, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    requests.filter("property_id < 10020").write.parquet(arriving)
    expected = score_table(cleaning.split_valid(requests)[0], trained).orderBy("property_id").collect()

    def run():
        stream = score_stream(read_requests(spark, arriving, requests.schema), trained, out, state)
        stream.awaitTermination(120)
        return spark.read.parquet(out).orderBy("property_id").collect()

    assert run() == [r for r in expected if r["property_id"] < 10020]
    requests.filter("property_id >= 10020").write.mode("append").parquet(arriving)
    assert run() == expected
    assert run() == expected
